"""SMOTE: target, geometry, repeatability and hot points."""

import random

import pytest
from pyspark.sql import functions as F

from claimsight.plans.oversampling import between, neighbours, smote

FEATURES = ["x", "y"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    rare = [(f"r{i}", 1, rng.gauss(0, 1), rng.gauss(5, 2)) for i in range(90)] + [(f"h{i}", 1, 0.5, 0.5) for i in range(60)]   # one hot point
    rest = [(f"m{i}", 0, rng.gauss(20, 1), rng.gauss(-50, 2)) for i in range(1017)]
    return spark.createDataFrame(rare + rest + [("n", 1, None, 3.0)], "claim_id string, label int, x double, y double").repartition(3)


def test_target_geometry_and_reruns(rows):
    made = smote(rows, FEATURES, most=20)
    assert made.count() == 1017 - 151 == made.select("synthetic_id").distinct().count()
    assert between(made, rows, FEATURES).where("inside").count() == made.count()
    assert made.where("base_id like 'm%' or neighbour_id like 'm%'").count() == 0
    again = smote(rows.repartition(5), FEATURES, most=20)
    rounded = [F.round(c, 9).alias(c) for c in FEATURES]
    keys = ["synthetic_id", "neighbour_id"]
    assert sorted(map(tuple, made.select(*keys, *rounded).collect())) == sorted(map(tuple, again.select(*keys, *rounded).collect()))
    # a share of the way, not the ends only
    assert made.agg(F.avg("gap")).first()[0] == pytest.approx(0.5, abs=0.05)
    counts = [r["count"] for r in made.groupBy("base_id").count().collect()]
    assert len(counts) == 151 and set(counts) == {5, 6}


def test_ratio_and_small_classes(rows):
    assert smote(rows, FEATURES, ratio=0.2).count() == round(0.2 * 1017) - 151
    assert smote(rows, FEATURES, ratio=0.1).count() == 0
    assert smote(rows.where("label = 0"), FEATURES).count() == 0
    one = smote(rows.where("label = 0 or claim_id = 'r1'"), FEATURES)
    assert one.count() == 1016 and one.select("base_id", "neighbour_id").distinct().collect() == [("r1", "r1")]


def test_neighbours_are_near(rows):
    rare = rows.where("label = 1 and claim_id like 'r%'")
    at = {r["claim_id"]: (r["x"], r["y"]) for r in rare.collect()}
    near = {r["claim_id"]: [n["id"] for n in r["near"]] for r in neighbours(rare, FEATURES, "claim_id", 5).collect()}

    def far(a, b):
        return (at[a][0] - at[b][0]) ** 2 + ((at[a][1] - at[b][1]) / 2) ** 2
    assert set(near) == set(at) and all(1 <= len(v) <= 5 and k not in v for k, v in near.items())
    found = sum(sum(far(k, n) for n in v) / len(v) for k, v in near.items())
    mean = sum(far(a, b) for a in at for b in at) / len(at)
    assert found < 0.2 * mean


def test_neighbours_are_the_nearest(spark, monkeypatch):
    """Every row has its nearest others, also past the edge of its leaf and beside crowds of equal rows."""
    import numpy as np

    from claimsight.operators import nearest
    monkeypatch.setattr(nearest, "PROBES", 7)
    rng = random.Random(9)
    rows = [(f"a{i:03d}", rng.gauss(0, 1), float(rng.randrange(3))) for i in range(160)] + [(f"b{i:03d}", 0.25, 1.0) for i in range(40)]
    rows += [(f"c{i}", 4.0 + i, 0.0) for i in range(3)] + [("odd", float("nan"), 0.0), (None, 0.0, 0.0)]
    got = {r["claim_id"]: [(n["distance"], n["id"]) for n in r["near"]] for r in neighbours(
        spark.createDataFrame(rows, "claim_id string, x double, y double").repartition(4), FEATURES, "claim_id", 5, most=16).collect()}
    known = [r for r in rows if r[0] and r[1] == r[1]]
    spread = [float(f"{s:.9g}") for s in (np.std([r[1] for r in rows if r[1] == r[1]], ddof=1), np.std([r[2] for r in rows], ddof=1))]
    at = {r[0]: (r[1] / spread[0], r[2] / spread[1]) for r in known}
    assert set(got) == set(at)
    for i, p in at.items():
        near = sorted((((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2), j) for j, q in at.items() if j != i)[:5]
        assert [n for _, n in got[i]] == [n for _, n in near] and [d for d, _ in got[i]] == pytest.approx([d for d, _ in near])
    few = spark.createDataFrame([("p", 0.0, 0.0), ("q", 1.0, 0.0), ("p", 0.0, 0.0)], "claim_id string, x double, y double")
    assert {r["claim_id"]: [n["id"] for n in r["near"]] for r in neighbours(few, FEATURES, "claim_id").collect()} == {"p": ["q"], "q": ["p"]}
