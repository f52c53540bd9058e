"""Plans that deal rows once: bursts, status intervals and near duplicates against plain forms, and how many rows they shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimsight.operators.quality import _with_near_neighbour
from claimsight.operators.windows import next_time_in_key
from claimsight.streaming.jobs import provider_bursts


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("threshold", [1, 3, 20, 60])
def test_bursts_equal_plain_windows(spark, threshold):
    rng, start = random.Random(threshold), dt.datetime(2020, 1, 1)
    rows = [(rng.choice(["p", "q", None]), start + dt.timedelta(minutes=rng.choice([rng.randrange(20_000), 7_000 + rng.randrange(600)])))
            for _ in range(400)] + [("p", None)] * 70 + [("r", dt.datetime(1960, 5, 5, 0, 7))]
    df = spark.createDataFrame(rows, "provider_id string, submitted_at timestamp_ntz")
    plain = df.groupBy("provider_id", F.window("submitted_at", "6 hours", "15 minutes").alias("w")).agg(F.count(F.lit(1)).alias("claims")) \
        .where(F.col("claims") >= threshold).select("provider_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "claims")
    got = provider_bursts(df, threshold)
    # counts by bucket, and once to the blocks; windows are summed where they are made
    assert exchanges(got) == 2
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_status_intervals_shuffle_the_events_once(spark):
    rows = [(f"e{i}", f"c{i % 4}", dt.datetime(2020, 1, 1 + i % 9), "x") for i in range(90)]
    odd = [("n1", "c1", None, "x"), ("n2", None, dt.datetime(2020, 1, 1), "x")]        # without a time, without a claim: left out
    df = spark.createDataFrame(rows + odd, "event_id string, claim_id string, event_at timestamp_ntz, new_status string")
    got = next_time_in_key(df, "claim_id", "event_at", "event_id")
    assert exchanges(got) == 1
    by_claim = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by_claim.setdefault(r[1], []).append(r)
    plain = {x[0]: y[2] if y else None for c in by_claim.values() for x, y in zip(c, [*c[1:], None], strict=True)}
    assert {r.event_id: r.next_ts for r in got.collect()} == plain


@pytest.mark.parametrize("band", [0, 2, 30])
def test_rows_without_a_near_one_leave(spark, band):
    rng = random.Random(band)
    rows = [(i, rng.choice("abc"), rng.randrange(-3000, 6000)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k string, at int")
    got = [r.id for r in _with_near_neighbour(df, ["k"], "at", band, 4).collect()]
    assert sorted(got) == [i for i, k, at in rows if any(j != i and k == l and abs(at - to) <= band for j, l, to in rows)]
    assert got or band == 0


def test_payments_meet_claims_where_they_are(spark):
    """Payments are added where the orders' join put the claims; the reference tables are broadcast; other relations give the same rows."""
    import re
    from types import SimpleNamespace

    from claimsight.plans.models import claims_enriched
    from claimsight.sources.mapping import Relations
    rel = Relations(spark, "/root/testdata/sf0.001")
    out = claims_enriched(rel)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"Exchange hashpartitioning\((?:claim_id|employer_id|diagnosis_code)#", plan)
    names = ("claims", "payments", "members", "providers", "plans", "employers", "icd10_codes")
    plain = claims_enriched(SimpleNamespace(**{n: getattr(rel, n) for n in names}))
    assert out.columns == plain.columns and out.count() == plain.count() == rel.claims.count()
    assert out.exceptAll(plain).count() == 0


def test_merge_reads_one_spine(spark):
    """Lineitem meets orders once, when the spine is stored."""
    from claimsight.plans.models import fct_claims_merge
    from claimsight.sources.mapping import Relations
    plan = fct_claims_merge(Relations(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (l_orderkey" not in plan and "l_orderkey" in plan
