"""Streams that follow stored versions: changed members, promoted models, repeated batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from claimsight.operators.writes import VersionedTable
from claimsight.plans.training import score, train_gbt
from claimsight.streaming.in_force import LOG, OWN_FEATURES, ModelInForce, ModelStore, enrich_sink, labelled, moved, own_features, score_sink


def test_a_repeated_batch_leaves_its_rows_once_and_sees_the_version_in_force(spark, rel, scratch):
    members, providers = VersionedTable(spark, "members", scratch), VersionedTable(spark, "providers", scratch)
    out = os.path.join(scratch, "out")
    sink = enrich_sink(members, providers, out)
    with pytest.raises(LookupError):
        sink(rel.claims, 0)
    members.commit(rel.members)
    providers.commit(rel.providers)
    few = rel.claims.where("member_id <= '2'")
    for batch_id in (0, 0, 1):
        sink(few, batch_id)
    members.commit(moved(rel.members))
    sink(few, 2)
    got = spark.read.parquet(out).groupBy("batch", "members_version").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("member_county").startswith("moved")).alias("moved")).orderBy("batch").collect()
    n = few.count()
    assert [(r["batch"], r["members_version"], r["n"]) for r in got] == [(0, 1, n), (1, 1, n), (2, 2, n)]
    assert [r["moved"] > 0 for r in got] == [False, False, True]


@pytest.fixture(scope="module")
def models(rel):
    return {v: train_gbt(labelled(rel), OWN_FEATURES, max_iter=n) for v, n in (("v1", 1), ("v2", 3))}


def test_scores_come_from_the_promoted_model_which_is_loaded_once(spark, rel, scratch, models):
    store, log, out = ModelStore(spark, f"{scratch}/models"), VersionedTable(spark, "log", scratch), os.path.join(scratch, "out")
    for version, model in models.items():
        store.save(version, model)
    with pytest.raises(ValueError):
        store.save("v1", models["v1"])
    claims = own_features(rel.claims).select("claim_id", *OWN_FEATURES)
    rows = [("a", "v1", dt.date(2000, 1, 1), False)]
    log.commit(spark.createDataFrame(rows, LOG))
    held = ModelInForce(log, store)
    sink = score_sink(held, OWN_FEATURES, out)
    with pytest.raises(LookupError):            # nothing promoted
        sink(claims, 0)
    rows += [("b", "v1", dt.date(2000, 1, 2), True), ("c", "v2", dt.date(2000, 1, 3), False)]
    log.commit(spark.createDataFrame(rows, LOG))
    sink(claims, 0)
    sink(claims, 1)
    assert held.loads == 1
    log.commit(spark.createDataFrame([*rows, ("d", "v2", dt.date(2000, 1, 4), True)], LOG))
    sink(claims, 2)
    assert held.loads == 2
    got = spark.read.parquet(out)
    assert {(r["batch"], r["model_version"]) for r in got.select("batch", "model_version").distinct().collect()} == {(0, "v1"), (1, "v1"), (2, "v2")}
    for batch, version in ((1, "v1"), (2, "v2")):
        plain = score(models[version], claims, OWN_FEATURES).select("claim_id", F.col("score").alias("plain"))
        both = got.where(F.col("batch") == batch).join(plain, "claim_id", "full")
        assert both.where("plain is null or score is null or abs(plain - score) > 1e-12").count() == 0
    log.commit(spark.createDataFrame([("e", "v9", dt.date(2001, 1, 1), True)], LOG))
    with pytest.raises(LookupError):            # promoted, but not stored
        sink(claims, 3)


def test_months_that_lie_together_land_without_another_shuffle(spark, rel, scratch):
    from claimsight.streaming.in_force import _halves, _work, land
    from claimsight.streaming.jobs import read_replay
    _, _, stored, together = _work(rel)
    first, second = _halves(stored.claims)
    assert together and "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    for half in (first, second):
        land(half, "date_of_service", f"{scratch}/claims", together)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{scratch}/claims").select("path").collect()
    months = rel.claims.select(F.trunc("date_of_service", "month")).distinct().count()
    assert all(f.path.endswith(".json.gz") for f in files) and len(files) <= 2 * months
    landed = spark.read.schema(read_replay(spark, f"{scratch}/claims", "claims").drop("day", "_file").schema).json(f"{scratch}/claims")
    assert landed.select("claim_id", "amount_claimed", "submitted_at").exceptAll(rel.claims.select("claim_id", "amount_claimed", "submitted_at")).count() == 0
    assert landed.count() == rel.claims.count()


def test_predictions_meet_their_model_version_where_they_are(rel):
    from claimsight.plans.models import stg_fraud_predictions
    plan = stg_fraud_predictions(rel.fraud_predictions, rel.model_performance_log)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(model_version#" not in plan.split("BroadcastExchange")[0]
