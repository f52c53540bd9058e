"""Writes over rows that the claim spine deals: against plain forms, and without another shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimsight.operators.writes import append_events, split_by, u03_claims, u04_events, upsert_claims
from claimsight.plans.models import _With, fct_claims, merge_fct_claims
from claimsight.sources.mapping import Relations
from tests.test_writes import LOAD, SCHEMA, _row, _sequential


@pytest.fixture()
def tables(spark, scratch):
    """A folder with a few orders and their lines, and its claim relations."""
    rng, day = random.Random(5), dt.datetime(1998, 1, 1)
    orders = [(o, o % 7, day + dt.timedelta(days=o % 300), rng.choice(["1-URGENT", "5-LOW"])) for o in range(1, 90)]
    lines = [(o, rng.randrange(60), rng.randrange(9), n, 3.0 + n, 1000.0 * n, 0.05, 0.02, rng.choice("NAR"), rng.choice("OF"), day + dt.timedelta(days=o % 9))
             for o in range(1, 95) for n in range(1, 2 + o % 4)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{scratch}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{scratch}/lineitem.parquet")
    return Relations(spark, scratch)


def dealings(df):
    """Columns of the shuffles that a plan has before it runs, without repeats."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {x.split("#")[0] for x in plan.split("Exchange hashpartitioning(")[1:]}


class Plain:
    """The relations as another kind, which is dealt by nothing."""

    def __init__(self, rel):
        self._rel = rel

    def __getattr__(self, name):
        return getattr(self._rel, name)


@pytest.mark.parametrize("query", [u03_claims, u04_events])
def test_writes_of_dealt_rows_shuffle_only_the_spine(tables, query):
    got, plain = query(tables), query(Plain(tables))
    assert dealings(got) == {"l_orderkey", "o_orderkey"}
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) != []


def test_mart_merge_of_dealt_rows_equals_plain(tables):
    from claimsight.sources.mapping import dealt
    (claims, predictions), by = dealt(tables, "claims", "fraud_predictions")
    both = _With(tables, claims=claims, fraud_predictions=predictions)
    got, plain = fct_claims(both, by).drop(*by), fct_claims(tables)
    assert dealings(got) == {"l_orderkey", "o_orderkey"}
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) != []
    touched = predictions.where("model_version = 'v2.1'").select(*by, "claim_id").distinct()
    stored = plain.withColumn("risk_tier", F.lit("old")).withColumn("built_in", F.lit(1))
    merged = [merge_fct_claims(stored, both, touched, 2, by), merge_fct_claims(stored, tables, touched.select("claim_id"), 2)]
    one, other = (sorted(map(str, m.collect())) for m in merged)
    assert one == other and {r.built_in for r in merged[0].collect()} == {1, 2}


def test_split_keeps_repeats_and_rows_without_a_key(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (1, None, 6), (2, "b", 7)], "k int, claim_id string, v int")
    touched = spark.createDataFrame([(1, "a"), (1, None), (9, "z")], "k int, claim_id string")
    for key in (["k", "claim_id"], ["claim_id"]):
        hit, rest = split_by(rows, touched.select(*key), key)
        assert sorted(r.v for r in hit.collect()) == [5, 5] and sorted(r.v for r in rest.collect()) == [6, 7]
        assert sorted(hit.columns) == sorted(rows.columns)


def test_events_without_an_id_are_appended_and_stored_ones_stay(spark):
    kind = "event_id string, claim_id string, event_type string"
    target = spark.createDataFrame([("e1", "c", "x"), ("e1", "c", "x"), (None, "c", "y")], kind)
    batch = spark.createDataFrame([("e1", "c", "late", 1), (None, "c", "z", 1), ("e2", "c", "b", 2), ("e2", "c", "a", 1)], kind + ", _arrival int")
    got = sorted(map(tuple, append_events(target, batch).collect()), key=str)
    assert got == sorted([("e1", "c", "x"), ("e1", "c", "x"), (None, "c", "y"), (None, "c", "z"), ("e2", "c", "a")], key=str)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_fold_by_blocks_equals_sequential(spark, block):
    rng, t0 = random.Random(block), dt.datetime(2001, 1, 1)
    stored = [_row(f"c{i}", "submitted", t0 + dt.timedelta(hours=i % 5)) for i in range(6)]
    updates = [_row(f"c{rng.randrange(9)}", rng.choice(["approved", "paid"]), t0 + dt.timedelta(hours=rng.randrange(12)),
                    rng.choice([None, 50]), rng.choice([None, "PA"]), member=f"m{n}") for n in range(150)]
    target = spark.createDataFrame(stored, SCHEMA).withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))
    batch = spark.createDataFrame([(*u[:9], None, *u[10:], n, u[9]) for n, u in enumerate(updates)], SCHEMA + ", _arrival bigint, paid int") \
        .withColumn("amount_approved", F.col("paid").cast("decimal(15,2)")).drop("paid")
    got = [upsert_claims(target, batch, LOAD, block=block)]
    got.append(upsert_claims(target.withColumn("k", F.substring("claim_id", 2, 9)), batch.withColumn("k", F.substring("claim_id", 2, 9)), LOAD, block=block, dealt=("k",)))
    for state in got:
        assert {r.claim_id: (r.amount_approved, r.status, r.prior_auth_number, r.updated_at, r.member_id) for r in state.collect()} == _sequential(stored, updates)
