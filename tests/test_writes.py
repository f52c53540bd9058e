import datetime as dt
import random
from decimal import Decimal as Dm

from pyspark.sql import functions as F

from claimsight.operators.writes import CLAIM_COLS, VersionedTable, append_events, upsert_claims, upsert_latest

LOAD = dt.datetime(2001, 8, 2, 6)
SCHEMA = ("claim_id string, member_id string, provider_id string, date_of_service date, date_submitted date, "
          "procedure_code string, diagnosis_code string, quantity int, amount_claimed decimal(15,2), "
          "amount_approved decimal(15,2), status string, submission_channel string, is_emergency boolean, "
          "prior_auth_number string, submitted_at timestamp_ntz, updated_at timestamp_ntz")


def _row(cid, status, upd, approved=None, pa=None, member="m"):
    d = dt.date(2001, 1, 1)
    return (cid, member, "p", d, d, "CONS-01", "DX01", 1, Dm("100.00"), approved, status, "api", False, pa,
            dt.datetime(2001, 1, 1), upd)


def _sequential(stored, updates):
    """Row-at-a-time reference of the recency guard (what the database routine does)."""
    state = {r[0]: list(r) for r in stored}
    for u in updates:
        cur = state.get(u[0])
        if cur is None:
            state[u[0]] = list(u)
        elif cur[15] <= u[15]:
            cur[9] = u[9] if u[9] is not None else cur[9]
            cur[13] = u[13] if u[13] is not None else cur[13]
            cur[10], cur[15] = u[10], u[15]
    return {k: (v[9], v[10], v[13], v[15], v[1]) for k, v in state.items()}


def test_claim_upsert_fold_equals_sequential_for_any_batch_split(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2001, 1, 1)
    stored = [_row(f"c{i}", "submitted", t0 + dt.timedelta(hours=i % 5)) for i in range(20)]
    updates = []
    for n in range(400):
        cid = f"c{rnd.randrange(30)}"
        updates.append(_row(cid, rnd.choice(["approved", "rejected", "paid"]), t0 + dt.timedelta(hours=rnd.randrange(12)),
                            rnd.choice([None, Dm("50.00"), Dm("75.00")]), rnd.choice([None, "PA1"]), member=f"m{n}"))
    expected = _sequential(stored, updates)
    target = spark.createDataFrame(stored, SCHEMA).withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))
    for cuts in ([400], [100, 300], [37, 200, 163]):
        state, pos = target, 0
        for n in cuts:
            part = [u + (pos + i,) for i, u in enumerate(updates[pos:pos + n])]
            # a tiny arrival block exercises the two-level running max across many blocks
            state = upsert_claims(state, spark.createDataFrame(part, SCHEMA + ", _arrival bigint"), LOAD, block=7)
            state = spark.createDataFrame(state.collect(), state.schema)  # materialise between batches
            pos += n
        got = {r.claim_id: (r.amount_approved, r.status, r.prior_auth_number, r.updated_at, r.member_id) for r in state.collect()}
        assert got == expected


def test_event_append_is_idempotent(spark):
    t = spark.createDataFrame([("e1", "c1", "submitted")], "event_id string, claim_id string, event_type string")
    b = spark.createDataFrame([("e1", "c1", "paid", 1), ("e2", "c1", "paid", 2), ("e2", "c1", "closed", 3)],
                              "event_id string, claim_id string, event_type string, _arrival int")
    once = append_events(t, b)
    twice = append_events(spark.createDataFrame(once.collect(), once.schema), b)
    rows = sorted(tuple(r) for r in twice.collect())
    assert rows == [("e1", "c1", "submitted"), ("e2", "c1", "paid")]


def test_latest_upsert_last_arrival_wins(spark):
    t = spark.createDataFrame([("a", 1, None)], "k string, v int, _loaded_at timestamp_ntz")
    b = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("b", 9, 1)], "k string, v int, _arrival int")
    got = {r.k: r.v for r in upsert_latest(t, b, "k", LOAD).collect()}
    assert got == {"a": 3, "b": 9}


def test_versioned_table_commits_new_versions(spark, scratch):
    vt = VersionedTable(spark, "t", root=scratch)
    assert vt.read() is None
    vt.commit(spark.range(3))
    vt.commit(spark.range(5))
    assert vt.current_version() == 2 and vt.read().count() == 5
