import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimsight.operators.windows import asof_rate, rolling_counts, rolling_counts_by_slot


def test_rolling_counts_match_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2001, 1, 1)
    rows = [(f"c{i}", f"p{rnd.randrange(3)}", base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))) for i in range(300)]
    df = spark.createDataFrame(rows, "claim_id string, provider_id string, ts timestamp_ntz")
    windows = {"h1": 3600, "d1": 86400, "d7": 7 * 86400}
    got = {r.claim_id: (r.h1, r.d1, r.d7) for r in rolling_counts(df, "provider_id", "ts", windows, "claim_id").collect()}
    for cid, p, t in rows:
        exp = tuple(sum(1 for _, q, u in rows if q == p and t - dt.timedelta(seconds=w) <= u <= t) for w in windows.values())
        assert got[cid] == exp


@pytest.mark.parametrize("slot", [60, 3600])
def test_slot_counts_match_brute_force(spark, slot):
    """A hot provider, ties, rows at the very start and end of slots and windows, times before 1970, no key, no time."""
    rnd = random.Random(11)
    base = dt.datetime(1969, 12, 30)
    at = [base + dt.timedelta(seconds=rnd.choice([0, 1, 59, 60, 3599]) + 3600 * rnd.randrange(24 * 5)) for _ in range(250)]
    rows = [(f"p{max(0, rnd.randrange(6) - 3)}", t) for t in at] + [("p0", at[0])] * 20
    df = spark.createDataFrame([*rows, (None, at[0]), ("p0", None)], "k string, ts timestamp_ntz")
    windows = {"h1": 3600, "h6": 6 * 3600, "d1": 86400, "d4": 4 * 86400}
    got = {(r.k, r.at): (r.h1, r.h6, r.d1, r.d4) for r in rolling_counts_by_slot(df, "k", "ts", windows, "at", slot).collect()}
    epoch = dt.datetime(1970, 1, 1)
    expected = {(k, int((t - epoch).total_seconds())): tuple(
        sum(1 for q, u in rows if q == k and t - dt.timedelta(seconds=w) <= u <= t) for w in windows.values()) for k, t in rows}
    assert got == expected
    assert rolling_counts_by_slot(df.limit(0), "k", "ts", windows, "at").collect() == []
    with pytest.raises(ValueError):
        rolling_counts_by_slot(df, "k", "ts", {"odd": 90 * 60}, "at")


def test_asof_rate_matches_brute_force(spark):
    """Repeated instants, sums with another type, keys without events, events without time."""
    rnd = random.Random(12)
    base = dt.datetime(2001, 1, 1)
    def when():
        return base + dt.timedelta(hours=6 * rnd.randrange(40))
    events = [(f"p{rnd.randrange(2)}", when(), rnd.choice([None, 1, 2, 5])) for _ in range(120)]
    probes = [(f"c{i}", f"p{rnd.randrange(3)}", when()) for i in range(80)]
    ev = spark.createDataFrame([*events, ("p0", None, 7)], "k string, t timestamp_ntz, v int")
    pr = spark.createDataFrame(probes, "id string, k string, ts timestamp_ntz")
    got = {r.id: (r.prior_events, int(r.prior_flagged)) for r in asof_rate(ev, pr, "k", "t", "ts", "v", "id", cast="decimal(15,2)").collect()}
    for i, k, t in probes:
        before = [v for q, u, v in events if q == k and u < t]
        assert got[i] == (len(before), sum(v or 0 for v in before))


def test_asof_rate_uses_only_earlier_events(spark):
    base = dt.datetime(2001, 1, 31, 12)
    ev = spark.createDataFrame([("p", base - dt.timedelta(days=40), True), ("p", base, True),
                                ("p", base - dt.timedelta(hours=1), False), ("q", base, True)],
                               "provider_id string, t timestamp_ntz, f boolean")
    pr = spark.createDataFrame([("c1", "p", base), ("c2", "p", base + dt.timedelta(days=1)), ("c3", "q", base)],
                               "claim_id string, provider_id string, submitted_at timestamp_ntz")
    got = {r.claim_id: (r.prior_events, r.prior_flagged) for r in asof_rate(ev, pr, "provider_id", "t", "submitted_at", "f", "claim_id").collect()}
    assert got == {"c1": (2, 1), "c2": (3, 2), "c3": (0, 0)}


def test_forward_distinct_counts_match_brute_force(spark):
    rnd = random.Random(5)
    base = dt.datetime(2001, 1, 1)
    rows = [(f"c{i}", f"m{rnd.randrange(3)}", f"p{rnd.randrange(6)}", base + dt.timedelta(days=rnd.randrange(40)))
            for i in range(200)]
    df = spark.createDataFrame(rows, "claim_id string, member_id string, provider_id string, ts timestamp_ntz")
    got = {r.claim_id: r.n for r in rolling_counts(df, "member_id", "ts", {"n": 6 * 86400}, "claim_id",
                                                   distinct_col="provider_id", forward=True).collect()}
    for cid, m, _, t in rows:
        exp = len({p for _, mm, p, u in rows if mm == m and t <= u <= t + dt.timedelta(days=6)})
        assert got[cid] == exp


def test_day_block_windows_match_plain_windows(spark):
    from pyspark.sql import Window, functions as F
    from claimsight.operators.windows import days_since_previous, next_time_in_key, running_sum_by_day
    rnd = random.Random(9)
    base = dt.datetime(2001, 1, 1)
    rows = [(f"c{i:03d}", f"m{rnd.randrange(3)}", base + dt.timedelta(days=rnd.randrange(10), hours=rnd.choice([0, 5])),
             rnd.randrange(100)) for i in range(150)]
    df = spark.createDataFrame(rows, "cid string, k string, ts timestamp_ntz, v int").withColumn("d", F.to_date("ts"))
    w = Window.partitionBy("k").orderBy("d", "cid")
    plain = {r.cid: (r.rs, r.gap) for r in df.select(
        "cid", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.datediff("d", F.lag("d").over(w)).alias("gap")).collect()}
    rs = {r.cid: r.running for r in running_sum_by_day(df, "k", "d", "cid", "v").collect()}
    gp = {r.cid: r.gap for r in days_since_previous(df, "k", "d", "cid").collect()}
    assert {c: (rs[c], gp[c]) for c in rs} == plain
    wt = Window.partitionBy("k").orderBy("ts", "cid")
    lead = {r.cid: r.n for r in df.select("cid", F.lead("ts").over(wt).alias("n")).collect()}
    assert {r.cid: r.next_ts for r in next_time_in_key(df, "k", "ts", "cid").collect()} == lead


def test_features_know_nothing_after_submission(spark, rel):
    """Approvals, vitals and claims from the future change no feature of the claims before them."""
    import datetime as dt
    from types import SimpleNamespace

    from claimsight.plans.features import claim_features
    later = F.lit(dt.datetime(2100, 1, 1)).cast("timestamp_ntz")
    claims = rel.claims.withColumn("updated_at", F.when(F.col("amount_approved").isNull(), later).otherwise(F.col("updated_at"))) \
        .withColumn("amount_approved", F.coalesce("amount_approved", F.lit(1000).cast("decimal(15,2)")))
    future = rel.claims.limit(50).withColumn("claim_id", F.concat("claim_id", F.lit("-later"))).withColumn("submitted_at", later) \
        .withColumn("updated_at", later).withColumn("date_submitted", F.lit("2100-01-01").cast("date")).withColumn("date_of_service", F.lit("2100-01-01").cast("date"))
    vitals = rel.vitals.unionByName(rel.claims.select("claim_id").join(rel.vitals, "claim_id", "left").select(*rel.vitals.columns).withColumn("_loaded_at", later))
    names = ("claims", "members", "plans", "icd10_codes", "vitals", "prescriptions")
    planted = SimpleNamespace(**{n: getattr(rel, n) for n in names} | {"claims": claims.unionByName(future), "vitals": vitals})
    a, b = claim_features(rel), claim_features(planted).filter(~F.col("claim_id").endswith("-later"))
    assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


@pytest.mark.parametrize("span", [1, 4])
def test_distinct_counts_over_wide_buckets(spark, span):
    rnd = random.Random(6)
    base = dt.datetime(1969, 12, 1)
    rows = [(f"c{i}", f"m{rnd.randrange(2)}", f"p{rnd.randrange(6)}", base + dt.timedelta(days=rnd.randrange(80))) for i in range(200)]
    df = spark.createDataFrame([*rows, ("none", "m0", "p0", None)], "claim_id string, member_id string, provider_id string, ts timestamp_ntz")
    got = [(r.claim_id, r.n) for r in rolling_counts(df, "member_id", "ts", {"n": 6 * 86400}, "claim_id", distinct_col="provider_id", span=span).collect()]
    assert sorted(got) == sorted([(c, len({p for _, n, p, u in rows if n == m and t - dt.timedelta(days=6) <= u <= t})) for c, m, _, t in rows] + [("none", 1)])


def test_slot_counts_shuffle_few_copies(spark):
    """Rows are dealt 1.25 times on average, however many windows there are; the marks are made after that."""
    df = spark.range(4000).selectExpr("concat('p', id % 3) as k", "timestamp_seconds(id * 3600) as ts")
    out = rolling_counts_by_slot(df, "k", "ts", {f"w{n}": n * 3600 for n in (1, 2, 6, 24, 100)}, "at")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "REPARTITION_BY_NUM" in plan and plan.index("REPARTITION_BY_NUM") > plan.index("inline(")     # the generate above the exchange
    assert plan.count("Exchange hashpartitioning") == 2


def test_counts_carried_by_rows(spark):
    """Each row has the counts at its second: a hot provider, ties, block ends, rows without key or time."""
    from claimsight.operators.windows import with_slot_counts
    rnd = random.Random(13)
    base = dt.datetime(1969, 12, 30)
    rows = [(f"c{i}", f"p{max(0, rnd.randrange(5) - 2)}", base + dt.timedelta(seconds=rnd.choice([0, 1, 3599]) + 3600 * rnd.randrange(24 * 6))) for i in range(200)]
    rows += [("d", "p0", rows[0][2])] * 3 + [("k", None, rows[0][2]), ("t", "p0", None)]
    windows = {"h1": 3600, "h6": 6 * 3600, "d1": 86400}
    out = with_slot_counts(spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz"), "k", "ts", windows)
    expected = [(i, k, t, *[sum(1 for _, q, u in rows if q == k and u is not None and t - dt.timedelta(seconds=w) <= u <= t) if k and t else None for w in windows.values()])
                for i, k, t in rows]
    assert sorted(map(repr, expected)) == sorted(repr((r.id, r.k, r.ts, r.h1, r.h6, r.d1)) for r in out.collect())


def test_member_windows_carried_by_rows(spark):
    from claimsight.operators.windows import with_distinct_in_days, with_prior_sum
    rnd = random.Random(14)
    base = dt.datetime(2001, 1, 1)
    rows = [(f"c{i}", f"m{rnd.randrange(3)}", f"p{rnd.randrange(5)}", base + dt.timedelta(days=rnd.randrange(30)), base + dt.timedelta(hours=6 * rnd.randrange(100)),
             rnd.choice([None, 1, 2, 5])) for i in range(120)] + [("late", "m0", "p0", base, None, 7)]
    df = spark.createDataFrame(rows, "id string, m string, p string, asked timestamp_ntz, known timestamp_ntz, v int").withColumn("day", F.to_date("asked"))
    df = with_prior_sum(with_distinct_in_days(df, "m", "day", "p", 7, "n"), ["m"], "known", "asked", "v", "s")
    got = {r.id: (r.n, r.s) for r in df.collect()}
    assert got == {i: (len({q for _, n, q, u, _, _ in rows if n == m and dt.timedelta(0) <= a.replace(hour=0) - u.replace(hour=0) <= dt.timedelta(days=6)}),
                       sum(w or 0 for _, n, _, _, u, w in rows if n == m and u is not None and u < a)) for i, m, _, a, _, _ in rows}


def test_claims_are_dealt_twice(spark):
    """Evidence and verdicts meet the claims in the buckets of the spine; the claims go to the providers and to the members, and nowhere else."""
    import re

    from claimsight.plans.features import claim_features, label_set, verdicts
    from claimsight.sources.mapping import Relations, dealt, dealt_spine
    rel = Relations(spark, "/root/testdata/sf0.001")
    labelled = claim_features(rel, verdict=True)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert len([x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)", plan) if "claim_id" in x or "_b" in x]) == 1
    assert len(re.findall("Exchange hashpartitioning", plan)) <= 8
    plain = label_set(claim_features(rel), rel.fraud_investigation_outcomes)
    assert labelled.count() == plain.count() > 0 and labelled.exceptAll(plain.select(labelled.columns)).count() == 0
    (outcomes,), by = dealt(dealt_spine(rel), "fraud_investigation_outcomes")
    assert by and "Exchange" not in verdicts(outcomes, by)._jdf.queryExecution().executedPlan().toString()


def test_repeated_claims(spark, rel):
    """A claim that comes twice has the features of both its rows on each of them, as joins by its id gave it."""
    from types import SimpleNamespace

    from claimsight.plans.features import claim_features
    one = rel.claims.orderBy("claim_id").limit(1)
    names = ("members", "plans", "icd10_codes", "vitals", "prescriptions")
    twice = SimpleNamespace(**{n: getattr(rel, n) for n in names} | {"claims": rel.claims.unionByName(one)})
    features = claim_features(twice)
    assert features.join(one, "claim_id", "left_semi").count() == 16 and features.join(one, "claim_id", "left_anti").count() == rel.claims.count() - 1
