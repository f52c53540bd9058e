"""Stored monthly sketches: merged ranges against exact values, refresh of single months, odd rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from claimsight.plans.sketches import (DISTINCT_ERROR, RANK_ERROR, MonthlySketches, amounts_of_employers, employer_months, member_months,
                                       providers_of_members)

RANKS = {"median_amount": 0.5, "p90_amount": 0.9}


def _many(spark, n=60_000):
    """One hot member with a new provider on nearly every claim, over twelve months that share providers."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), i % 50)).alias("member_id"),
        F.concat(F.lit("p"), (i * 7919) % 30_003).alias("provider_id"),
        F.add_months(F.lit(dt.date(2000, 1, 5)), (i % 12).cast("int")).alias("date_of_service"),
        (F.pow((i * 104_729) % 10_007, F.lit(2.0)) / 1000).cast("decimal(15,2)").alias("amount_claimed"))


def _members(spark):
    rows = [("hot", "big")] + [(f"m{k}", "small" if k % 5 else None) for k in range(50)]
    return spark.createDataFrame(rows, "member_id string, employer_id string")


def test_merged_months_are_within_the_stated_errors(spark, scratch):
    claims, first, last = _many(spark).cache(), dt.date(2000, 3, 1), dt.date(2000, 9, 1)
    inside = claims.where("date_of_service >= '2000-03-01' and date_of_service < '2000-10-01'")
    kept = MonthlySketches(spark, os.path.join(scratch, "members"))
    kept.refresh(member_months(claims))
    got = {r["member_id"]: r for r in providers_of_members(kept.between(first, last)).collect()}
    exact = inside.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("provider_id").alias("p")).collect()
    assert len(got) == len(exact) and max(r["p"] for r in exact) > 5_000
    for r in exact:
        assert got[r["member_id"]]["claims"] == r["n"]
        assert abs(got[r["member_id"]]["providers"] - r["p"]) <= max(0.5, DISTINCT_ERROR * r["p"])
    # adding up the months would count shared providers again
    summed = kept.between(first, last).where("member_id = 'hot'").agg(F.sum(F.hll_sketch_estimate("providers"))).first()[0]
    assert summed > 1.05 * got["hot"]["providers"]

    kept = MonthlySketches(spark, os.path.join(scratch, "employers"))
    kept.refresh(employer_months(claims, _members(spark)))
    got = {r["employer_id"]: r for r in amounts_of_employers(kept.between(first, last), RANKS).collect()}
    assert set(got) == {"big", "small"} and got["big"]["members"] == 1 and got["small"]["members"] == 40
    for employer, r in got.items():
        own = inside.join(_members(spark), "member_id").where(F.col("employer_id") == employer)
        for name, p in RANKS.items():
            low, high = own.agg(F.avg((F.col("amount_claimed").cast("double") < r[name]).cast("double")),
                                F.avg((F.col("amount_claimed").cast("double") <= r[name]).cast("double"))).first()
            assert low <= p + RANK_ERROR and high >= p - RANK_ERROR
    claims.unpersist()


def test_refresh_replaces_single_months(spark, scratch):
    schema = "member_id string, provider_id string, date_of_service date, amount_claimed decimal(15,2)"
    rows = [("a", "x", dt.date(2000, 1, 3), None), ("a", "y", dt.date(2000, 2, 3), None), ("a", "y", dt.date(2000, 2, 9), None)]
    kept = MonthlySketches(spark, os.path.join(scratch, "months"))
    kept.refresh(member_months(spark.createDataFrame(rows, schema)))

    def january():
        return sorted(os.listdir(f"{kept.path}/month=2000-01-01"))
    before = january()
    late = [*rows[1:], ("a", "z", dt.date(2000, 2, 28), None), (None, "z", dt.date(2000, 2, 28), None), ("b", None, dt.date(2000, 2, 1), None)]
    for _ in range(2):              # again: the same rows
        kept.refresh(member_months(spark.createDataFrame(late, schema)))
        got = {r["member_id"]: (r["claims"], r["providers"]) for r in
               providers_of_members(kept.between(dt.date(2000, 1, 1), dt.date(2000, 2, 1))).collect()}
        assert got == {"a": (4, 3), None: (1, 1), "b": (1, 0)}
    assert january() == before
    # a claim without date is in no range, a range without rows is empty
    kept.refresh(member_months(spark.createDataFrame([("a", "q", None, None)], schema)))
    assert providers_of_members(kept.between(dt.date(2000, 1, 1), dt.date(2000, 2, 1))).where("member_id = 'a'").first()["providers"] == 3
    assert kept.between(dt.date(2010, 1, 1), dt.date(2010, 2, 1)).count() == 0


def test_amounts_without_a_value(spark, scratch):
    claims = spark.createDataFrame([("hot", "x", dt.date(2000, 1, 3), None)], "member_id string, provider_id string, date_of_service date, amount_claimed decimal(15,2)")
    kept = MonthlySketches(spark, os.path.join(scratch, "none"))
    kept.refresh(employer_months(claims, _members(spark)))
    row = amounts_of_employers(kept.between(dt.date(2000, 1, 1), dt.date(2000, 1, 1)), RANKS).first()
    assert (row["employer_id"], row["claims"], row["median_amount"], row["p90_amount"]) == ("big", 1, None, None)
