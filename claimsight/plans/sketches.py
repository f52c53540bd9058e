"""Mergeable monthly sketches (A06 distinct counts, A13 quantiles).

A month of claims is reduced once to one row per member and one per employer,
with a HyperLogLog sketch of distinct values and a KLL sketch of amounts.  Any
range of months is answered by merging its rows, without the claims; a month
that receives claims again is sketched again and replaces its own folder only.

Errors: a distinct count has a standard error of 1.04 / sqrt(2**LG_K) = 1.6 %
(small sets are held exactly); the rank of a quantile is off by at most 1.33 %
of the rows with 99 % confidence at KLL_K = 200.  Merging months does not add to
either.  The exact queries of these counts stay as they are.

Nulls are in no sketch; a claim without service date belongs to no range.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import register
from ..session import checkpoint_dir

LG_K = 12
KLL_K = 200
#: three standard errors of a distinct count, twice the stated rank error of a quantile
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 2 * 0.0133


def _month() -> Column:
    return F.trunc("date_of_service", "month").alias("month")


def member_months(claims: DataFrame) -> DataFrame:
    """member_id, month, claims and the sketch of the member's providers (partial sketches are merged after the shuffle)."""
    return claims.groupBy("member_id", _month()).agg(
        F.count(F.lit(1)).alias("claims"), F.hll_sketch_agg("provider_id", LG_K).alias("providers"))


def employer_months(claims: DataFrame, members: DataFrame) -> DataFrame:
    """employer_id, month, claims and the sketches of the employer's claiming members and of the amounts."""
    of = members.where("employer_id is not null").select("member_id", "employer_id")
    rows = claims.select("member_id", "date_of_service", F.col("amount_claimed").cast("double").alias("amount")).join(of, "member_id")
    return rows.groupBy("employer_id", _month()).agg(
        F.count(F.lit(1)).alias("claims"), F.hll_sketch_agg("member_id", LG_K).alias("members"),
        F.kll_sketch_agg_double("amount", F.lit(KLL_K)).alias("amounts"))


class MonthlySketches:
    """Sketch rows stored by month under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def refresh(self, months: DataFrame) -> None:
        """Replace the months that ``months`` holds, and no other."""
        (months.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month").parquet(self.path))

    def between(self, first: _dt.date, last: _dt.date) -> DataFrame:
        """Rows of the months from ``first`` to ``last``, both included (a partition filter)."""
        return self.spark.read.parquet(self.path).where(F.col("month").between(F.lit(first), F.lit(last)))


def providers_of_members(rows: DataFrame) -> DataFrame:
    """member_id, claims and estimated distinct providers over the months in ``rows``."""
    return rows.groupBy("member_id").agg(F.sum("claims").alias("claims"), F.hll_sketch_estimate(F.hll_union_agg("providers")).alias("providers"))


def amounts_of_employers(rows: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """employer_id, claims, estimated distinct members and a quantile of the amounts for each name in ``ranks``."""
    merged = rows.groupBy("employer_id").agg(
        F.sum("claims").alias("claims"), F.hll_sketch_estimate(F.hll_union_agg("members")).alias("members"),
        F.kll_merge_agg_double("amounts").alias("__amounts"))
    quantiles = [F.when(F.kll_sketch_get_n_double("__amounts") > 0, F.kll_sketch_get_quantile_double("__amounts", F.lit(p))).alias(name)
                 for name, p in ranks.items()]
    return merged.select("employer_id", "claims", "members", *quantiles)


def close_count(estimate: Column, exact: Column) -> Column:
    """Whether a distinct count is within its stated error (and half a row, as estimates are whole)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(0.5), F.lit(DISTINCT_ERROR) * exact)


FIRST, LAST, BEHIND = _dt.date(1997, 3, 1), _dt.date(1999, 8, 1), _dt.date(1999, 9, 1)
RANKS = {"median_amount": 0.5, "p90_amount": 0.9}
_RANGE = f"date_of_service >= DATE '{FIRST}' AND date_of_service < DATE '{BEHIND}'"


def _store(spark: SparkSession, months: DataFrame, name: str) -> MonthlySketches:
    kept = MonthlySketches(spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}")
    kept.refresh(months)
    return kept


def _in_range(claims: DataFrame) -> DataFrame:
    return claims.where((F.col("date_of_service") >= F.lit(FIRST)) & (F.col("date_of_service") < F.lit(BEHIND)))


@register("sketch_a06_member_providers", sql=(
    "SELECT member_id, COUNT(*) AS claims, COUNT(DISTINCT provider_id) AS providers, TRUE AS sketch_within_error "
    f"FROM claims WHERE {_RANGE} GROUP BY member_id"))
def member_providers_checked(rel) -> DataFrame:
    """Distinct providers of every member over 30 months, exact, beside the union of the stored months."""
    kept = _store(rel.claims.sparkSession, member_months(rel.claims), "sketch-members")
    merged = providers_of_members(kept.between(FIRST, LAST)).withColumnRenamed("providers", "__estimate")
    exact = _in_range(rel.claims).groupBy("member_id").agg(F.count_distinct("provider_id").alias("providers"))
    return merged.join(exact, "member_id", "full").select(
        "member_id", "claims", "providers", F.coalesce(close_count(F.col("__estimate"), F.col("providers")), F.lit(False)).alias("sketch_within_error"))


@register("sketch_a13_employer_amounts", sql=(
    "SELECT m.employer_id, COUNT(*) AS claims, COUNT(DISTINCT c.member_id) AS members, TRUE AS members_within_error, "
    "TRUE AS median_within_error, TRUE AS p90_within_error FROM claims c JOIN members m ON m.member_id = c.member_id "
    f"WHERE m.employer_id IS NOT NULL AND {_RANGE} GROUP BY m.employer_id"))
def employer_amounts_checked(rel) -> DataFrame:
    """Median and 90th percentile of an employer's amounts over 30 months from the stored months.

    A quantile is checked by its rank: the shares of amounts below it and up to it enclose the wanted one.
    """
    kept = _store(rel.claims.sparkSession, employer_months(rel.claims, rel.members), "sketch-employers")
    merged = amounts_of_employers(kept.between(FIRST, LAST), RANKS).withColumnRenamed("members", "__estimate")
    of = rel.members.where("employer_id is not null").select("member_id", "employer_id")
    rows = _in_range(rel.claims).select("member_id", F.col("amount_claimed").cast("double").alias("amount")).join(of, "member_id")
    shares = [F.avg(test.cast("double")).alias(f"__{name}_{side}") for name in RANKS
              for side, test in (("below", F.col("amount") < F.col(name)), ("upto", F.col("amount") <= F.col(name)))]
    exact = rows.join(merged.select("employer_id", *RANKS), "employer_id").groupBy("employer_id").agg(F.count_distinct("member_id").alias("members"), *shares)
    within = [F.coalesce((F.col(f"__{name}_below") <= p + RANK_ERROR) & (F.col(f"__{name}_upto") >= p - RANK_ERROR), F.lit(False))
              .alias(f"{name.split('_')[0]}_within_error") for name, p in RANKS.items()]
    return merged.join(exact, "employer_id", "full").select(
        "employer_id", "claims", "members", F.coalesce(close_count(F.col("__estimate"), F.col("members")), F.lit(False)).alias("members_within_error"), *within)
