"""SMOTE oversampling of the rare class, as joins and windows.

The neighbours of a minority row are its ``k`` nearest inside the minority class on
standardised features, exactly: rows are searched in leaves of about ``most`` rows, and
each row also in every other leaf that may hold a nearer one (:mod:`..operators.nearest`).

A synthetic row lies at a seeded place on the line from its minority row to one
of its neighbours; every choice is a hash of (id, copy, seed), so a rerun gives
the same rows.  The majority class is only counted.  The number of synthetic rows
is exact: each minority row gives ``total div minority`` of them, and the first
``total mod minority`` rows by hash give one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.nearest import nearest
from ..registry import register
from .features import FEATURE_COLUMNS, training_rows

SEED = 42
#: rows of a leaf that are searched together
MOST = 10_000
#: hash ranges of the exact share of additional copies; their counts are a table of this size
RANGE_BITS = 10


def _hash_share(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def neighbours(rows: DataFrame, features: list[str], key: str, k: int = 5, seed: int = SEED, most: int = MOST) -> DataFrame:
    """``key`` and ``near``: array<struct<distance, id>> of the ``k`` nearest other rows (all, if fewer) on standardised features, nearest first."""
    # nine digits of a deviation are the same on any partitioning
    spread = [float(f"{s or 0.0:.9g}") for s in rows.agg(*[F.stddev_samp(F.when(F.abs(c) < float("inf"), F.col(c))) for c in features]).first()]
    place = F.array(*[F.col(c) / F.lit(s) if s > 0 else F.lit(0.0) for c, s in zip(features, spread, strict=True)])
    return nearest(rows.select(key, place.alias("_x")), key, "_x", k, most, seed)


def copies_of(rows: DataFrame, key: str, minority: int, total: int, seed: int = SEED) -> DataFrame:
    """``rows`` with ``copies``: synthetic rows of each, ``total`` together."""
    each, more = divmod(total, minority)
    ranged = rows.withColumn("_hash", F.xxhash64(F.col(key), F.lit(seed))).withColumn("_range", F.shiftright("_hash", 64 - RANGE_BITS).cast("int"))
    counts = ranged.groupBy("_range").count()                       # at most 2 ** RANGE_BITS rows
    before = counts.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy("_hash", key))
    return (ranged.join(F.broadcast(before), "_range").withColumn("copies", F.lit(each) + (place <= more).cast("int"))
            .drop("_hash", "_range", "_before"))


def smote(df: DataFrame, features: list[str], key: str = "claim_id", label: str = "label", rare: int | None = None, ratio: float = 1.0, k: int = 5,
          seed: int = SEED, **search) -> DataFrame:
    """synthetic_id, base_id, neighbour_id, gap, the features and the label: as many rows as lift the rare class to ``ratio`` of the other.

    ``rare`` is the label of fewer rows where it is not given (of equal ones, 1).

    A minority row without neighbours is its own; without minority rows, or where the ratio is met, there are none.
    """
    ones, zeros = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    rare = int(ones <= zeros) if rare is None else rare
    minority, majority = (ones, zeros) if rare == 1 else (zeros, ones)
    total = max(0, round(ratio * majority) - minority) if minority else 0
    mine = df.where(F.col(label) == rare).select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    shape = "synthetic_id string, base_id string, neighbour_id string, gap double, " + ", ".join(f"`{c}` double" for c in features) + f", `{label}` int"
    if not total:
        return df.sparkSession.createDataFrame([], shape)
    near = neighbours(mine, features, key, k, seed=seed, **search)
    base = copies_of(mine, key, minority, total, seed).join(near, key, "left")
    drawn = base.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    pick = F.floor(_hash_share(F.col(key), F.col("_copy"), F.lit(seed)) * F.size("near")).cast("int")
    drawn = drawn.withColumn("_neighbour", F.when(F.size("near") > 0, F.get("near", pick)["id"]).otherwise(F.col(key)))
    drawn = drawn.withColumn("gap", _hash_share(F.col(key), F.col("_copy"), F.lit(seed), F.lit("gap")))
    other = mine.select(F.col(key).alias("_neighbour"), F.struct(*features).alias("_other"))
    line = [(F.col(c) + F.col("gap") * (F.col("_other")[c] - F.col(c))).alias(c) for c in features]
    return drawn.join(other, "_neighbour").select(
        F.concat_ws("#", F.col(key).cast("string"), "_copy").alias("synthetic_id"), F.col(key).cast("string").alias("base_id"),
        F.col("_neighbour").cast("string").alias("neighbour_id"), "gap", *line, F.lit(rare).alias(label))


def between(synthetic: DataFrame, df: DataFrame, features: list[str], key: str = "claim_id", label: str = "label") -> DataFrame:
    """``synthetic_id`` and ``inside``: whether both parents are rows of its class and every feature lies between theirs."""
    known = df.select(F.col(key).cast("string").alias("_id"), F.col(label), F.struct(*[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]).alias("_at"))
    both = (synthetic.join(known.select(F.col("_id").alias("base_id"), label, F.col("_at").alias("_a")), ["base_id", label], "left")
            .join(known.select(F.col("_id").alias("neighbour_id"), label, F.col("_at").alias("_b")), ["neighbour_id", label], "left"))

    def inside(c):
        slack = 1e-9 * (1 + F.abs(F.col(c)))
        return F.col(c).between(F.least(F.col("_a")[c], F.col("_b")[c]) - slack, F.greatest(F.col("_a")[c], F.col("_b")[c]) + slack)
    return both.select("synthetic_id", F.coalesce(F.forall(F.array(*[inside(c) for c in features]), lambda x: x), F.lit(False)).alias("inside"))


@register("train_x14_smote")
def smote_rows(rel) -> DataFrame:
    """Synthetic rows of the rarer verdict up to the number of the other."""
    return smote(training_rows(rel), FEATURE_COLUMNS)


@register("train_x14_smote_summary", sql=(
    "WITH l AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes GROUP BY claim_id), "
    "n AS (SELECT COUNT(*) FILTER (lbl = 'confirmed_fraud') AS minority, COUNT(*) FILTER (lbl = 'legitimate') AS majority "
    "FROM l WHERE claim_id IN (SELECT claim_id FROM claims)) "
    "SELECT minority, majority, made AS synthetic, made AS inside, made AS different_ids FROM (SELECT least(minority, majority) AS minority, "
    "greatest(minority, majority) AS majority, CASE WHEN least(minority, majority) = 0 THEN 0 ELSE abs(majority - minority) END AS made FROM n)"))
def smote_summary(rel) -> DataFrame:
    """X14 checked: class sizes, synthetic rows, those between two rare-class rows (all must be), and different ids."""
    rows = training_rows(rel)
    made = smote(rows, FEATURE_COLUMNS)
    one, zero = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    sizes = rows.agg(F.least(one, zero).alias("minority"), F.greatest(one, zero).alias("majority"))
    checked = between(made, rows, FEATURE_COLUMNS).agg(
        F.count(F.lit(1)).alias("synthetic"), F.count_if("inside").alias("inside"), F.count_distinct("synthetic_id").alias("different_ids"))
    return sizes.crossJoin(checked)                      # one row each
