"""Connected components of an edge table, by hooking and pointer jumping.

Edges point from a larger node (child) to a smaller one (parent).  A round

* hooks: all parents of a child are linked to the least of them (one shuffle by
  child, which also removes repeats), and
* jumps: a child moves on to its parent's parent (a join, which adaptive
  execution splits where many children share a parent),

until a round changes nothing: then every component is one star around its least node.
Each round is written to the shared folder, which cuts the lineage and survives
lost executors.  Nodes never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored


def _hook(edges: DataFrame) -> DataFrame:
    """a, b, and whether the row is a new link between parents."""
    least = F.min("b").over(Window.partitionBy("a"))
    x = edges.repartition("a").distinct().withColumn("m", least)
    return x.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"),
                    (F.col("b") != F.col("m")).alias("new"))


def _jump(edges: DataFrame) -> DataFrame:
    up = edges.groupBy("a").agg(F.min("b").alias("p")).withColumnRenamed("a", "c")
    return edges.join(up, F.col("b") == F.col("c"), "left").select("a", F.coalesce("p", "b").alias("b"), (F.col("new") | F.col("p").isNotNull()).alias("new"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (columns a, b of type long)."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        seen = Observation()
        now = stored(_jump(_hook(now)).observe(seen, F.count_if("new").alias("changes")).select("a", "b"), name)
        if not seen.get["changes"]:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
