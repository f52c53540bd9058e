"""Sources and sinks of the raw layer.

Loads are declared with an explicit schema (no inference), so a malformed
value becomes NULL plus a ``_corrupt`` record instead of a wrong type.  Every
writer targets a shared location; nothing is collected to the driver except
row counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.exprs import lit_ts
from .schemas import SCHEMAS
from .store import Store


def read_csv(spark: SparkSession, path: str, table: str, remap: dict[str, str] | None = None) -> DataFrame:
    """Header CSV with the declared schema; empty string -> NULL;
    bad rows keep their text in ``_corrupt``.  ``remap`` (file column -> table
    column) names columns that the file calls differently; with one, columns are
    taken by the file's header, otherwise by position."""
    fields = [f for f in SCHEMAS[table].fields if f.name != "_loaded_at"]
    if not remap:
        st = StructType(fields + [StructField("_corrupt", StringType())])
        return (spark.read.schema(st).option("header", True).option("nullValue", "").option("emptyValue", None)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    raw = spark.read.option("header", True).option("nullValue", "").option("inferSchema", False).csv(path)
    named = raw.select(*[F.col(f"`{c}`").alias(remap.get(c, c)) for c in raw.columns])
    cast = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in named.columns else F.lit(None).cast(f.dataType) for f in fields}
    bad = [F.col(n).isNotNull() & c.isNull() for n, c in cast.items() if n in named.columns]
    line = F.to_csv(F.struct(*[F.col(c) for c in named.columns]))
    broken = F.when(F.array_contains(F.array(*bad), True), line)
    return named.select(*[c.alias(n) for n, c in cast.items()], broken.alias("_corrupt"))


def stamp_load(df: DataFrame, load_ts: _dt.datetime | None = None) -> DataFrame:
    """``_loaded_at`` set at the load step only."""
    return df.withColumn("_loaded_at", lit_ts(load_ts) if load_ts else F.current_timestamp().cast("timestamp_ntz"))


def load_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """S04 truncate-and-reload (``overwrite``) or S05 append."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, sorted by name (one global count per table)."""
    out = None
    for name in sorted(tables):
        d = tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = d if out is None else out.unionByName(d)
    return out.orderBy("table_name")


def publish(df: DataFrame, key: str) -> DataFrame:
    """Row -> (key, JSON value of all columns), the message form of a topic."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_replay(df: DataFrame, ts_col: str, path: str, from_date: _dt.date | None = None, compression: str = "none") -> None:
    """Bucket rows by event day (missing date -> 0001-01-01), optional
    resume date, one directory per day so a file stream replays day by day.

    A file stream takes files by modification time, and the tasks of one job
    finish in any order, so the files get ascending times by day once they are
    written (a large day may have several files; ``rebalance`` splits it).  On a
    store that keeps no such times each day is committed on its own, in order.
    """
    day = F.coalesce(F.to_date(F.col(ts_col)), F.lit("0001-01-01").cast("date"))
    out = df.withColumn("day", day)
    if from_date:
        out = out.filter(F.col("day") >= F.lit(from_date.isoformat()).cast("date"))
    out.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").json(path, compression=compression)
    if not order_days(df.sparkSession, path):
        days = [r[0] for r in out.select("day").distinct().orderBy("day").collect()]        # calendar days
        for i, d in enumerate(days):
            out.filter(F.col("day") == F.lit(d)).write.mode("append" if i else "overwrite").partitionBy("day").json(path, compression=compression)


def order_days(spark: SparkSession, path: str) -> bool:
    """Give the files under ``path/day=...`` modification times that ascend by day; whether the store keeps them."""
    store = Store(spark, path)
    files = [f for f in store.files(path) if "/day=" in f]
    files.sort(key=lambda f: (f.split("/day=")[1], f))
    last = int(_dt.datetime.now().timestamp()) * 1000
    # whole seconds, the last file now: some stores keep no finer times
    times = [last - (len(files) - 1 - i) * 1000 for i in range(len(files))]
    if not all(store.set_time(f, t) for f, t in zip(files, times, strict=True)):
        return False
    return not files or (store.time_of(files[0]) == times[0] and store.time_of(files[-1]) == times[-1])


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with header (typed columns, so integers stay integers)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def with_seed_lookup(claims: DataFrame, diagnosis_seed: DataFrame) -> DataFrame:
    """Diagnosis lookup with the default category 'Other'."""
    d = diagnosis_seed.select("diagnosis_code", "clinical_category")
    return claims.join(d, "diagnosis_code", "left").withColumn(
        "clinical_category", F.coalesce(F.col("clinical_category"), F.lit("Other")))


def archive_stream(stream: DataFrame, ts_col: str, path: str, checkpoint: str, topic: str):
    """Raw archive by topic/year/month/day (append, checkpointed)."""
    t = F.col(ts_col)
    out = stream.withColumn("topic", F.lit(topic)).withColumn("year", F.year(t)).withColumn("month", F.month(t)) \
        .withColumn("day", F.dayofmonth(t))
    return (out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("topic", "year", "month", "day").outputMode("append"))
