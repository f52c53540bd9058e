"""Micro-batches that follow stored state: dimensions by version (R04) and the promoted model.

A stream outlives the tables that it is joined to.  Both sinks here look up what
is in force when a micro-batch starts: the newest committed version of the member
and provider tables, and the model of the newest promoted row of the performance
log, which is loaded from the shared store again only when that row changes.  The
versions used are written with the rows.

Output: micro-batch N replaces the folder ``batch=N``, so a batch that failed half
way and is repeated leaves its rows once.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from types import SimpleNamespace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.writes import VersionedTable
from ..registry import register
from ..session import checkpoint_dir
from ..sources.mapping import stored_spine
from ..sources.store import Store
from .jobs import enriched_claims, promoted_version, read_replay, score_batch


def replace_batch(df: DataFrame, out: str, batch_id: int) -> None:
    """Write a micro-batch's rows in place of what an earlier attempt of it left."""
    df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")


def in_force(table: VersionedTable) -> tuple[int, DataFrame]:
    """The newest committed version of a table and its rows."""
    version = table.current_version()
    if version is None:
        raise LookupError(f"no version of {table.root}")
    return version, table.spark.read.parquet(f"{table.root}/v={version:06d}")


def enrich_sink(members: VersionedTable, providers: VersionedTable, out: str):
    """Claims with the member and provider rows in force at their micro-batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        (version, m), (_, p) = in_force(members), in_force(providers)
        rows = enriched_claims(SimpleNamespace(members=m, providers=p), batch)
        replace_batch(rows.withColumn("members_version", F.lit(version)), out, batch_id)
    return sink


class ModelStore:
    """Fitted pipelines under ``root``, one folder for each version."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.store = root.rstrip("/"), Store(spark, root)

    def save(self, version: str, model: PipelineModel) -> None:
        """A version is written once; a half written one is replaced."""
        if self.store.exists(f"{self.root}/{version}/_COMPLETE"):
            raise ValueError(f"model {version} is already stored")
        model.write().overwrite().save(f"{self.root}/{version}/model")
        self.store.spark.createDataFrame([(version,)], "model_version string").write.mode("overwrite").parquet(f"{self.root}/{version}/_COMPLETE")

    def load(self, version: str) -> PipelineModel:
        if not self.store.exists(f"{self.root}/{version}/_COMPLETE/_SUCCESS"):
            raise LookupError(f"model {version} is not stored")
        return PipelineModel.load(f"{self.root}/{version}/model")


class ModelInForce:
    """The model of the newest promoted row of ``log``; one is held, and loaded when that row names another."""

    def __init__(self, log: VersionedTable, store: ModelStore):
        self.log, self.store = log, store
        self.version, self.model, self.loads = None, None, 0

    def rows(self) -> DataFrame:
        """The log that a batch is scored by, its model held."""
        log = in_force(self.log)[1]
        version = promoted_version(log)
        if version is None:
            raise LookupError("no promoted model available")
        if version != self.version:
            self.version, self.model, self.loads = version, self.store.load(version), self.loads + 1
        return log


def score_sink(model: ModelInForce, features, out: str):
    """Every micro-batch scored by the model in force when it starts."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        log = model.rows()
        replace_batch(score_batch(batch, log, {model.version: model.model}, features), out, batch_id)
    return sink


def land(df: DataFrame, day_col: str, path: str, together: bool = False) -> None:
    """Add rows to a landed topic, by month of ``day_col``; rows of a month that already lie ``together`` are not shuffled."""
    days = df.withColumn("day", F.trunc(day_col, "month"))
    (days if together else days.hint("rebalance", "day")).write.mode("append").partitionBy("day").json(path, compression="gzip")


def run_landed(stream: DataFrame, sink, checkpoint: str) -> int:
    """Run all that has landed through ``sink``; the number of micro-batches with rows."""
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p["numInputRows"])


CHANGE = _dt.date(1998, 6, 1)
#: features that a claim message itself carries
OWN_FEATURES = ("amount_claimed", "quantity", "service_lag_days")


def _halves(claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    before = F.col("date_of_service") < F.lit(CHANGE)
    return claims.where(before), claims.where(~before)


def _work(rel) -> tuple:
    """The session, a folder, and ``rel`` with its claim spine stored by month of service, so that
    each half of the claims lands without another join or shuffle; whether that holds."""
    spark = rel.claims.sparkSession
    stored = stored_spine(rel, F.trunc("o_orderdate", "month"))
    return spark, f"{checkpoint_dir(spark)}/in-force-{uuid.uuid4().hex}", stored, stored is not rel


def moved(members: DataFrame) -> DataFrame:
    """The members after some have moved."""
    some = F.expr("try_cast(member_id AS bigint) % 7 = 0")
    return members.withColumn("county", F.when(some, F.concat(F.lit("moved from "), "county")).otherwise(F.col("county")))


@register("stream_r04_members_in_force", sql=(
    "SELECT c.claim_id, c.member_id, m.plan_code, CASE WHEN c.date_of_service >= DATE '1998-06-01' AND TRY_CAST(m.member_id AS BIGINT) % 7 = 0 "
    "THEN 'moved from ' || m.county ELSE m.county END AS member_county, c.provider_id, p.accreditation_status, "
    "CASE WHEN c.date_of_service < DATE '1998-06-01' THEN 1 ELSE 2 END AS members_version FROM claims c "
    "LEFT JOIN members m ON m.member_id = c.member_id LEFT JOIN providers p ON p.provider_id = c.provider_id WHERE c.date_of_service IS NOT NULL"))
def r04_members_in_force(rel) -> DataFrame:
    """Members change between two runs of one stream; only the claims that land later show it."""
    spark, root, rel, together = _work(rel)
    members, providers = VersionedTable(spark, "members", root), VersionedTable(spark, "providers", root)
    providers.commit(rel.providers)
    for landed, state in zip(_halves(rel.claims), (rel.members, moved(rel.members)), strict=True):
        members.commit(state)
        land(landed, "date_of_service", f"{root}/claims", together)
        run_landed(read_replay(spark, f"{root}/claims", "claims", 30), enrich_sink(members, providers, f"{root}/out"), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").drop("batch")


def own_features(claims: DataFrame) -> DataFrame:
    """Claims with the features that need no other table."""
    return claims.withColumn("service_lag_days", F.datediff("date_submitted", "date_of_service"))


def labelled(rel) -> DataFrame:
    """Features and label of the claims with a verdict."""
    verdicts = rel.fraud_investigation_outcomes.where(F.col("final_label").isin("confirmed_fraud", "legitimate")) \
        .select("claim_id", (F.col("final_label") == "confirmed_fraud").cast("int").alias("label"))
    return own_features(rel.claims).join(verdicts, "claim_id").select("label", *OWN_FEATURES)


LOG = "log_id string, model_version string, evaluation_date date, promoted boolean"


@register("stream_r11_model_in_force", sql=(
    "SELECT CASE WHEN date_of_service < DATE '1998-06-01' THEN 'v1' ELSE 'v2' END AS model_version, COUNT(*) AS claims, "
    "MIN(date_of_service) AS first_day, MAX(date_of_service) AS last_day, CAST(0 AS BIGINT) AS without_score "
    "FROM claims WHERE date_of_service IS NOT NULL GROUP BY 1"))
def r11_model_in_force(rel) -> DataFrame:
    """A promotion between two runs of one stream; a newer row that is not promoted changes nothing."""
    from ..plans.training import train_gbt
    spark, root, rel, together = _work(rel)
    store, log = ModelStore(spark, f"{root}/models"), VersionedTable(spark, "log", root)
    labelled(rel).write.parquet(f"{root}/train")
    train = spark.read.parquet(f"{root}/train")
    for version, rounds in (("v1", 2), ("v2", 4)):
        store.save(version, train_gbt(train, OWN_FEATURES, max_iter=rounds))
    first = [("a", "v1", _dt.date(1998, 1, 1), True), ("b", "v2", _dt.date(1998, 2, 1), False)]
    model = ModelInForce(log, store)
    for landed, rows in zip(_halves(rel.claims), (first, [*first, ("c", "v2", _dt.date(1998, 6, 1), True)]), strict=True):
        log.commit(spark.createDataFrame(rows, LOG))
        land(landed, "date_of_service", f"{root}/claims", together)
        stream = own_features(read_replay(spark, f"{root}/claims", "claims", 30)).select("claim_id", "date_of_service", *OWN_FEATURES)
        run_landed(stream, score_sink(model, OWN_FEATURES, f"{root}/out"), f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    bad = F.coalesce(~F.col("score").between(0, 1), F.lit(True))
    return out.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("claims"), F.min("date_of_service").alias("first_day"), F.max("date_of_service").alias("last_day"),
        F.count_if(bad).alias("without_score"))


__all__ = ["ModelInForce", "ModelStore", "enrich_sink", "in_force", "land", "moved", "replace_batch", "run_landed", "score_sink"]
