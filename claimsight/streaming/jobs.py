"""Structured Streaming jobs (R01-R14) and their batch truths.

Every windowed detector is one function that accepts a batch *or* a
streaming DataFrame, so the batch result over the full table is the
reference the stream must reproduce (tested in ``tests/test_streaming.py``).
Streams read JSON files landed per day (the replay layout of
:func:`claimsight.sources.io.write_replay`), use event-time watermarks, and
keep their offsets and state in a checkpoint under the shared
``spark.checkpoint.dir``; sinks are idempotent (``foreachBatch`` upserts keyed
on the record id), so a restarted or replayed batch changes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import constants as K
from ..functions.exprs import lit_ts
from ..operators.writes import BucketedTable, VersionedTable, append_events, upsert_claims, upsert_latest, upsert_members
from ..registry import register
from ..sources.io import publish
from ..sources.schemas import SCHEMAS

WATERMARK = "2 days"   # *decision*: lateness bound for event-time state (the reference defines none)


def event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (session tz UTC); the data is TIMESTAMP_NTZ."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


# ------------------------------------------------------------ ingestion
def tag_messages(msgs: DataFrame, table: str, key_col: str | None = None) -> DataFrame:
    """R01 core: (key, value) JSON messages -> parsed struct ``r`` and an error
    tag ``_err`` (NULL for a good message), in one projection.

    A message is dead when the key is missing, the JSON does not parse, a
    required column is NULL after the cast to the declared type, an optional
    column holds a value that its type cannot take (it would become NULL
    silently), or the key is not the payload's ``key_col``.
    """
    st = SCHEMAS[table]
    as_text = StructType([StructField(f.name, StringType()) for f in st.fields])
    parsed = msgs.select("key", "value", F.from_json("value", st, {"mode": "PERMISSIVE"}).alias("r"),
                         F.from_json("value", as_text, {"mode": "PERMISSIVE"}).alias("_text"))
    required = [f.name for f in st.fields if not f.nullable and f.name != "_loaded_at"]
    optional = [f.name for f in st.fields if f.nullable]
    # concat_ws skips NULLs, so these list the fields without a lambda
    missing = F.concat_ws(",", *[F.when(F.col("r." + c).isNull(), F.lit(c)) for c in required])
    invalid = F.concat_ws(",", *[F.when(F.col("r." + c).isNull() & F.col("_text." + c).isNotNull(), F.lit(c)) for c in optional])
    err = (F.when(F.col("key").isNull(), F.lit("missing key"))
           .when(F.try_parse_json("value").isNull() | F.col("r").isNull(), F.lit("unparseable JSON"))
           .when(F.col("_missing") != "", F.concat(F.lit("missing or invalid: "), F.col("_missing")))
           .when(F.col("_invalid") != "", F.concat(F.lit("invalid: "), F.col("_invalid"))))
    if key_col:
        err = err.when(F.col("key") != F.col("r." + key_col).cast("string"), F.lit(f"key differs from {key_col}"))
    return parsed.withColumn("_missing", missing).withColumn("_invalid", invalid).withColumn("_err", err) \
        .drop("_missing", "_invalid", "_text")


def tag_unknown_keys(tagged: DataFrame, references: dict[str, DataFrame]) -> DataFrame:
    """Dead-letter a good message whose foreign key is not in its table.

    ``references``: column -> a frame with that column (its keys).  Static left
    joins, one per column; a NULL key refers to nothing and passes.
    """
    out, unknown = tagged, []
    for c, ref in references.items():
        known = ref.select(F.col(c).alias(f"_ref_{c}")).distinct()
        out = out.join(known, F.col(f"r.{c}") == F.col(f"_ref_{c}"), "left")
        unknown.append(F.when(F.col(f"r.{c}").isNotNull() & F.col(f"_ref_{c}").isNull(), F.lit(c)))
    bad = F.concat_ws(",", *unknown)
    return out.withColumn("_err", F.coalesce("_err", F.when(bad != "", F.concat(F.lit("unknown: "), bad)))) \
        .drop(*[f"_ref_{c}" for c in references])


def dead_letters(tagged: DataFrame, topic: str, failed_at: _dt.datetime | None = None) -> DataFrame:
    """Dead-letter rows (the dlq_events layout) of a tagged message frame."""
    ts = lit_ts(failed_at) if failed_at else F.current_timestamp().cast("timestamp_ntz")
    return tagged.filter(F.col("_err").isNotNull()).select(
        F.concat(F.lit("DLQ-"), F.substring(F.sha2(F.concat_ws("|", F.lit(topic), F.coalesce("key", F.lit("")), "value"), 256), 1, 16))
        .alias("dlq_id"), F.lit(topic).alias("source_topic"), ts.alias("failed_at"),
        F.lit("E_SCHEMA").alias("error_code"), F.col("_err").alias("error_message"), F.col("value").alias("raw_payload"),
        F.lit(0).cast("smallint").alias("retry_count"), F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"), ts.alias("_loaded_at"))


def parse_messages(msgs: DataFrame, table: str, topic: str, failed_at: _dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, dead letters).  When both sides are written from one
    micro-batch use :func:`ingest_sink`, which parses the batch once."""
    tagged = tag_messages(msgs, table)
    return tagged.filter(F.col("_err").isNull()).select("r.*"), dead_letters(tagged, topic, failed_at)


def ingest_sink(table: str, topic: str, write_good, write_bad, key_col: str | None = None, references: dict[str, DataFrame] | None = None):
    """R01 / S15 ``foreachBatch``: parse and tag the micro-batch once
    (persisted for the two writes), route typed rows and dead letters."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_unknown_keys(tag_messages(batch, table, key_col), references or {}).persist()
        try:
            write_good(tagged.filter(F.col("_err").isNull()).select("r.*"), batch_id)
            write_bad(dead_letters(tagged, topic), batch_id)
        finally:
            tagged.unpersist()
    return sink


def claim_messages(rel) -> DataFrame:
    """Claims published as topic messages (S08) with some payloads damaged:
    truncated JSON, a missing key or another one, an amount that is not a number
    (required or optional), a member that does not exist."""
    m = publish(rel.claims, "claim_id")
    k = F.split_part(F.col("key"), F.lit("-"), F.lit(1)).cast("bigint")
    value = (F.when(k % 53 == 0, F.substring("value", 1, 40))
             .when(k % 59 == 0, F.regexp_replace("value", r'"amount_claimed":[0-9.]+', '"amount_claimed":"n/a"'))
             .when(k % 67 == 0, F.regexp_replace("value", r'"amount_approved":[0-9.]+', '"amount_approved":"n/a"'))
             .when(k % 71 == 0, F.regexp_replace("value", r'"member_id":"[^"]*"', '"member_id":"nobody"'))
             .otherwise(F.col("value")))
    key = F.when(k % 61 == 0, F.lit(None).cast("string")).when(k % 73 == 0, F.concat("key", F.lit("-x"))).otherwise(F.col("key"))
    return m.select(key.alias("key"), value.alias("value"))


_K = "CAST(split_part(claim_id, '-', 1) AS BIGINT)"


@register("stream_r01_ingest_split", sql=(
    f"SELECT outcome, COUNT(*) AS messages FROM (SELECT CASE WHEN {_K} % 61 = 0 THEN 'missing key' "
    f"WHEN {_K} % 53 = 0 THEN 'unparseable JSON' WHEN {_K} % 59 = 0 THEN 'missing or invalid: amount_claimed' "
    f"WHEN {_K} % 67 = 0 AND amount_approved IS NOT NULL THEN 'invalid: amount_approved' "
    f"WHEN {_K} % 73 = 0 THEN 'key differs from claim_id' "
    f"WHEN {_K} % 71 = 0 AND {_K} % 67 <> 0 OR member_id NOT IN (SELECT member_id FROM members) THEN 'unknown: member_id' "
    "ELSE 'ok' END AS outcome FROM claims) GROUP BY outcome"))
def ingest_split(rel) -> DataFrame:
    """Good / dead-letter counts per error of the claims topic.  The oracle
    states the class each message must get from the damage planted in
    :func:`claim_messages` (key removed, JSON truncated, amount not a number)."""
    tagged = tag_unknown_keys(tag_messages(claim_messages(rel), "claims", "claim_id"), {"member_id": rel.members})
    return tagged.groupBy(F.coalesce(F.col("_err"), F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("messages"))


# ---------------------------------------------------------- detectors
_UNIT = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(spec: str) -> int:
    n, unit = spec.split()
    return int(n) * _UNIT[unit.rstrip("s")]


def provider_bursts(claims: DataFrame, threshold: int = 40, length: str = "6 hours", slide: str = "15 minutes",
                    ts: str = "submitted_at") -> DataFrame:
    """Providers with >= ``threshold`` claims in a sliding event-time window.

    On a stream: ``window()`` under the caller's watermark (state per provider
    and open window).  In batch: claims are first counted per (provider,
    slide bucket) - a map-side partial aggregate, so a provider with a burst
    of thousands of claims in one bucket is one row.  Bucket counts are dealt once
    by (provider, block of window starts); a bucket whose neighbours within one
    length on both sides do not reach the threshold lies in no such window, and
    only the others are expanded to the windows of their block that contain them
    and summed where they are.  Both give the windows of ``window(ts, length, slide)``.
    """
    if claims.isStreaming:
        g = claims.groupBy("provider_id", F.window(F.col(ts), length, slide).alias("w")).agg(F.count(F.lit(1)).alias("claims"))
        return g.filter(F.col("claims") >= threshold).select(
            "provider_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "claims")
    step, span = _seconds(slide), _seconds(length)
    k = span // step
    ttype = dict(claims.dtypes)[ts]
    b = claims.groupBy("provider_id", F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / step).alias("bk")) \
        .agg(F.count(F.lit(1)).alias("n"))
    # a bucket goes to the block of its own window start and to the one before, if a window that holds it starts there
    size = 16 * k
    here, first = F.floor(F.col("bk") / size), F.floor((F.col("bk") - (k - 1)) / size)
    x = b.where(F.col("bk").isNotNull()).select("provider_id", "bk", "n", F.explode(F.sequence(first, here)).alias("blk"))
    around = Window.partitionBy("provider_id", "blk").orderBy("bk").rangeBetween(-(k - 1), k - 1)
    x = x.withColumn("near", F.sum("n").over(around)).where(F.col("near") >= threshold)
    from_ws = F.greatest(F.col("bk") - (k - 1), F.col("blk") * size)
    to_ws = F.least(F.col("bk"), F.col("blk") * size + (size - 1))
    x = x.select("provider_id", "blk", F.explode(F.sequence(from_ws, to_ws)).alias("ws"), "n")
    g = x.groupBy("provider_id", "blk", "ws").agg(F.sum("n").alias("claims")).filter(F.col("claims") >= threshold)
    start = F.timestamp_seconds(F.col("ws") * step)
    return g.select("provider_id", start.cast(ttype).alias("window_start"),
                    (start + F.expr(f"INTERVAL {span} SECONDS")).cast(ttype).alias("window_end"), "claims")


def _burst_sql(th: int) -> str:
    return ("WITH c AS (SELECT provider_id, CAST(epoch(submitted_at) AS BIGINT) AS t FROM claims), "
            "w AS (SELECT provider_id, CAST(floor(t / 900) AS BIGINT) * 900 - k * 900 AS ws FROM c, range(0, 24) r(k)) "
            "SELECT provider_id, make_timestamp(ws * 1000000) AS window_start, make_timestamp((ws + 21600) * 1000000) "
            f"AS window_end, COUNT(*) AS claims FROM w GROUP BY 1, 2, 3 HAVING COUNT(*) >= {th}")


register("stream_r05_provider_bursts", sql=_burst_sql(40))(lambda rel: provider_bursts(rel.claims, 40))
register("stream_r05_provider_bursts_low", sql=_burst_sql(3))(lambda rel: provider_bursts(rel.claims, 3))


def near_threshold_stream(claims: DataFrame) -> DataFrame:
    """Stateless filter of amounts just below a threshold (F02 on a stream)."""
    from ..operators.fraud import threshold_claims
    return threshold_claims(claims)


def member_spread_windows(claims: DataFrame, min_providers: int = 4, ts: str = "date_of_service") -> DataFrame:
    """Members seen by >= ``min_providers`` distinct providers in a
    7-day window sliding by one day (state per member and window)."""
    c = claims.withColumn("_t", F.col(ts).cast("timestamp_ntz")) if dict(claims.dtypes)[ts] == "date" else \
        claims.withColumn("_t", F.col(ts))
    g = c.groupBy("member_id", F.window("_t", "7 days", "1 day").alias("w")).agg(
        F.size(F.collect_set("provider_id")).alias("providers"))
    return g.filter(F.col("providers") >= min_providers).select(
        "member_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "providers")


def _spread_sql(k: int) -> str:
    return ("WITH w AS (SELECT member_id, provider_id, CAST(date_of_service AS TIMESTAMP) - r.d * INTERVAL 1 DAY AS ws "
            "FROM claims, range(0, 7) r(d)) SELECT member_id, ws AS window_start, ws + INTERVAL 7 DAY AS window_end, "
            f"COUNT(DISTINCT provider_id) AS providers FROM w GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT provider_id) >= {k}")


register("stream_r07_member_spread", sql=_spread_sql(8))(lambda rel: member_spread_windows(rel.claims, 8))


def duplicate_pairs_stream(left: DataFrame, right: DataFrame, hours: int = 48, max_rel_gap: float = 0.05,
                           ts: str = "submitted_at") -> DataFrame:
    """Stream-stream self join on (member, provider, diagnosis) with an
    event-time band of ``hours``; both sides carry watermarks, so state is
    dropped once no later claim can match."""
    cols = ["claim_id", "member_id", "provider_id", "diagnosis_code", "amount_claimed", ts]
    a = left.select(*[F.col(c).alias("a_" + c) for c in cols])
    b = right.select(*[F.col(c).alias("b_" + c) for c in cols])
    cond = ((F.col("a_member_id") == F.col("b_member_id")) & (F.col("a_provider_id") == F.col("b_provider_id"))
            & (F.col("a_diagnosis_code") == F.col("b_diagnosis_code")) & (F.col("a_claim_id") < F.col("b_claim_id"))
            & (F.col("b_" + ts) >= F.col("a_" + ts) - F.expr(f"INTERVAL {hours} HOURS"))
            & (F.col("b_" + ts) <= F.col("a_" + ts) + F.expr(f"INTERVAL {hours} HOURS")))
    j = a.join(b, cond)
    gap = F.abs(F.col("a_amount_claimed") - F.col("b_amount_claimed")).cast("double") \
        / F.nullif(F.col("a_amount_claimed").cast("double"), F.lit(0.0))
    return j.filter(gap < max_rel_gap).select(F.col("a_claim_id").alias("original_claim_id"),
                                              F.col("b_claim_id").alias("potential_duplicate_id"))


def phantom_stream(claims: DataFrame, vitals: DataFrame, grace_hours: int = 72, prescriptions: DataFrame | None = None) -> DataFrame:
    """Consultation claims without vitals (and, where given, without
    prescriptions) within ``grace_hours`` of submission - a stream-stream left
    outer join against the evidence of both; a row is emitted once the watermark
    passes the grace period."""
    c = claims.filter(F.col("procedure_code").startswith("CONS")) \
        .select("claim_id", "provider_id", F.col("submitted_at").alias("c_ts"))
    v = vitals.select(F.col("claim_id").alias("v_claim_id"), F.col("_loaded_at").alias("v_ts"))
    if prescriptions is not None:
        v = v.unionByName(prescriptions.select(F.col("claim_id").alias("v_claim_id"), F.col("_loaded_at").alias("v_ts")))
    cond = ((F.col("claim_id") == F.col("v_claim_id")) & (F.col("v_ts") >= F.col("c_ts") - F.expr("INTERVAL 30 DAYS"))
            & (F.col("v_ts") <= F.col("c_ts") + F.expr(f"INTERVAL {grace_hours} HOURS")))
    return c.join(v, cond, "left_outer").filter(F.col("v_claim_id").isNull()).select("claim_id", "provider_id", "c_ts")


# ------------------------------------------------------------- runners
def read_replay(spark: SparkSession, path: str, table: str, max_files_per_trigger: int = 1,
                from_day: _dt.date | None = None) -> DataFrame:
    """Replay landed day directories in order (:func:`claimsight.sources.io.write_replay`
    gives the files ascending times by day), ``max_files_per_trigger`` per
    micro-batch; ``from_day`` resumes there (a partition filter)."""
    st = StructType(list(SCHEMAS[table].fields) + [StructField("day", StringType())])
    stream = spark.readStream.schema(st).option("maxFilesPerTrigger", max_files_per_trigger).json(path) \
        .withColumn("_file", F.col("_metadata.file_path"))
    return stream if from_day is None else stream.filter(F.col("day") >= F.lit(from_day.isoformat()))


def arrival(batch_id: int):
    """Arrival order of a replayed micro-batch: batch, then day, file and row of the file."""
    return F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.col("day"), F.col("_file").alias("file"),
                    F.monotonically_increasing_id().alias("row"))


def run_detector(stream: DataFrame, detector, ts: str, sink_path: str, checkpoint: str, trigger_once: bool = True):
    """Run a windowed detector with a watermark; append each closed window to Parquet."""
    s = event_time(stream, ts).withWatermark(ts, WATERMARK)
    q = (detector(s).writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    q = q.trigger(availableNow=True) if trigger_once else q.trigger(processingTime="30 seconds")
    return q.start()


def upsert_claims_sink(table: VersionedTable, load_ts: _dt.datetime | None = None):
    """``foreachBatch`` that folds each micro-batch into the claims table
    (U03).  Arrival order inside a batch = the file order Spark read it in."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        cur = table.read()
        b = batch.withColumn("_arrival", arrival(batch_id)).drop("day", "_file")
        ts = load_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if cur is None:
            cur = b.limit(0).drop("_arrival")
        new = upsert_claims(cur, b.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")), ts)
        table.commit(new)
    return sink


def upsert_claims_bucketed_sink(table: BucketedTable, load_ts: _dt.datetime | None = None):
    """R03 at scale: each micro-batch rewrites only the claim buckets it touches."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_arrival", arrival(batch_id)).drop("day", "_file") \
            .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))
        ts = load_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        table.merge(b, lambda cur, bb: upsert_claims(cur, bb, ts))
    return sink


def append_events_sink(table: VersionedTable):
    """Idempotent append keyed on the event id (U04) per micro-batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        cur = table.read()
        b = batch.withColumn("_arrival", arrival(batch_id)).drop("day", "_file")
        if cur is None:
            cur = b.limit(0).drop("_arrival")
        table.commit(append_events(cur, b))
    return sink


#: topic -> key of its table; a message replaces the stored row of its key (members keep their identity fields)
TOPIC_KEYS = {"plans": "plan_code", "members": "member_id", "providers": "provider_id", "vitals": "vitals_id",
              "prescriptions": "prescription_id", "payments": "payment_id", "stock_levels": "stock_id"}


def topic_sink(topic: str, table: BucketedTable, load_ts: _dt.datetime | None = None):
    """``foreachBatch`` upsert sink of a topic, keyed by :data:`TOPIC_KEYS` (claims and
    events have sinks of their own); the last arrival of a key wins, so replays change nothing."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_arrival", arrival(batch_id)).drop("day", "_file")
        ts = load_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if topic == "members":
            table.merge(b, lambda cur, bb: upsert_members(cur, bb, ts))
        else:
            table.merge(b, lambda cur, bb: upsert_latest(cur, bb, TOPIC_KEYS[topic], ts))
    return sink


def stream_backlog(spark: SparkSession, landed_path: str, checkpoint: str, limit_mb: float = 100.0) -> DataFrame:
    """N06 / 18-T03 (re-aimed): files landed but not yet consumed by the
    stream - landed listing ``left_anti`` the file source's commit log - with
    bytes, MB and a status."""
    def norm(c):  # file:/x, file:///x and /x name the same file
        return F.regexp_replace(c, r"^file:/+", "/")
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landed_path) \
        .select(norm(F.col("path")).alias("path"), "length")
    log = spark.read.text(f"{checkpoint}/sources/0").filter(F.col("value").startswith("{")) \
        .select(norm(F.get_json_object("value", "$.path")).alias("path"))
    pend = landed.join(log, "path", "left_anti")
    g = pend.agg(F.count(F.lit(1)).alias("pending_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("lag_bytes"))
    return g.select("pending_files", "lag_bytes", F.round(F.col("lag_bytes") / 1048576.0, 2).alias("lag_mb"),
                    F.when(F.col("lag_bytes") > limit_mb * 1048576, "HIGH LAG").otherwise("OK").alias("status"))


def unconsumed_outcomes(outcomes: DataFrame, consumed: DataFrame) -> DataFrame:
    """Weekly reconciliation - outcomes the label feed has not consumed."""
    return outcomes.join(consumed.select("outcome_id"), "outcome_id", "left_anti")


@register("stream_r13_label_feed", sql=(
    "SELECT o.outcome_id, o.claim_id, p.prediction_id, p.model_version, CAST(p.fraud_probability AS DOUBLE) AS fraud_probability, "
    "CAST(o.final_label = 'confirmed_fraud' AS INTEGER) AS label FROM fraud_investigation_outcomes o "
    "JOIN fraud_predictions p ON p.claim_id = o.claim_id WHERE o.final_label IN ('confirmed_fraud', 'legitimate')"))
def label_feed(rel) -> DataFrame:
    """Outcome feed joined to the predictions of the claim -> labelled scores
    (the same plan runs on a stream of outcomes against the static predictions)."""
    o = rel.fraud_investigation_outcomes.filter(F.col("final_label").isin("confirmed_fraud", "legitimate")) \
        .select("outcome_id", "claim_id", (F.col("final_label") == "confirmed_fraud").cast("int").alias("label"))
    p = rel.fraud_predictions.select("claim_id", "prediction_id", "model_version", "fraud_probability")
    return o.join(p, "claim_id").select("outcome_id", "claim_id", "prediction_id", "model_version", "fraud_probability", "label")


@register("stream_r04_enriched", sql=(
    "SELECT c.claim_id, c.member_id, m.plan_code, m.county AS member_county, c.provider_id, p.accreditation_status "
    "FROM claims c LEFT JOIN members m ON m.member_id = c.member_id LEFT JOIN providers p ON p.provider_id = c.provider_id"))
def enriched_claims(rel, claims: DataFrame | None = None) -> DataFrame:
    """Claim enrichment with member and provider (stream-static left join
    when ``claims`` is a stream; the static side is re-read per micro-batch)."""
    c = (claims if claims is not None else rel.claims).select("claim_id", "member_id", "provider_id")
    m = rel.members.select("member_id", "plan_code", F.col("county").alias("member_county"))
    p = rel.providers.select("provider_id", "accreditation_status")
    return c.join(m, "member_id", "left").join(p, "provider_id", "left") \
        .select("claim_id", "member_id", "plan_code", "member_county", "provider_id", "accreditation_status")


def promoted_version(model_log: DataFrame) -> str | None:
    """The version of the newest promoted row, if there is one."""
    row = model_log.filter(F.col("promoted")).agg(
        F.max_by("model_version", F.struct("evaluation_date", "log_id")).alias("v")).first()
    return row.v


def score_batch(batch: DataFrame, model_log: DataFrame, models: dict, features) -> DataFrame:
    """Score a micro-batch with the newest promoted model and record its version."""
    from ..plans.training import score
    version = promoted_version(model_log)
    if version is None or version not in models:
        raise LookupError("no promoted model available")
    return score(models[version], batch, features).withColumn("model_version", F.lit(version))


def dedup_events_stream(events: DataFrame, ts: str = "event_at", delay: str = WATERMARK) -> DataFrame:
    """R02 (stream side): drop repeated event ids seen within the watermark;
    replays older than the watermark are removed by the keyed sink
    (:func:`append_events_sink`)."""
    return event_time(events, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])


def outcome_change_feed(spark: SparkSession, path: str) -> DataFrame:
    """Insert-only change feed of verdicts - the outcomes table read as a
    file stream, one row per new outcome id."""
    st = SCHEMAS["fraud_investigation_outcomes"]
    s = spark.readStream.schema(st).parquet(path)
    return event_time(s, "confirmed_at").withWatermark("confirmed_at", WATERMARK) \
        .dropDuplicatesWithinWatermark(["outcome_id"])


# --------------------------------------------------- R10 / R14 (batch form)
RULES_MODEL = "rules-v1"


def signals_to_predictions(signals: DataFrame, predicted_at: _dt.datetime, model_version: str = RULES_MODEL) -> DataFrame:
    """Rule signals (claim_id, rule) -> one prediction row per (claim,
    model_version), rules listed in the JSON snapshot; deterministic ids, so
    a replayed batch produces the same rows (and the keyed sink drops them)."""
    g = signals.groupBy("claim_id").agg(F.array_sort(F.collect_set("rule")).alias("rules"))
    return g.select(
        F.concat(F.lit(f"P-{model_version}-"), F.col("claim_id")).alias("prediction_id"), "claim_id",
        F.lit(model_version).alias("model_version"), F.lit(1.0).cast("decimal(6,5)").alias("fraud_probability"),
        F.lit("critical").alias("risk_tier"), F.to_json(F.struct(F.col("rules"))).alias("feature_snapshot"),
        lit_ts(predicted_at).alias("predicted_at"))


def append_new_keys(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed idempotent append: batch rows whose key is not yet stored (first per key wins)."""
    first = batch.dropDuplicates(keys)
    return target.unionByName(first.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def rule_signals(rel) -> DataFrame:
    from ..operators.fraud import phantom_claims, threshold_claims
    t = threshold_claims(rel.claims).select("claim_id", F.lit("threshold_band").alias("rule"))
    p = phantom_claims(rel.claims, rel.vitals, rel.prescriptions).select("claim_id", F.lit("phantom_billing").alias("rule"))
    return t.unionByName(p)


@register("stream_r10_signal_predictions", sql=(
    "WITH s AS (SELECT claim_id, 'threshold_band' AS rule FROM claims WHERE " + " OR ".join(
        f"(amount_claimed >= {K.THRESHOLD_FACTORS[0] * t} AND amount_claimed < {K.THRESHOLD_FACTORS[1] * t})"
        for t in K.THRESHOLDS_KES) + " UNION ALL SELECT c.claim_id, 'phantom_billing' FROM claims c WHERE c.procedure_code LIKE "
    "'CONS%' AND NOT EXISTS (SELECT 1 FROM vitals v WHERE v.claim_id = c.claim_id) AND NOT EXISTS (SELECT 1 FROM prescriptions p "
    "WHERE p.claim_id = c.claim_id)), g AS (SELECT claim_id, list_sort(list_distinct(list(rule))) AS rules FROM s GROUP BY claim_id) "
    f"SELECT 'P-{RULES_MODEL}-' || claim_id AS prediction_id, claim_id, '{RULES_MODEL}' AS model_version, "
    "CAST(1.0 AS DOUBLE) AS fraud_probability, 'critical' AS risk_tier, "
    "'{\"rules\":[' || array_to_string(list_transform(rules, lambda x: '\"' || x || '\"'), ',') || ']}' AS feature_snapshot, "
    f"{K.AS_OF_SQL} AS predicted_at FROM g"))
def signal_predictions(rel) -> DataFrame:
    return signals_to_predictions(rule_signals(rel), K.AS_OF)


@register("stream_r10_sink_after_replay", sql=(
    "SELECT model_version, COUNT(*) AS predictions, COUNT(DISTINCT claim_id) AS claims FROM ("
    "SELECT claim_id, model_version FROM fraud_predictions UNION ALL SELECT DISTINCT claim_id, 'rules-v1' FROM ("
    "SELECT claim_id FROM claims WHERE " + " OR ".join(
        f"(amount_claimed >= {K.THRESHOLD_FACTORS[0] * t} AND amount_claimed < {K.THRESHOLD_FACTORS[1] * t})"
        for t in K.THRESHOLDS_KES) + " UNION ALL SELECT c.claim_id FROM claims c WHERE c.procedure_code LIKE 'CONS%' AND NOT "
    "EXISTS (SELECT 1 FROM vitals v WHERE v.claim_id = c.claim_id) AND NOT EXISTS (SELECT 1 FROM prescriptions p "
    "WHERE p.claim_id = c.claim_id))) GROUP BY model_version"))
def sink_after_replay(rel) -> DataFrame:
    """The keyed sink applied twice (a replayed micro-batch): predictions per
    model version stay one per (claim, version)."""
    cols = ["prediction_id", "claim_id", "model_version", "fraud_probability", "risk_tier", "feature_snapshot", "predicted_at"]
    new = signals_to_predictions(rule_signals(rel), K.AS_OF)
    t = append_new_keys(rel.fraud_predictions.select(*cols), new, ["claim_id", "model_version"])
    t = append_new_keys(t, new, ["claim_id", "model_version"])
    return t.groupBy("model_version").agg(F.count(F.lit(1)).alias("predictions"),
                                          F.count_distinct("claim_id").alias("claims"))


@register("stream_r14_unconsumed_outcomes", sql=(
    "SELECT o.outcome_id, o.claim_id, o.final_label FROM fraud_investigation_outcomes o WHERE NOT EXISTS ("
    "SELECT 1 FROM fraud_investigation_outcomes x JOIN fraud_predictions p ON p.claim_id = x.claim_id "
    "WHERE x.final_label IN ('confirmed_fraud', 'legitimate') AND x.outcome_id = o.outcome_id)"))
def r14_unconsumed(rel) -> DataFrame:
    """Outcomes that the label feed (R13) never turned into a training label."""
    consumed = label_feed(rel).select("outcome_id").distinct()
    return unconsumed_outcomes(rel.fraud_investigation_outcomes.select("outcome_id", "claim_id", "final_label"), consumed)


@register("stream_r08_duplicates_48h", sql=(
    "SELECT a.claim_id AS original_claim_id, b.claim_id AS potential_duplicate_id FROM claims a JOIN claims b "
    "ON a.member_id = b.member_id AND a.provider_id = b.provider_id AND a.diagnosis_code = b.diagnosis_code "
    "AND a.claim_id < b.claim_id AND b.submitted_at BETWEEN a.submitted_at - INTERVAL 48 HOUR AND a.submitted_at + INTERVAL 48 HOUR "
    "WHERE abs(CAST(a.amount_claimed AS DOUBLE) - CAST(b.amount_claimed AS DOUBLE)) / NULLIF(CAST(a.amount_claimed AS DOUBLE), 0) < 0.05"))
def r08_batch(rel, hours: int = 48, gap: float = 0.05) -> DataFrame:
    """R08 batch truth: the same pairs as the stream-stream join, computed with
    the skew-safe bucketed band join (a hot key is split by time buckets)."""
    from ..operators.quality import near_duplicate_pairs
    return near_duplicate_pairs(rel.claims, max_rel_gap=gap, ts_col="submitted_at", max_seconds=hours * 3600) \
        .select("original_claim_id", "potential_duplicate_id")


register("stream_r08_duplicates_30d", sql=(
    "SELECT a.claim_id AS original_claim_id, b.claim_id AS potential_duplicate_id FROM claims a JOIN claims b "
    "ON a.member_id = b.member_id AND a.provider_id = b.provider_id AND a.diagnosis_code = b.diagnosis_code "
    "AND a.claim_id < b.claim_id AND b.submitted_at BETWEEN a.submitted_at - INTERVAL 720 HOUR AND a.submitted_at + INTERVAL 720 HOUR "
    "WHERE abs(CAST(a.amount_claimed AS DOUBLE) - CAST(b.amount_claimed AS DOUBLE)) / NULLIF(CAST(a.amount_claimed AS DOUBLE), 0) < 0.2"))(
    lambda rel: r08_batch(rel, 720, 0.2))


@register("stream_r09_phantom_72h", sql=(
    "SELECT c.claim_id, c.provider_id, c.submitted_at AS c_ts FROM claims c WHERE c.procedure_code LIKE 'CONS%' "
    "AND NOT EXISTS (SELECT 1 FROM vitals v WHERE v.claim_id = c.claim_id AND v._loaded_at >= c.submitted_at - INTERVAL 30 DAY "
    "AND v._loaded_at <= c.submitted_at + INTERVAL 72 HOUR) AND NOT EXISTS (SELECT 1 FROM prescriptions x WHERE x.claim_id = c.claim_id "
    "AND x._loaded_at BETWEEN c.submitted_at - INTERVAL 30 DAY AND c.submitted_at + INTERVAL 72 HOUR)"))
def r09_batch(rel) -> DataFrame:
    """R09 batch truth: consultations with no vitals and no prescription inside the grace period."""
    return phantom_stream(rel.claims, rel.vitals, 72, rel.prescriptions)
