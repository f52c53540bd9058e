"""Keyed-state detectors (R07, R08) on ``transformWithState``: what a key must remember, and when it may forget it.

State lives in the RocksDB store, so it is bounded by the executors' disks and
checkpointed by changes; event-time timers drop what no later claim can meet.

A processor is called once for each grouping key and trigger, and every call and
state access crosses to the JVM, so the keys (members; member, provider and
diagnosis) are dealt by hash over ``parts`` groups that share one state: the calls
grow with the groups, and the rows of a group are compared as arrays and kept in the
state as packed Arrow batches, not row by row.  ``parts``
belongs to a checkpoint like the key itself; a restart takes the same number.

* ``ProviderSpread`` keeps one entry for each (day, provider) of a member, where
  the windowed aggregate keeps every claim in seven sliding windows; a timer at
  the next window end reports all that the watermark has passed, and then drops
  the days that no open window holds.
* ``DuplicateClaims`` keeps a list of the recent claims of a (member, provider,
  diagnosis); a claim is compared with them on arrival and leaves after the band.

Claims later than the watermark are dropped by the engine, as in every windowed
job here; a restart goes on from the checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..registry import register
from ..session import checkpoint_dir
from ..sources.io import write_replay
from .jobs import WATERMARK, event_time, read_replay

DAY_MS = 86_400_000
WINDOW_DAYS = 7
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPREAD = "member_id string, window_start timestamp, window_end timestamp, providers long"
PAIRS = "original_claim_id string, potential_duplicate_id string"


#: groups that share one state, and the claims that one of them is meant for
PARTS, CLAIMS_PER_PART = 64, 50_000
SEEN = ["member_id", "day", "provider_id"]
WHO = ["member_id", "provider_id", "diagnosis_code"]
RECENT = ["ts_ms", "claim_id", "amount", *WHO]
SEEN_ROWS = pa.schema([("member_id", pa.string()), ("day", pa.int64()), ("provider_id", pa.string())])
RECENT_ROWS = pa.schema([("ts_ms", pa.int64()), ("claim_id", pa.string()), ("amount", pa.float64()), *[(c, pa.string()) for c in WHO]])


#: a list state holds rows packed as Arrow batches of at most so many, because each element crosses to the JVM by itself
PACKED, AT_ONCE = "rows binary", 10_000


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> list[tuple[bytes]]:
    table = pa.Table.from_pandas(rows, schema, preserve_index=False)
    packed = []
    for batch in table.combine_chunks().to_batches(max_chunksize=AT_ONCE):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        packed.append((sink.getvalue().to_pybytes(),))
    return packed


def _held(state, schema: pa.Schema) -> pd.DataFrame:
    tables = [pa.ipc.open_stream(bytes(b)).read_all() for b, in state.get()]
    return pa.concat_tables(tables).to_pandas() if tables else schema.empty_table().to_pandas()


def _put(state, rows: pd.DataFrame, schema: pa.Schema) -> None:
    if len(rows):
        state.put(_packed(rows, schema))
    else:
        state.clear()


class ProviderSpread(StatefulProcessor):
    """Members seen by at least ``least`` providers in a window of seven days that slides by one."""

    def __init__(self, least: int):
        self.least = least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", PACKED)
        self.done = handle.getValueState("done", "end long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([b.assign(day=b["ts_ms"] // DAY_MS)[SEEN].drop_duplicates() for b in rows]).drop_duplicates()
        if len(fresh):
            held = _held(self.seen, SEEN_ROWS)
            if len(held):
                fresh = pd.concat([held, fresh]).drop_duplicates().iloc[len(held):]
        if len(fresh):
            self.seen.appendList(_packed(fresh, SEEN_ROWS))
            self.handle.registerTimer((int(fresh["day"].min()) + 1) * DAY_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Reports every window that has ended by the watermark and none before, then forgets days and waits for the next end."""
        last = timerValues.getCurrentWatermarkInMs() // DAY_MS
        done = self.done.get()[0] if self.done.exists() else 0
        if done >= last:                        # another timer of this group has reported them
            return
        held = _held(self.seen, SEEN_ROWS)
        ends = pd.concat([held.assign(end=held["day"] + n) for n in range(1, WINDOW_DAYS + 1)])
        ends = ends[(ends["end"] > done) & (ends["end"] <= last)].drop_duplicates(["member_id", "end", "provider_id"])
        found = ends.groupby(["member_id", "end"], dropna=False).size()
        found = found[found >= self.least].reset_index(name="providers")
        kept = held[held["day"] + WINDOW_DAYS > last]
        if len(kept) < len(held):
            _put(self.seen, kept, SEEN_ROWS)
        if len(kept):
            self.done.update((last,))
            self.handle.registerTimer(max(int(kept["day"].min()), last) * DAY_MS + DAY_MS)
        else:
            self.done.clear()
        if len(found):
            end = found["end"].astype("int64")
            yield pd.DataFrame({"member_id": found["member_id"].astype(object).where(found["member_id"].notna(), None),
                                "window_start": pd.to_datetime((end - WINDOW_DAYS) * DAY_MS, unit="ms"),
                                "window_end": pd.to_datetime(end * DAY_MS, unit="ms"), "providers": found["providers"]})

    def close(self) -> None:
        pass


class DuplicateClaims(StatefulProcessor):
    """Pairs within ``hours`` whose amounts differ by less than ``gap`` of the claim with the smaller id."""

    def __init__(self, hours: int, gap: float):
        self.band, self.gap = hours * 3_600_000, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", PACKED)

    def pairs(self, claims: pd.DataFrame, held: int) -> pd.DataFrame:
        """Pairs of ``claims`` of which at least one is not among the first ``held`` rows.

        Rows stand in order of key and time; a row meets its next, then its second next, and so
        on, and leaves once that one has another key or is past the band.
        """
        who = claims.groupby(WHO, dropna=False, sort=False).ngroup().to_numpy()
        ts, amount, name = claims["ts_ms"].to_numpy("int64"), claims["amount"].to_numpy("float64"), claims["claim_id"].to_numpy(object)
        order = np.lexsort((ts, who))
        who, ts, amount, name, fresh = who[order], ts[order], amount[order], name[order], order >= held
        firsts, seconds = [], []
        at, step = np.arange(len(order)), 0
        while len(at):
            step += 1
            at = at[at + step < len(order)]
            to = at + step
            near = (who[at] == who[to]) & (ts[to] - ts[at] <= self.band)
            at, to = at[near], to[near]
            new = fresh[at] | fresh[to]
            i, j = at[new], to[new]
            swap = (name[j] < name[i]).astype(bool)
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = (name[i] != name[j]).astype(bool) & (amount[i] != 0) & (np.abs(amount[i] - amount[j]) / amount[i] < self.gap)
            firsts.append(name[i[hit]])
            seconds.append(name[j[hit]])
        return pd.DataFrame({"original_claim_id": np.concatenate(firsts), "potential_duplicate_id": np.concatenate(seconds)})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([b[RECENT] for b in rows])
        if not len(fresh):
            return
        held = _held(self.recent, RECENT_ROWS)
        found = self.pairs(pd.concat([held, fresh], ignore_index=True) if len(held) else fresh.reset_index(drop=True), len(held))
        self.recent.appendList(_packed(fresh, RECENT_ROWS))
        self._wait(fresh)
        if len(found):
            yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _held(self.recent, RECENT_ROWS)
        kept = held[held["ts_ms"] + self.band >= timerValues.getCurrentWatermarkInMs()]
        if len(kept) < len(held):
            _put(self.recent, kept, RECENT_ROWS)
            if len(kept):
                self._wait(kept)
        return iter(())

    def _wait(self, claims: pd.DataFrame) -> None:
        """A timer at the end of the hour in which the first of these claims leaves the band."""
        self.handle.registerTimer(((int(claims["ts_ms"].min()) + self.band) // 3_600_000 + 1) * 3_600_000)

    def close(self) -> None:
        pass


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias("part")


def provider_spread_keyed(stream: DataFrame, least: int, ts: str = "submitted_at", parts: int = PARTS) -> DataFrame:
    """R07 over a stream with a watermark on ``ts``."""
    keyed = stream.select(_part(["member_id"], parts), "member_id", "provider_id",
                          F.unix_millis(F.col(ts).cast("timestamp")).alias("ts_ms"), ts).where("ts_ms is not null")
    return keyed.groupBy("part").transformWithStateInPandas(
        statefulProcessor=ProviderSpread(least), outputStructType=SPREAD, outputMode="Append", timeMode="EventTime")


def duplicate_claims_keyed(stream: DataFrame, hours: int = 48, gap: float = 0.05, ts: str = "submitted_at", parts: int = PARTS) -> DataFrame:
    """R08 over a stream with a watermark on ``ts``: each pair when its second claim arrives."""
    keyed = stream.select(_part(WHO, parts), *WHO, "claim_id", F.col("amount_claimed").cast("double").alias("amount"),
                          F.unix_millis(F.col(ts).cast("timestamp")).alias("ts_ms"), ts).where("amount is not null and ts_ms is not null")
    return keyed.groupBy("part").transformWithStateInPandas(
        statefulProcessor=DuplicateClaims(hours, gap), outputStructType=PAIRS, outputMode="Append", timeMode="EventTime")


def run_keyed(stream: DataFrame, detector, sink: str, checkpoint: str, ts: str = "submitted_at") -> list[dict]:
    """Run what has landed through ``detector`` into a Parquet sink and return the progress of its triggers.

    The RocksDB store is asked for only while this query is started.
    """
    spark, name = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        q = (detector(event_time(stream, ts).withWatermark(ts, WATERMARK)).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before)
    q.awaitTermination()
    return [p if isinstance(p, dict) else p.jsonValue for p in q.recentProgress]


def state_sizes(progress: list[dict]) -> list[int]:
    """Keyed-state rows held after each trigger."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]


def _replayed(rel, detector, schema: str) -> DataFrame:
    """The detector (of a stream and its number of groups) over all claims, landed by day and read in several triggers."""
    spark: SparkSession = rel.claims.sparkSession
    root, landed = f"{checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}", Observation()
    # a month of claims lands as one directory, so a trigger reads whole months
    months = rel.claims.withColumn("_month", F.trunc(F.to_date("submitted_at"), "month")).observe(landed, F.count(F.lit(1)).alias("claims"))
    write_replay(months, "_month", f"{root}/claims", compression="gzip")
    parts = max(PARTS, landed.get["claims"] // CLAIMS_PER_PART)
    run_keyed(read_replay(spark, f"{root}/claims", "claims", 30), lambda s: detector(s, parts), f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(schema).parquet(f"{root}/out")


@register("stream_r07_spread_keyed", sql=(
    "WITH w AS (SELECT member_id, provider_id, CAST(CAST(submitted_at AS DATE) AS TIMESTAMP) - r.d * INTERVAL 1 DAY AS ws "
    "FROM claims, range(0, 7) r(d)), last AS (SELECT max(submitted_at) - INTERVAL 2 DAY AS mark FROM claims) "
    "SELECT member_id, ws AS window_start, ws + INTERVAL 7 DAY AS window_end, COUNT(DISTINCT provider_id) AS providers "
    "FROM w, last WHERE ws + INTERVAL 7 DAY <= mark GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT provider_id) >= 3"))
def spread_keyed(rel) -> DataFrame:
    """R07 by keyed state over several triggers: every window that the watermark has closed."""
    out = _replayed(rel, lambda s, parts: provider_spread_keyed(s, 3, parts=parts), SPREAD)
    return out.select("member_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "providers")


@register("stream_r08_duplicates_keyed", sql=(
    "SELECT a.claim_id AS original_claim_id, b.claim_id AS potential_duplicate_id FROM claims a JOIN claims b "
    "ON a.member_id = b.member_id AND a.provider_id = b.provider_id AND a.diagnosis_code = b.diagnosis_code "
    "AND a.claim_id < b.claim_id AND b.submitted_at BETWEEN a.submitted_at - INTERVAL 720 HOUR AND a.submitted_at + INTERVAL 720 HOUR "
    "WHERE abs(CAST(a.amount_claimed AS DOUBLE) - CAST(b.amount_claimed AS DOUBLE)) / NULLIF(CAST(a.amount_claimed AS DOUBLE), 0) < 0.2"))
def duplicates_keyed(rel) -> DataFrame:
    """R08 by keyed state over several triggers (30 days, 20 %): each pair once, when its second claim arrives."""
    return _replayed(rel, lambda s, parts: duplicate_claims_keyed(s, 720, 0.2, parts=parts), PAIRS)


__all__ = ["DuplicateClaims", "ProviderSpread", "duplicate_claims_keyed", "provider_spread_keyed", "run_keyed", "state_sizes"]
