import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from claimsight.operators.writes import VersionedTable, upsert_claims
from claimsight.sources.io import write_replay
from claimsight.streaming.jobs import (append_events_sink, member_spread_windows, parse_messages, provider_bursts,
                                       read_replay, run_detector, stream_backlog, upsert_claims_sink)


def _replay(rel, scratch, table, ts):
    path = os.path.join(scratch, table)
    write_replay(getattr(rel, table), ts, path)
    return path


def _closed(frame, end, last):
    """Windows that a watermark of two days has closed by the last event."""
    return frame.filter(F.col(end) <= F.lit(last) - F.expr("INTERVAL 2 DAYS"))


@pytest.fixture()
def four_writers(spark):
    """Several writer tasks and no merging of small partitions, so days land from several tasks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("detector,end", [(lambda s: provider_bursts(s, 1), "window_end"), (lambda s: member_spread_windows(s, 2, ts="submitted_at"), "window_end")])
def test_detector_over_many_triggers_equals_batch(spark, rel, scratch, four_writers, detector, end):
    path = _replay(rel, scratch, "claims", "submitted_at")
    assert len({f.split("part-")[1].split("-")[0] for f in __import__("glob").glob(f"{path}/day=*/part-*")}) >= 3      # written by several tasks
    stream = read_replay(spark, path, "claims", max_files_per_trigger=300)
    sink = os.path.join(scratch, "windows")
    q = run_detector(stream, detector, "submitted_at", sink, os.path.join(scratch, "ck1"))
    q.awaitTermination(900)
    batch = detector(rel.claims.withColumn("submitted_at", F.col("submitted_at").cast("timestamp")))
    last = rel.claims.agg(F.max(F.col("submitted_at").cast("timestamp"))).first()[0]
    got, exp = spark.read.parquet(sink), _closed(batch, end, last)
    got = _closed(got, end, last)
    assert exp.count() > 0 and got.select(exp.columns).exceptAll(exp).count() == 0 == exp.exceptAll(got.select(exp.columns)).count()


def test_replay_resumes_at_a_day(spark, rel, scratch):
    path = _replay(rel, scratch, "claims", "submitted_at")
    q = (read_replay(spark, path, "claims", 5000, from_day=dt.date(1996, 1, 1)).writeStream.format("parquet").option("path", f"{scratch}/resumed")
         .option("checkpointLocation", f"{scratch}/ck-resume").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.read.parquet(f"{scratch}/resumed").count() == rel.claims.filter(F.col("submitted_at") >= F.lit("1996-01-01")).count() > 0


def test_merge_keeps_old_rows_by_a_uri_and_commits_whole(spark, rel, scratch):
    from claimsight.operators.writes import BucketedTable
    table = BucketedTable(spark, f"file://{scratch}/by_uri", "claim_id", rows_per_bucket=500)
    cols = [c for c in rel.claims.columns if c != "_loaded_at"]
    batch = rel.claims.select(*cols).withColumn("_arrival", F.lit(1))
    ts = dt.datetime(2001, 8, 2)
    table.merge(batch, lambda cur, b: upsert_claims(rel.claims.limit(0), b, ts))
    n, before = rel.claims.count(), table.current_version()
    assert table.read().count() == n and table.manifest()[-1] > 4
    one = batch.limit(1).withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 9 DAYS")).withColumn("status", F.lit("closed"))

    def broken(cur, b):
        return upsert_claims(cur, b, ts).withColumn("status", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        table.merge(one, broken)
    assert table.current_version() == before and table.read().count() == n          # a failed merge leaves the old state
    table.merge(one, lambda cur, b: upsert_claims(cur, b, ts))
    assert table.read().count() == n and table.read().filter("status = 'closed'").count() == 1 + rel.claims.filter("status = 'closed'").count()
    table.vacuum()
    assert table.read().count() == n


def test_versions_by_a_uri(spark, scratch):
    t = VersionedTable(spark, "t", root=f"file://{scratch}")
    assert t.read() is None
    for n in (3, 5, 7):
        t.commit(spark.range(n))
    assert t.read().count() == 7 and t.current_version() == 3
    os.makedirs(f"{scratch}/t/v=000004")                                              # what a failed commit leaves
    assert t.current_version() == 3
    t.commit(spark.range(9))
    t.vacuum(1)
    assert t.read().count() == 9 and os.listdir(f"{scratch}/t") == ["v=000004"]


def test_foreach_batch_upsert_matches_batch_upsert(spark, rel, scratch):
    path = _replay(rel, scratch, "claims", "updated_at")
    stream = read_replay(spark, path, "claims", max_files_per_trigger=1000)
    vt = VersionedTable(spark, "claims_state", root=scratch)
    q = (stream.writeStream.foreachBatch(upsert_claims_sink(vt, __import__("datetime").datetime(2001, 8, 2)))
         .option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = vt.read().select("claim_id", "status", "updated_at").collect()
    assert len(got) == rel.claims.count()
    assert {r.claim_id for r in got} == {r.claim_id for r in rel.claims.select("claim_id").collect()}
    # a replay of the same files through a fresh checkpoint changes nothing
    q2 = (read_replay(spark, path, "claims", 3000).writeStream.foreachBatch(upsert_claims_sink(vt))
          .option("checkpointLocation", os.path.join(scratch, "ck3")).trigger(availableNow=True).start())
    q2.awaitTermination(600)
    again = {(r.claim_id, r.status, r.updated_at) for r in vt.read().select("claim_id", "status", "updated_at").collect()}
    assert again == {(r.claim_id, r.status, r.updated_at) for r in got}


def test_backlog_counts_unconsumed_files(spark, rel, scratch):
    path = _replay(rel, scratch, "claim_events", "event_at")
    ck = os.path.join(scratch, "ck4")
    vt = VersionedTable(spark, "events_state", root=scratch)
    q = (read_replay(spark, path, "claim_events", 1000).writeStream.foreachBatch(append_events_sink(vt))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(600)
    b = stream_backlog(spark, path, ck).first()
    assert b.pending_files == 0 and b.status == "OK"
    assert vt.read().count() == rel.claim_events.count()


def test_dead_letters_split(spark, rel):
    from claimsight.streaming.jobs import claim_messages
    good, bad = parse_messages(claim_messages(rel), "claims", "claims")
    n = rel.claims.count()
    assert good.count() + bad.count() == n and bad.count() > 0
    assert set(r.error_message.split(":")[0] for r in bad.select("error_message").distinct().collect()) <= {
        "missing key", "unparseable JSON", "missing or invalid", "invalid"}


def test_member_spread_windows_batch(rel):
    assert member_spread_windows(rel.claims, 2).count() > 0


def test_stream_stream_duplicates_and_phantoms(spark, rel, scratch):
    from claimsight.streaming.jobs import duplicate_pairs_stream, event_time, phantom_stream
    path = _replay(rel, scratch, "claims", "submitted_at")
    s = event_time(read_replay(spark, path, "claims", 5000), "submitted_at").withWatermark("submitted_at", "2 days")
    d = duplicate_pairs_stream(s, s, hours=24 * 30, max_rel_gap=0.2)
    q = (d.writeStream.format("parquet").option("path", os.path.join(scratch, "dups"))
         .option("checkpointLocation", os.path.join(scratch, "ck5")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {(r.original_claim_id, r.potential_duplicate_id) for r in spark.read.parquet(os.path.join(scratch, "dups")).collect()}
    b = event_time(rel.claims, "submitted_at")
    exp = {(r.original_claim_id, r.potential_duplicate_id) for r in duplicate_pairs_stream(b, b, 24 * 30, 0.2).collect()}
    assert got == exp
    vpath = _replay(rel, scratch, "vitals", "_loaded_at")
    v = event_time(read_replay(spark, vpath, "vitals", 5000), "_loaded_at").withWatermark("_loaded_at", "2 days")
    ph = phantom_stream(s, v)
    q2 = (ph.writeStream.format("parquet").option("path", os.path.join(scratch, "ph"))
          .option("checkpointLocation", os.path.join(scratch, "ck6")).trigger(availableNow=True).start())
    q2.awaitTermination(600)
    streamed = {r.claim_id for r in spark.read.parquet(os.path.join(scratch, "ph")).collect()}
    batch = {r.claim_id for r in phantom_stream(b, event_time(rel.vitals, "_loaded_at")).collect()}
    assert streamed <= batch and len(streamed) > 0


def test_bucketed_upsert_sink_rewrites_touched_buckets(spark, rel, scratch):
    from claimsight.operators.writes import BucketedTable
    from claimsight.streaming.jobs import upsert_claims_bucketed_sink
    import datetime as dt
    path = _replay(rel, scratch, "claims", "updated_at")
    table = BucketedTable(spark, os.path.join(scratch, "claims_b"), "claim_id", buckets=16)
    q = (read_replay(spark, path, "claims", 1200).writeStream
         .foreachBatch(upsert_claims_bucketed_sink(table, dt.datetime(2001, 8, 2)))
         .option("checkpointLocation", os.path.join(scratch, "ck7")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {(r.claim_id, r.status, r.updated_at) for r in table.read().collect()}
    exp = {(r.claim_id, r.status, r.updated_at) for r in rel.claims.collect()}
    assert got == exp
    # one more batch touching a few claims rewrites only their buckets
    upd = rel.claims.limit(3).withColumn("status", F.lit("closed")) \
        .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY")).drop("_loaded_at") \
        .withColumn("_arrival", F.lit(1))
    from claimsight.operators.writes import upsert_claims
    table.merge(upd, lambda cur, b: upsert_claims(cur, b, dt.datetime(2001, 8, 3)))
    after = table.read()
    assert after.count() == len(exp) and after.filter(F.col("status") == "closed").count() >= 3


def test_ingest_sink_routes_good_rows_and_dead_letters(spark, rel, scratch):
    from claimsight.streaming.jobs import claim_messages, ingest_sink
    src = os.path.join(scratch, "claims_topic")
    claim_messages(rel).write.mode("overwrite").json(src)
    good_p, bad_p = os.path.join(scratch, "good"), os.path.join(scratch, "dlq")

    def writer(path):
        return lambda df, bid: df.write.mode("append").parquet(path)
    q = (spark.readStream.schema("key string, value string").json(src).writeStream
         .foreachBatch(ingest_sink("claims", "claims", writer(good_p), writer(bad_p)))
         .option("checkpointLocation", os.path.join(scratch, "ck8")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    good, bad = spark.read.parquet(good_p), spark.read.parquet(bad_p)
    assert good.count() + bad.count() == rel.claims.count() and bad.count() > 0
    assert {r.error_message.split(":")[0] for r in bad.select("error_message").distinct().collect()} == {
        "missing key", "unparseable JSON", "missing or invalid", "invalid"}


def test_restart_from_checkpoint_processes_only_new_files(spark, rel, scratch):
    import datetime as dt
    from claimsight.operators.writes import BucketedTable
    from claimsight.streaming.jobs import upsert_claims_bucketed_sink
    path, ck = os.path.join(scratch, "claims_land"), os.path.join(scratch, "ck9")
    days = rel.claims.withColumn("day", F.to_date("updated_at"))
    cut = F.lit("1998-01-01").cast("date")
    days.filter(F.col("day") < cut).write.mode("overwrite").partitionBy("day").json(path)
    table = BucketedTable(spark, os.path.join(scratch, "claims_r"), "claim_id", buckets=8)

    def run():
        q = (read_replay(spark, path, "claims", 5000).writeStream
             .foreachBatch(upsert_claims_bucketed_sink(table, dt.datetime(2001, 8, 2)))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(600)
        return q.recentProgress
    first = run()
    n1 = table.read().count()
    days.filter(F.col("day") >= cut).write.mode("append").partitionBy("day").json(path)   # files landing while stopped
    second = run()
    got = {(r.claim_id, r.status) for r in table.read().collect()}
    assert n1 < len(got) == rel.claims.count()
    assert got == {(r.claim_id, r.status) for r in rel.claims.collect()}
    # the file source's commit log: every landed file was read exactly once across both runs
    log = spark.read.text(f"{ck}/sources/0").filter(F.col("value").startswith("{")) \
        .select(F.get_json_object("value", "$.path").alias("p"))
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path) \
        .filter(F.col("path").endswith(".json")).count()
    assert log.count() == log.distinct().count() == landed and first and second


def test_keyed_state_equals_batch_over_triggers_and_a_restart(spark, rel, scratch):
    from claimsight.streaming.jobs import r08_batch
    from claimsight.streaming.keyed_state import duplicate_claims_keyed, provider_spread_keyed, run_keyed, state_sizes
    path, late = os.path.join(scratch, "claims"), F.col("submitted_at") >= F.lit("1997-06-01").cast("timestamp_ntz")
    claims = rel.claims.withColumn("_month", F.trunc(F.to_date("submitted_at"), "month"))
    last = rel.claims.agg(F.max("submitted_at")).first()[0]
    progress = {}
    for part, mode in ((claims.filter(~late), "overwrite"), (claims.filter(late), "append")):
        if mode == "overwrite":
            write_replay(part, "_month", path)
        else:                                                   # lands while the streams are stopped
            part.withColumn("day", F.col("_month")).coalesce(1).sortWithinPartitions("_month").write.mode("append").partitionBy("day").json(path)
            from claimsight.sources.io import order_days
            order_days(spark, path)
        for name, detector in (("spread", lambda s: provider_spread_keyed(s, 3)), ("pairs", lambda s: duplicate_claims_keyed(s, 720, 0.2))):
            stream = read_replay(spark, path, "claims", 30)
            progress.setdefault(name, []).extend(run_keyed(stream, detector, os.path.join(scratch, name), os.path.join(scratch, name + "_ck")))
    got = {(r.member_id, str(r.window_end), r.providers) for r in spark.read.parquet(os.path.join(scratch, "spread")).collect()}
    truth = _closed(member_spread_windows(rel.claims, 3, ts="submitted_at"), "window_end", last)
    assert got == {(r.member_id, str(r.window_end), r.providers) for r in truth.collect()} and len(got) > 100
    assert spark.read.parquet(os.path.join(scratch, "spread")).count() == len(got)
    pairs = spark.read.parquet(os.path.join(scratch, "pairs"))
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, r08_batch(rel, 720, 0.2).collect())) and pairs.count() > 0
    for name, steps in progress.items():
        sizes = state_sizes(steps)
        assert len(sizes) >= 3 and max(sizes) > 0, name
        # what is held is what open windows need, far below all claims, and it falls when timers expire
        assert sizes[-1] < max(sizes) < rel.claims.count() / 2, (name, sizes)
