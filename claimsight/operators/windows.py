"""Skew-safe window primitives shared by rules and features.

A RANGE frame partitioned by an entity alone puts all rows of a hot entity
(a provider with a third of all claims) into one sorted partition.  These
primitives key the window by (entity, time bucket of the frame width) and
copy each row into one neighbour bucket, so a partition never spans more
than two frame widths of one entity; the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_counts(df: DataFrame, key, ts_col: str, windows: dict[str, int], id_col: str,
                   distinct_col: str | None = None, forward: bool = False, span: int = 1) -> DataFrame:
    """For every row: number of rows of the same ``key`` with time in
    ``[t - w, t]`` (current row and ties included) for each named window ``w``
    (seconds); with ``distinct_col`` the number of distinct values instead;
    with ``forward`` the frame is ``[t, t + w]``.

    Layout: bucket width = ``span`` times the largest window; each row is a probe
    in its own bucket and data there, and data in the next bucket when it lies in
    the last window of its own (1 + 1 / ``span`` copies), so every frame fits in
    one (key, bucket) partition.  A forward frame is a backward frame
    on the negated time axis.
    """
    keys = [key] if isinstance(key, str) else list(key)
    longest = max(windows.values())
    width = span * longest
    t = F.unix_seconds(F.col(ts_col).cast("timestamp"))
    if forward:
        t = -t
    base = df.select(*keys, id_col, t.alias("_t"), *([distinct_col] if distinct_col else []))
    base = base.withColumn("_b", F.floor(F.col("_t") / width))
    both = F.array(F.lit(0), F.lit(1))
    if span > 1:                 # rows without time stay in their own bucket
        both = F.when(F.col("_t") >= (F.col("_b") + 1) * width - longest, both).otherwise(F.array(F.lit(0)))
    rows = base.select("*", F.explode(both).alias("_shift")) \
        .withColumn("_pb", F.col("_b") + F.col("_shift"))
    w = Window.partitionBy(*keys, "_pb").orderBy("_t")
    outs = []
    for name, sec in windows.items():
        frame = w.rangeBetween(-sec, 0)
        if distinct_col:
            outs.append(F.size(F.collect_set(distinct_col).over(frame)).alias(name))
        else:
            outs.append(F.count(F.lit(1)).over(frame).alias(name))
    x = rows.select(*keys, id_col, "_shift", *outs)
    return x.filter(F.col("_shift") == 0).drop("_shift")


def rolling_counts_by_slot(df: DataFrame, key: str, ts_col: str, windows: dict[str, int], at: str, slot: int = 3600) -> DataFrame:
    """(key, ``at``: second, counts): number of rows of ``key`` with time in ``[at - w, at]``
    for each named window ``w``, a multiple of ``slot`` seconds.

    Rows are counted per second, then dealt by (key, block of four times the
    longest window); seconds of a block's last window also go to the next block,
    so 1.25 copies are shuffled.  Inside a block each second adds itself and, for
    each window, a mark at the window's start: one running sum over seconds and
    marks gives the count up to the second and the counts before its windows,
    whose differences are the results.  The marks are made after the rows are
    dealt, each row is added once, and a partition holds at most five windows of
    one key in seconds, however many rows the key has.  Rows without key or time
    are left out.
    """
    if any(w <= 0 or w % slot for w in windows.values()):
        raise ValueError("windows must be multiples of the slot")
    longest = max(windows.values())
    block = 4 * longest
    t = F.unix_seconds(F.col(ts_col).cast("timestamp"))
    seconds = (df.select(key, t.alias(at)).where(F.col(key).isNotNull() & F.col(at).isNotNull())
               .groupBy(key, at).agg(F.count(F.lit(1)).alias("_n")))
    own = F.floor(F.col(at) / block)
    late = F.col(at) >= (own + 1) * block - longest
    dealt = seconds.select(key, at, "_n", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))).alias("_b"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, key, "_b")
    # (place, mark, rows): mark 0 is the second itself, mark i the start of window i; marks come before the seconds of their place
    names = list(windows)
    itself = F.struct(F.col(at).alias("p"), F.lit(0).alias("m"), F.col("_n").alias("n"))
    starts = [F.struct((F.col(at) - windows[name]).alias("p"), F.lit(i).alias("m"), F.lit(0).cast("long").alias("n")) for i, name in enumerate(names, 1)]
    places = dealt.select(key, "_b", at, F.inline(F.when(own == F.col("_b"), F.array(itself, *starts)).otherwise(F.array(itself))))
    w = Window.partitionBy(key, "_b").orderBy("p", F.col("m") == 0).rowsBetween(Window.unboundedPreceding, 0)
    sums = places.select(key, "_b", at, "m", F.sum("n").over(w).alias("_c"))
    of = sums.where(own == F.col("_b")).groupBy(key, "_b", at).agg(*[F.max(F.when(F.col("m") == i, F.col("_c"))).alias(f"_c{i}") for i in range(len(names) + 1)])
    return of.select(key, at, *[(F.col("_c0") - F.col(f"_c{i}")).alias(name) for i, name in enumerate(names, 1)])


def asof_rate(events: DataFrame, probes: DataFrame, key: str, ev_ts: str, probe_ts: str, flag: str,
              probe_id: str, cast: str = "int") -> DataFrame:
    """For each probe: (events of its key strictly before probe time, flagged
    ones among them) - no event from the future leaks into a feature.  With
    another ``cast`` than int, ``flag`` is a value and the second its sum.

    Day blocks: totals per (key, day) are prefix-summed over the key's days with
    events or probes (bounded by the calendar), rows of the probe's own day are
    counted in a (key, day) partition, where events of one instant are one row.
    """
    e = events.select(key, F.col(ev_ts).alias("_t"), F.col(flag).cast(cast).alias("_f")).where("_t is not null") \
        .groupBy(key, "_t").agg(F.count(F.lit(1)).alias("_n"), F.sum("_f").alias("_f"))
    e = e.withColumn("_d", F.to_date("_t"))
    p = probes.select(key, probe_id, F.col(probe_ts).alias("_t"), F.to_date(F.col(probe_ts)).alias("_d"))
    kind = e.schema["_f"].dataType
    # probes sort before events of the same instant (strictly before)
    u = (e.select(key, "_d", "_t", F.lit(1).alias("_ord"), F.lit(None).cast("string").alias(probe_id), "_n", "_f")
         .unionByName(p.select(key, "_d", "_t", F.lit(0).alias("_ord"), probe_id, F.lit(0).cast("long").alias("_n"), F.lit(0).cast(kind).alias("_f"))))
    w = Window.partitionBy(key, "_d").orderBy("_t", "_ord").rowsBetween(Window.unboundedPreceding, 0)
    day = u.groupBy(key, "_d").agg(F.sum("_n").alias("_n"), F.sum("_f").alias("_f"))
    past = Window.partitionBy(key).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    prior = day.select(key, "_d", F.sum("_n").over(past).alias("_pn"), F.sum("_f").over(past).alias("_pf"))
    u = u.select(key, "_d", "_ord", probe_id, F.sum("_n").over(w).alias("_in"), F.sum("_f").over(w).alias("_inf")).filter(F.col("_ord") == 0)
    return u.join(prior, [key, "_d"]).select(
        probe_id, (F.coalesce("_pn", F.lit(0)) + F.col("_in")).alias("prior_events"),
        (F.coalesce("_pf", F.lit(0)) + F.coalesce("_inf", F.lit(0))).alias("prior_flagged"))


def running_sum_by_day(df: DataFrame, key: str, date_col: str, tie_col: str, value: str, reset_col=None) -> DataFrame:
    """Running sum of ``value`` per ``key`` in (date, tie) order, optionally
    restarting at each value of ``reset_col`` (e.g. the year), as two windows:
    day totals prefix-summed over the key's days (rows bounded by the
    calendar) plus the running sum inside one (key, day).  A key with a huge
    history never becomes one sorted partition.  Returns (key, tie_col, running)."""
    reset = [reset_col] if reset_col is not None else []
    day = df.groupBy(key, date_col, *reset).agg(F.sum(value).alias("_dt"))
    wd = Window.partitionBy(key, *reset).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    prior = day.select(key, date_col, F.coalesce(F.sum("_dt").over(wd), F.lit(0)).alias("_prior"))
    wi = Window.partitionBy(key, date_col).orderBy(tie_col).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.select(key, date_col, tie_col, F.sum(value).over(wi).alias("_in"))
    return inner.join(prior, [key, date_col]).select(key, tie_col, (F.col("_prior") + F.col("_in")).alias("running"))


def days_since_previous(df: DataFrame, key: str, date_col: str, tie_col: str) -> DataFrame:
    """``lag(date)`` gap per key in (date, tie) order, computed as: 0 for all
    but the first row of a (key, day); for the first, the gap to the key's
    previous distinct day (a window over distinct days - bounded by the
    calendar).  Returns (key, tie_col, gap)."""
    days = df.select(key, date_col).distinct()
    prev = days.select(key, date_col, F.lag(date_col).over(Window.partitionBy(key).orderBy(date_col)).alias("_prev"))
    rn = F.row_number().over(Window.partitionBy(key, date_col).orderBy(tie_col))
    x = df.select(key, date_col, tie_col, rn.alias("_rn")).join(prev, [key, date_col])
    gap = F.when(F.col("_rn") == 1, F.datediff(F.col(date_col), F.col("_prev"))).otherwise(F.lit(0))
    return x.select(key, tie_col, gap.alias("gap"))


def next_time_in_key(df: DataFrame, key: str, ts_col: str, tie_col: str, name: str = "next_ts") -> DataFrame:
    """``df`` with the next ``ts`` of its key in (ts, tie) order as ``name``; rows without a key or a ts are left out.

    One shuffle of the rows on the key.  A key's rows are sorted (spilling) and
    streamed, so this is for keys with few rows each, like the events of a claim.
    """
    w = Window.partitionBy(key).orderBy(ts_col, tie_col)
    return df.where(F.col(key).isNotNull() & F.col(ts_col).isNotNull()).withColumn(name, F.lead(ts_col).over(w))


# ------------------------------------------------------ windows that rows carry
def with_slot_counts(df: DataFrame, key: str, ts_col: str, windows: dict[str, int], slot: int = 3600) -> DataFrame:
    """``df`` with the counts of :func:`rolling_counts_by_slot` at each row's own second; null for rows without key or time.

    The rows themselves are dealt by (key, block), so nothing has to be joined back to them: a row adds itself
    and a mark at the start of each window, and a row in a block's last window also goes to the next
    block, there as its second alone.
    """
    if any(w <= 0 or w % slot for w in windows.values()):
        raise ValueError("windows must be multiples of the slot")
    longest = max(windows.values())
    block = 4 * longest
    others = [c for c in df.columns if c != key]
    t, own = F.col("_t"), F.floor(F.col("_t") / block)
    whole = F.struct(*others)
    rows = df.withColumn("_t", F.unix_seconds(F.col(ts_col).cast("timestamp")))
    here, there = F.struct(own.alias("_b"), whole.alias("_row")), F.struct((own + 1).alias("_b"), F.when(F.lit(False), whole).alias("_row"))
    late = F.col(key).isNotNull() & (t >= (own + 1) * block - longest)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.select(key, "_t", F.inline(F.when(late, F.array(here, there)).otherwise(F.array(here)))).repartition(parts, key, "_b")
    row, none = F.col("_row"), F.when(F.lit(False), F.col("_row"))
    itself = F.struct(t.alias("p"), F.lit(0).alias("m"), F.lit(1).alias("n"), row.alias("_row"))
    # marks come before the seconds of their place
    marks = [F.struct((t - w).alias("p"), F.lit(i).alias("m"), F.lit(0).alias("n"), none.alias("_row")) for i, w in enumerate(windows.values(), 1)]
    places = spread.select(key, "_b", "_t", row.isNotNull().alias("_own"), F.inline(F.when(row.isNotNull(), F.array(itself, *marks)).otherwise(F.array(itself))))
    past = Window.partitionBy(key, "_b").orderBy("p", F.col("m") == 0).rangeBetween(Window.unboundedPreceding, 0)
    sums = places.withColumn("_c", F.sum("n").over(past)).where("_own")
    second = Window.partitionBy(key, "_b", "_t")
    counts = [(F.col("_c") - F.max(F.when(F.col("m") == i, F.col("_c"))).over(second)) for i in range(1, len(windows) + 1)]
    known = F.col(key).isNotNull() & t.isNotNull()
    return sums.select(key, "m", "_row", *[F.when(known, c).alias(name) for name, c in zip(windows, counts, strict=True)]) \
        .where("m = 0").select(key, *[F.col(f"_row.{c}").alias(c) for c in others], *windows)


def with_days_since_previous(df: DataFrame, key: str, date_col: str, tie_col: str, name: str) -> DataFrame:
    """``df`` with the gap of :func:`days_since_previous` as ``name``; rows have a key and a date.  A key's rows are streamed through one task."""
    before = F.lag(date_col).over(Window.partitionBy(key).orderBy(date_col, tie_col))
    return df.withColumn(name, F.datediff(F.col(date_col), before))


def with_distinct_in_days(df: DataFrame, key: str, date_col: str, value: str, days: int, name: str) -> DataFrame:
    """``df`` with the number of distinct ``value`` of the key in the ``days`` days up to and with the row's own."""
    frame = Window.partitionBy(key).orderBy(F.unix_date(date_col)).rangeBetween(1 - days, 0)
    return df.withColumn(name, F.size(F.collect_set(value).over(frame)))


def with_prior_sum(df: DataFrame, keys: list[str], ev_ts: str, probe_ts: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of its ``keys`` whose ``ev_ts`` lies strictly before its ``probe_ts``
    (its own, too); rows without ``probe_ts`` are left out, but count in the sums of others."""
    at, no = F.col(probe_ts), F.lit(0).cast(df.schema[value].dataType)
    entries = F.array(F.when(at.isNotNull(), F.struct(at.alias("_at"), F.lit(0).alias("_ord"), no.alias("_add"))),
                      F.when(F.col(ev_ts).isNotNull() & F.col(value).isNotNull(), F.struct(F.col(ev_ts).alias("_at"), F.lit(1).alias("_ord"), F.col(value).alias("_add"))))
    past = Window.partitionBy(*keys).orderBy("_at", "_ord").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.inline(F.array_compact(entries))).withColumn(name, F.sum("_add").over(past)).where("_ord = 0").drop("_at", "_ord", "_add")
