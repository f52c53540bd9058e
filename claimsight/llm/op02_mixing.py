"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them); the flow network is patterns -> sources, whose arcs carry words:

* a pattern offers its words once for each repetition up to ``max_repeats``,
  the r-th repetition at a cost that grows with r (convex), so no pattern is
  repeated a second time while a first use elsewhere can fill the quota;
* a source takes at most its target.

Only the pattern table (one row per distinct set of sources, not per document)
reaches the solver, and its size is checked against ``max_patterns``.  Each
pattern's flow to a source is then dealt to documents: full repetitions to
all, the rest to the first documents in a seeded order.  The seeded order is
cut by prefix sums over (pattern, hash bucket) sums, so no source is ever
sorted in one task.

Targets: the words of all documents shared by weight, none above
``max_repeats`` times its source's words, the excess shared again by weight
among the others until none is above.

Results: a null text has size 0 and takes 0; a null source is a source of its
own, after all others; repeated rows are separate documents; ties of the
seeded order fall by all of the row's id and size; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: weights of the sources in code point order, repeating
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
MAX_PATTERNS = 200_000
#: hex digits of the seeded order that make its buckets (4096 within each pattern)
BUCKET_DIGITS = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[object, int]], weights: list[float], max_repeats: int) -> list[float]:
    """Share the total by weight with every share at most ``max_repeats`` times its size (water filling)."""
    total = float(sum(n for _, n in sizes))
    out = [0.0] * len(sizes)
    left, open_ = total, list(range(len(sizes)))
    while open_:
        per = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if per * weights[i] > max_repeats * sizes[i][1]]
        if not above:
            for i in open_:
                out[i] = per * weights[i]
            break
        for i in above:
            out[i] = float(max_repeats * sizes[i][1])
            left -= out[i]
        open_ = [i for i in open_ if i not in above]
    return out


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], max_repeats: int) -> dict[tuple[int, int], int]:
    """Words that each (pattern, source) pair carries: fills the quotas as far as possible at least cost.

    Successive shortest paths with potentials; the r-th repetition of a pattern costs r.  Nodes: start,
    patterns, sources, end.
    """
    p, s = len(patterns), len(quotas)
    start, end = p + s, p + s + 1
    graph: list[list[int]] = [[] for _ in range(p + s + 2)]
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def arc(a, b, cap, c):
        for u, v, x, y in ((a, b, cap, c), (b, a, 0, -c)):
            graph[u].append(len(to))
            to.append(v)
            room.append(x)
            cost.append(y)
        return len(to) - 2

    for i, (_, words) in enumerate(patterns):
        for r in range(1, max_repeats + 1):
            arc(start, i, words, r)
    carried = {(i, j): arc(i, p + j, max_repeats * words, 0) for i, (members, words) in enumerate(patterns) for j in members}
    for j, quota in enumerate(quotas):
        arc(p + j, end, quota, 0)
    potential = [0] * (p + s + 2)
    while True:
        far = [float("inf")] * (p + s + 2)
        far[start], came, queue = 0, {}, [(0, start)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > far[u]:
                continue
            for e in graph[u]:
                if room[e] > 0 and (n := d + cost[e] + potential[u] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], came[to[e]] = n, e
                    heapq.heappush(queue, (n, to[e]))
        if far[end] == float("inf"):
            break
        for v, d in enumerate(far):
            if d < float("inf"):
                potential[v] += d
        path, v = [], end
        while v != start:
            path.append(came[v])
            v = to[came[v] ^ 1]
        most = min(room[e] for e in path)
        for e in path:
            room[e] -= most
            room[e ^ 1] += most
    return {k: room[e ^ 1] for k, e in carried.items() if room[e ^ 1]}


def mix(docs: DataFrame, members: Column, size: Column, weights: tuple[float, ...] = WEIGHTS,
        max_repeats: int = MAX_REPEATS, order: Column | None = None, max_patterns: int = MAX_PATTERNS,
        out: tuple[str, str, str] = ("size", "pattern", "taken")) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with its size, pattern and words taken, named by ``out``; the sources with ``source_size`` and ``target``).

    Columns of ``docs`` that are named as ``out`` are replaced.

    ``members``: array<string> of the sources that hold a row (null element: the null source).
    ``order``: a string that decides, ascending, which documents come first for a partial repetition;
    it should be a seeded hash.
    """
    spark = docs.sparkSession
    if order is None:
        order = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("string")))
    # the set of sources as JSON: a key that tells a null source from any name
    others = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    sized = docs.select(*others, size.alias("__size"), F.array_sort(F.array_distinct(members)).alias("__pattern"), order.alias("__order"))
    sized = (sized.withColumn("__key", F.to_json("__pattern"))
             .withColumn("__bucket", F.conv(F.substring("__order", 1, BUCKET_DIGITS), 16, 10).cast("int")))
    # one row per pattern and bucket of the seeded order: a hot source is summed before it is shuffled
    sums = (sized.groupBy("__key", "__bucket").agg(F.first("__pattern").alias("pattern"), F.sum("__size").alias("words"))
            .transform(lambda df: stored(df, "mix-sums")))
    rows = (sums.groupBy("__key").agg(F.first("pattern").alias("pattern"), F.sum("words").alias("words"))
            .limit(max_patterns + 1).collect())
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    rows.sort(key=lambda r: r["__key"])
    names = sorted({m for r in rows for m in r["pattern"]}, key=lambda m: (m is None, m or ""))
    at = {m: j for j, m in enumerate(names)}
    patterns = [(tuple(sorted(at[m] for m in r["pattern"])), int(r["words"])) for r in rows]
    held = [0] * len(names)
    for member, words in patterns:
        for j in member:
            held[j] += words
    aims = targets(list(zip(names, held, strict=True)), [float(weights[j % len(weights)]) for j in range(len(names))], max_repeats)
    flow = min_cost_flow(patterns, [int(x + 0.5) for x in aims], max_repeats)
    given = [0] * len(patterns)
    for (i, _), words in flow.items():
        given[i] += words
    plan = spark.createDataFrame([(r["__key"], g // w if w else 0, g % w if w else 0) for r, g, (_, w) in zip(rows, given, patterns, strict=True)],
                                 "__key string, __full long, __rest long")
    # the bucket in which each pattern's partial repetition ends, and the words before it: one row per pattern
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (sums.withColumn("__before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(plan, "__key")
           .groupBy("__key").agg(F.first("__full").alias("__full"), F.first("__rest").alias("__rest"),
                                 F.min(F.when(F.col("__before") + F.col("words") > F.col("__rest"), F.struct("__bucket", "__before"))).alias("__cut")))
    # one row per pattern, at most ``max_patterns``: a proven bound for the broadcast, and a hot source stays spread
    dealt = sized.join(F.broadcast(cut), "__key")
    ends = F.coalesce(F.col("__cut.__bucket"), F.lit(-1))
    # buckets before and after the cut need no order; only those of the cut are summed row by row
    whole = dealt.where(F.col("__bucket") != ends).withColumn("__extra", F.col("__bucket") < ends)
    edge = dealt.where(F.col("__bucket") == ends)
    rows_before = Window.partitionBy("__key").orderBy("__order", "__size").rowsBetween(Window.unboundedPreceding, -1)
    # a document is taken when more than half of it lies before the cut
    edge = edge.withColumn("__extra", F.col("__cut.__before") + F.coalesce(F.sum("__size").over(rows_before), F.lit(0))
                           + F.col("__size") / 2 < F.col("__rest"))
    mixed = whole.unionByName(edge).select(
        *others, F.col("__size").alias(out[0]), F.col("__pattern").alias(out[1]),
        (F.col("__size") * (F.col("__full") + F.col("__extra").cast("long"))).alias(out[2]))
    sources = spark.createDataFrame(list(zip(names, held, aims, strict=True)), "source string, source_size long, target double")
    return mixed, sources


def digests(docs: DataFrame) -> DataFrame:
    """The contract's row of each document."""
    mixed, sources = mix(docs.select("doc_id", "source", "text"), F.array("source"), size_of(F.col("text")))
    of = sources.select(F.to_json(F.array("source")).alias("__key"), "source_size", "target")
    return (mixed.withColumn("__key", F.to_json("pattern")).join(of, "__key")
            .select("doc_id", "size", "source_size", "target", "taken"))


def oracle_sql() -> str:
    """The contract's rows in DuckDB: the water filling in closed form, the flow of patterns of one source each."""
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS j FROM d GROUP BY source),
w AS (SELECT *, CASE j % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM g),
o AS (SELECT *, row_number() OVER (ORDER BY {MAX_REPEATS} * source_size / w, j) AS k FROM w),
l AS (SELECT o.k, {MAX_REPEATS} * o.source_size / o.w AS ratio, (sum(source_size) OVER () -
        coalesce(sum({MAX_REPEATS} * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, source_size, least({MAX_REPEATS} * source_size::DOUBLE,
        w * (SELECT level FROM l WHERE level <= ratio ORDER BY k LIMIT 1)) AS target FROM w),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS full_,
        CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS rest FROM t),
x AS (SELECT doc_id, size, source_size, target, full_, rest, coalesce(sum(size) OVER (PARTITION BY d.source
        ORDER BY md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (size * (full_ + CASE WHEN before + size / 2.0 < rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM x"""
