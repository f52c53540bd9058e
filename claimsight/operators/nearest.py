"""Exact nearest neighbours among the rows of one table, in blocks.

Equal points are one point with its first ids.  The distinct points are dealt over the
leaves of a k-d tree, whose cuts come from a bounded sample; the cuts steer only which
rows lie together.  Each leaf is searched by itself first, which gives every point a
limit: the distance of its last neighbour so far.  The point is then sent to each other
leaf whose bounding box is not farther than that limit, and to none else, and the best of
all answers are its neighbours.  Nothing is left out: a leaf farther than the limit
holds no nearer point.  Distances are sums of squares in the order of the columns, which
the bounds follow step by step, so they hold in floating point too.

A task holds one leaf and at most ``PROBES`` points that ask it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: points that the cuts are taken from; points sent to a leaf that one task answers; points compared with a leaf at once
SAMPLED, PROBES, AT_ONCE = 50_000, 50_000, 256
NEAR = pa.list_(pa.struct([("distance", pa.float64()), ("id", pa.string())]))
_NEAR = "array<struct<distance: double, id: string>>"


class Cuts:
    """A k-d tree: inner node i goes on to ``low`` where column ``by`` is at most ``at``, else to ``high``; a leaf has its number."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.by, self.at, self.low, self.high, self.leaves = [], [], [], [], 0
        self._grow(sample, leaves)

    def _grow(self, x: np.ndarray, leaves: int) -> int:
        node = len(self.by)
        for part in (self.by, self.at, self.low, self.high):
            part.append(0)
        if leaves > 1 and len(x) > 1:
            spread = x.max(axis=0) - x.min(axis=0)
            by = int(np.argmax(x.std(axis=0) * (spread > 0)))
            if spread[by] > 0:
                ordered = np.sort(x[:, by])
                at = ordered[(len(x) - 1) // 2]
                if at == ordered[-1]:
                    at = ordered[np.searchsorted(ordered, at) - 1]
                left = x[:, by] <= at
                few = min(leaves - 1, max(1, round(leaves * left.mean())))
                self.by[node], self.at[node] = by, at
                self.low[node] = self._grow(x[left], few)
                self.high[node] = self._grow(x[~left], leaves - few)
                return node
        self.by[node], self.at[node] = -1, self.leaves
        self.leaves += 1
        return node

    def leaf(self, x: np.ndarray) -> np.ndarray:
        by, at, low, high = map(np.asarray, (self.by, self.at, self.low, self.high))
        node = np.zeros(len(x), dtype="int64")
        inner = np.flatnonzero(by[node] >= 0)
        while len(inner):
            n = node[inner]
            node[inner] = np.where(x[inner, by[n]] <= at[n], low[n], high[n])
            inner = inner[by[node[inner]] >= 0]
        return at[node].astype("int32")


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        total += d * d
    return total


def search(x: np.ndarray, limit: np.ndarray, own: np.ndarray | None, y: np.ndarray, ids: list[list[str]], k: int):
    """(row of ``x``, distance, id): the first ``k`` ids of the rows of ``y`` no farther than ``limit``, nearest first, then by id.

    ``own`` is the row of ``y`` that a row of ``x`` is itself.
    """
    counts = np.fromiter(map(len, ids), "int64", len(ids))
    flat = np.array([i for some in ids for i in some], dtype=object)
    rank = np.empty(len(flat), "int64")
    rank[np.argsort(np.array([i.encode() for i in flat], dtype=object), kind="stable")] = np.arange(len(flat))
    starts = np.cumsum(counts) - counts
    size, sizes = (x * x).sum(axis=1), (y * y).sum(axis=1)
    slack = (4 * x.shape[1] + 64) * np.finfo("float64").eps
    rows, far, names = [], [], []
    for lo in range(0, len(x), AT_ONCE):
        part = slice(lo, lo + AT_ONCE)
        rough = size[part, None] + sizes - 2 * (x[part] @ y.T)
        wide = slack * (size[part] + sizes.max(initial=0))[:, None]
        if own is not None:
            rough[np.arange(len(rough)), own[part]] = np.inf
        most = limit[part, None]
        if k < len(y):                       # no id is farther than the k-th of the points
            most = np.minimum(most, np.partition(rough, k - 1, axis=1)[:, k - 1:k] + wide)
        q, p = np.nonzero((rough <= most + wide) & np.isfinite(rough))
        exact = _squared(x[lo + q], y[p])
        keep = exact <= limit[lo + q]
        q, p, exact = q[keep], p[keep], exact[keep]
        times = counts[p]
        q, exact = np.repeat(q, times), np.repeat(exact, times)
        at = np.repeat(starts[p], times) + np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
        order = np.lexsort((rank[at], exact, q))
        q, exact, at = q[order], exact[order], at[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        rows.append(lo + q[keep])
        far.append(exact[keep])
        names.append(flat[at[keep]])
    if not rows:
        return np.zeros(0, "int64"), np.zeros(0), np.zeros(0, object)
    return np.concatenate(rows), np.concatenate(far), np.concatenate(names)


def _lists(rows: np.ndarray, far: np.ndarray, names: np.ndarray, n: int) -> pa.Array:
    ends = np.searchsorted(rows, np.arange(n + 1)).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(far), pa.array(names, pa.string())], ["distance", "id"]))


def _wanted(counts: np.ndarray, k: int) -> np.ndarray:
    """How many ids of other points a point needs beside its own."""
    return np.maximum(0, k - (counts - 1))


def own_leaf(boxes: np.ndarray, k: int):
    """For a leaf's points: their neighbours in it, the limit and the other leaves (``to``) within it."""
    def run(points: pa.Table) -> pa.Table:
        x = _matrix(points["x"], boxes.shape[2])
        ids, leaf = points["ids"].to_pylist(), points["leaf"][0].as_py()
        rows, far, names = search(x, np.full(len(x), np.inf), np.arange(len(x)), x, ids, k)
        wanted = _wanted(np.fromiter(map(len, ids), "int64", len(ids)), k)
        first = np.searchsorted(rows, np.arange(len(x) + 1))
        limit = np.full(len(x), np.inf)            # of a point that has not found enough yet
        limit[wanted == 0] = -1.0                  # its own ids are enough
        full = (wanted > 0) & (first[:-1] + wanted <= first[1:])
        limit[full] = far[(first[:-1] + wanted - 1)[full]]
        to = []
        for lo in range(0, len(x), AT_ONCE):
            a, total = x[lo:lo + AT_ONCE], 0.0
            for j in range(x.shape[1]):
                d = np.maximum(np.maximum(boxes[0, :, j] - a[:, j, None], a[:, j, None] - boxes[1, :, j]), 0.0)
                total = total + d * d
            near = total <= limit[lo:lo + AT_ONCE, None]
            near[:, leaf] = False
            to += [np.flatnonzero(r).astype("int32") for r in near]
        return pa.table({"id": pa.array([i[0] for i in ids], pa.string()), "x": points["x"].combine_chunks(), "ids": points["ids"].combine_chunks(),
                         "limit": pa.array(limit), "near": _lists(rows, far, names, len(x)), "to": pa.array(to, pa.list_(pa.int32()))})
    return run


def other_leaf(width: int, k: int):
    """Answers of a leaf's points to those that were sent to it."""
    def run(points: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(asked) or not len(points):
            return pa.table({"id": pa.array([], pa.string()), "near": pa.array([], NEAR)})
        found = search(_matrix(asked["x"], width), asked["limit"].to_numpy(), None, _matrix(points["x"], width), points["ids"].to_pylist(), k)
        return pa.table({"id": asked["id"].combine_chunks(), "near": _lists(*found, len(asked))})
    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nearest(rows: DataFrame, key: str, place: str, k: int, most: int, seed: int) -> DataFrame:
    """``key`` and ``near``: array<struct<distance, id>> of the ``k`` nearest other keys (all, if fewer), nearest first, ties by id as text.

    ``place`` is an array of doubles, all of one length.  A key of several places has the smallest of them; rows of
    which the key is null or the place is not finite take no part.  ``most`` is the size that leaves are meant to have.
    """
    finite = F.forall(F.col(place), lambda v: F.abs(v) < float("inf"))
    known = rows.where(F.col(key).isNotNull() & finite).groupBy(F.col(key).cast("string").alias("id")).agg(F.min(place).alias("x")) \
        .withColumn("n", F.row_number().over(Window.partitionBy("x").orderBy("id")))
    # ids after the first k + 1 of a place are nobody's neighbours
    points = _stored(known.where(F.col("n") <= k + 1).groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")
    n, width, crowd = points.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(F.size("ids"))).first()
    kind = rows.schema[key].dataType
    if not n:
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind.simpleString()}, near {_NEAR}")
    drawn = points.select("x") if n <= SAMPLED else points.where(F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 20)) < F.lit((1 << 20) * SAMPLED // n)).select("x")
    cuts = Cuts(np.array([r[0] for r in drawn.collect()], dtype="float64").reshape(-1, width), min(-(-n // most), SAMPLED // 16))

    def dealt(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(cuts.leaf(_matrix(b.column("x"), width))), *b.columns], ["leaf", *b.schema.names])

    leaves = points.mapInArrow(dealt, "leaf int, x array<double>, ids array<string>")
    boxes = np.full((2, cuts.leaves, width), np.inf)             # of an empty leaf: farther than any limit
    for leaf, lo, hi in leaves.groupBy("leaf").agg(F.array(*[F.min(F.col("x")[j]) for j in range(width)]),
                                                   F.array(*[F.max(F.col("x")[j]) for j in range(width)])).collect():
        boxes[:, leaf] = lo, hi
    searched = _stored(leaves.groupBy("leaf").applyInArrow(own_leaf(boxes, k), f"id string, x array<double>, ids array<string>, limit double, near {_NEAR}, to array<int>"), "searched")
    asking = searched.select("id", "x", "limit", F.explode("to").alias("leaf"))
    # a leaf that many ask is copied for each PROBES of them
    many = {r[0]: -(-r[1] // PROBES) for r in asking.groupBy("leaf").count().collect()}
    answers = searched.select("id", "near")
    if many:
        copies = F.element_at(F.array(*[F.lit(many.get(i, 0)) for i in range(cuts.leaves)]), F.col("leaf") + 1)
        asking = asking.withColumn("copy", F.pmod(F.xxhash64("id"), copies).cast("int"))
        copied = leaves.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).withColumn("copy", F.col("copy") - 1) if max(many.values()) > 1 \
            else leaves.withColumn("copy", F.lit(0))
        answers = answers.unionByName(copied.groupBy("leaf", "copy").cogroup(asking.groupBy("leaf", "copy")).applyInArrow(
            other_leaf(width, k), f"id string, near {_NEAR}").where(F.size("near") > 0))
    best = answers.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    mates = searched.select("id", "ids").join(best, "id").select(F.explode("ids").alias("id"), "ids", "near")
    zero = F.transform(F.filter("ids", lambda i: i != F.col("id")), lambda i: F.struct(F.lit(0.0).alias("distance"), i.alias("id")))
    out = mates.select("id", F.slice(F.array_sort(F.concat(zero, "near")), 1, k).alias("near"))
    if crowd > k:
        late = F.transform(F.slice("ids", 1, k), lambda i: F.struct(F.lit(0.0).alias("distance"), i.alias("id")))
        out = out.unionByName(known.where(F.col("n") > k + 1).join(points, "x").select("id", late.alias("near")))
    return out.select(F.col("id").cast(kind).alias(key), "near")
