"""Nearest neighbours by largest inner product: a vantage-point tree per shard.

Inner product becomes a distance: with ``M`` the largest norm of all vectors,
every vector gets one more coordinate ``sqrt(M*M - |x|*|x|)`` and every query a
zero, so ``|q-x|**2 = |q|**2 + M*M - 2 q.x`` and the nearest point has the
largest inner product.  Each shard (rows dealt by a hash of the id) builds one
tree: a node keeps its vantage point and the range of distances to it of either
half.  A block of queries walks the tree together, nearer half first for each
query; the triangle inequality bounds from below the distance to anything in a
half, and a half is skipped for a query when ``factor`` times that bound
exceeds the query's k-th best distance.  ``factor`` 1 is exact; a larger one
skips more and may miss neighbours.

Every row is indexed.  Blocks of queries meet shards by an equi-join on the
shard number (a stated query set against all rows, in blocks); per pair at most
k rows for each query leave, and a windowed top-k over the shards ends it.
Scores are sums in the order of the dimensions, in double precision, so equal
vectors have bit-equal scores in every shard and ties fall to the smaller id.

Results: vectors that are null, of all zeros, or that hold a null or non-finite
component take no part, nor do rows without id; a query meets only vectors of
its own length; rows with the query's id are its own; repeated candidate rows
each count; fewer candidates than k are all returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 16_384
BLOCK_QUERIES = 512
LEAF = 256
K = 20
#: what the registered query uses; see README for recall and skipped work of larger ones
FACTOR = 1.0


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, each summed in the order of the dimensions."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


class Tree:
    """Vantage-point tree over points with the added coordinate."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, most: float, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.leaf = ids[order], x[order], leaf
        squares = np.einsum("ij,ij->i", self.x, self.x)
        self.points = np.column_stack([self.x, np.sqrt(np.maximum(most * most - squares, 0.0))])
        self.most = most
        self.root = self._build(np.arange(len(ids)))

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        middle = self.points[at].mean(0)
        vantage = self.points[at[np.argmax(((self.points[at] - middle) ** 2).sum(1))]]
        far = np.sqrt(((self.points[at] - vantage) ** 2).sum(1))
        order = np.argsort(far, kind="stable")
        half = len(at) // 2
        near, rest = order[:half], order[half:]
        return (vantage, (far[near[0]], far[near[-1]]), (far[rest[0]], far[rest[-1]]),
                self._build(np.sort(at[near])), self._build(np.sort(at[rest])))

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, float]:
        """(ids, scores) of shape (queries, k), best first, id -1 where there are fewer; and the share of pairs scored."""
        n = len(q)
        best, who = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
        wide = np.column_stack([q, np.zeros(n)])
        squares = np.einsum("ij,ij->i", q, q) + self.most * self.most
        slack = 1e-9 * np.sqrt(squares + self.most * self.most)
        rounding = 1e-12 * np.sqrt(np.einsum("ij,ij->i", q, q)) * self.most
        scored = 0

        def reach(rows):
            last = best[rows, -1]
            with np.errstate(invalid="ignore"):
                return np.where(np.isinf(last), np.inf, np.sqrt(np.maximum(squares[rows] - 2 * last, 0.0)))

        def look(at, rows):
            nonlocal scored
            scored += len(at) * len(rows)
            # a matrix product, good to a rounding error, picks the pairs whose exact score may enter
            rough = q[rows] @ self.x[at].T
            rough[self.ids[at][None, :] == query_ids[rows][:, None]] = -np.inf
            i, j = np.nonzero((rough >= (best[rows, -1] - rounding[rows])[:, None]) & (rough > -np.inf))
            if not len(i):
                return
            old_i, old_j = np.nonzero(who[rows] >= 0)
            row = np.concatenate([old_i, i])
            score = np.concatenate([best[rows][old_i, old_j], scores(q[rows[i]], self.x[at[j]])])
            ids = np.concatenate([who[rows][old_i, old_j], self.ids[at][j]])
            order = np.lexsort((ids, -score, row))
            row, score, ids = row[order], score[order], ids[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < k
            best[rows[row[keep]], place[keep]] = score[keep]
            who[rows[row[keep]], place[keep]] = ids[keep]

        def walk(node, rows):
            if not len(rows):
                return
            if isinstance(node, np.ndarray):
                look(node, rows)
                return
            vantage, (a, b), (c, d), near, rest = node
            far = np.sqrt(((wide[rows] - vantage) ** 2).sum(1))
            to_near, to_rest = np.maximum(0, np.maximum(far - b, a - far)), np.maximum(0, np.maximum(far - d, c - far))
            first = far < (b + c) / 2

            def go(child, bound, which):
                some = rows[which]
                walk(child, some[factor * bound[which] <= reach(some) + slack[some]])

            go(near, to_near, first)
            go(rest, to_rest, ~first)
            go(near, to_near, ~first)
            go(rest, to_rest, first)

        walk(self.root, np.arange(n))
        return who, best, scored / max(1, n * len(self.ids))


def _packed(rows: DataFrame, group: list[str]) -> DataFrame:
    """One row for each group: ids as int64 bytes and vectors as double bytes."""
    schema = ", ".join([*(f"{g} int" for g in group), "ids binary", "vectors binary"])
    names = [*group, "ids", "vectors"]

    def pack(frame):
        vectors = np.stack(frame["vector"].combine_chunks().to_numpy(zero_copy_only=False)).astype("<f8")
        ids = frame["id"].to_numpy().astype("<i8")
        return pa.table([*(frame[g].slice(0, 1) for g in group), pa.array([ids.tobytes()], pa.binary()),
                         pa.array([vectors.tobytes()], pa.binary())], names)

    return rows.groupBy(*group).applyInArrow(pack, schema)


def search(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, id_col: str = "vec_id",
           vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the k rows of ``vectors`` of largest inner product."""
    def clean(df):
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
            F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dim", F.size("vector"))

    rows, asked = clean(vectors), clean(queries).dropDuplicates(["id", "vector"])
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("m"))
    shape = {r["dim"]: (-(-r["n"] // shard_rows), float(r["m"]) ** 0.5 * (1 + 1e-12)) for r in sizes.collect()}
    if not shape:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = F.create_map(*[F.lit(v) for d, (n, _) in shape.items() for v in (d, int(n))])
    index = _packed(rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards[F.col("dim")]).cast("int")), ["dim", "shard"])
    n_queries = asked.groupBy("dim").count()
    blocks = F.greatest(F.lit(1), F.ceil(F.col("count") / BLOCK_QUERIES)).cast("int")
    asked = asked.join(F.broadcast(n_queries.select("dim", blocks.alias("blocks"))), "dim")   # one row for each vector length
    asked = _packed(asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")), ["dim", "block"])
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), shards[F.col("dim")] - 1)))
    pairs = (index.join(asked.select("dim", "block", "shard", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), ["dim", "shard"]))

    def find(frame):
        dim = frame["dim"][0].as_py()
        out_q, out_n, out_i, out_s = [], [], [], []
        for row in frame.to_pylist():
            ids, x = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
            q_ids, q = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_vectors"], "<f8").reshape(-1, dim)
            who, best, _ = Tree(ids, x, shape[dim][1]).search(q_ids, q, k, factor)
            i, j = np.nonzero(who >= 0)
            out_q.append(q_ids[i])
            out_n.append(row["block"] * np.int64(BLOCK_QUERIES * 64) + i)
            out_i.append(who[i, j])
            out_s.append(best[i, j])
        return pa.table([np.concatenate(out_q), np.concatenate(out_n), np.concatenate(out_i), np.concatenate(out_s)],
                        ["query_id", "query_row", "vec_id", "score"])

    found = pairs.groupBy("dim", "shard", "block").applyInArrow(find, "query_id long, query_row long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def digests(embeddings: DataFrame, factor: float = FACTOR) -> DataFrame:
    """The contract's rows: queries are the rows whose vec_id is divisible by 20."""
    return search(embeddings, embeddings.where(F.col("vec_id") % 20 == 0), factor=factor)


SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.e, x.e) AS score FROM v q JOIN v x
      ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id AND len(x.e) = len(q.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
