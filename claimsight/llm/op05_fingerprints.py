"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's five-word
shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered; a text of fewer words is
one shingle).  Sketches of parts merge into the sketch of the whole (the k
smallest of the union), and two sketches estimate resemblance, containment and
the number of distinct shingles.  Written form: base64 of the ascending hashes,
each as its upper 40 bits, so equal texts have equal fingerprints.

``neighbours`` puts every document beside the next one by ascending id: the
table is cut into ranges of ids (split points by an approximate quantile, at
most ``MAX_RANGES``), the first document of each range also goes to the range
before it, and each sorted range is read as a stream with one row of look-ahead.
One shuffle of the texts; no range, group or table is held in memory.

Results: null and empty texts have the empty sketch; two empty sketches are
alike (1), an empty and a filled one are not (0); a null id comes last;
repeated ids stand in the order of their texts; a table of one row is its own
next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import U, bounded_batches, lowest, range_of, ranges, shingle_hashes, slices, utf8

K = 128
WIDTH = 5
BYTES = 5                    # of each hash in the written form
MAX_RANGES = 4096
ROWS_EACH = 2000


# ------------------------------------------------------------------ sketches
def sketches(column: pa.Array, k: int = K) -> list[np.ndarray]:
    """The sketch of each text of an Arrow column, as ascending 40-bit numbers."""
    data, offsets = utf8(column)
    h, rows = shingle_hashes(data, offsets, WIDTH)
    return [np.unique(x >> U(64 - 8 * BYTES)) for x in lowest(h, rows, len(offsets) - 1, k)]


def written(sketch: np.ndarray) -> str:
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BYTES:]
    return base64.b64encode(wide.tobytes()).decode("ascii")


def read(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - BYTES:] = raw
    return wide.reshape(-1).view(">u8").astype(U)


def merged(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all parts together."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, U)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the union's k smallest hashes that both hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    return float((counts[:k] == 2).mean())


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles (exact below k)."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) + 1) * 2.0 ** (8 * BYTES)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds too."""
    if not len(a):
        return 1.0
    union = distinct(merged([a, b], k), k)
    return float(min(1.0, resemblance(a, b, k) * union / max(distinct(a, k), 1.0)))


# ------------------------------------------------------------------ DataFrames
def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), k: int = K, out: str = "fingerprint") -> DataFrame:
    """``keep`` columns and each text's fingerprint; no shuffle."""
    rows = docs.select(*keep, text)
    schema = StructType([*(rows.schema[c] for c in keep), StructField(out, StringType())])

    def run(batches):
        for batch in (part for b in batches for part in slices(b, text)):
            found = [written(s) for s in sketches(batch.column(len(keep)), k)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(found, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def merge_by(prints: DataFrame, key: str, fingerprint: str = "fingerprint", k: int = K, salts: int = 64) -> DataFrame:
    """One fingerprint for each key: partly merged by (key, salt), so a hot key is spread, then by key."""
    schema = StructType([prints.schema[key], StructField(fingerprint, StringType())])
    names = schema.names

    def join(frame):
        sketch = np.zeros(0, U)
        for x in frame[fingerprint].to_pylist():
            sketch = merged([sketch, read(x)], k)
        return pa.table([frame[key].slice(0, 1), pa.array([written(sketch)], pa.string())], names)

    salted = prints.select(key, fingerprint, (F.abs(F.xxhash64(fingerprint)) % salts).alias("__salt"))
    return salted.groupBy(key, "__salt").applyInArrow(join, schema).groupBy(key).applyInArrow(join, schema)


def neighbours(docs: DataFrame, fn, schema: StructType, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``fn(keys, texts, next_texts)`` -> arrays of ``schema``, over all rows in ascending order of ``key``.

    The row after the last is the first.
    """
    spark = docs.sparkSession
    rows = bounded_batches(docs).select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    splits = ranges(rows, "id", MAX_RANGES, ROWS_EACH)
    ranged = range_of(rows, "id", splits, "range")
    # the first id of each range (at most MAX_RANGES + 2 of them) is the next of the range before it
    firsts = [(r[0], r[1]) for r in range_of(rows.select("id"), "id", splits, "range").groupBy("range").agg(F.min("id")).orderBy("range").collect()]
    moves = spark.createDataFrame([(r, i, firsts[(n - 1) % len(firsts)][0]) for n, (r, i) in enumerate(firsts)],
                                  f"range int, id {rows.schema['id'].dataType.simpleString()}, before int")
    guests = (ranged.join(F.broadcast(moves), (ranged["range"] == moves["range"]) & ranged["id"].eqNullSafe(moves["id"]))
              .select(moves["before"].alias("range"), ranged["id"], ranged["text"], F.lit(1).alias("guest")))
    dealt = ranged.select("range", "id", "text", F.lit(0).alias("guest")).unionByName(guests)
    nulls_last = [F.col("range"), F.col("guest"), F.col("id").asc_nulls_last(), F.col("text")]
    ordered = dealt.repartition(F.col("range")).sortWithinPartitions(*nulls_last).select("id", "text", "guest")

    def run(batches):
        held: list[tuple] = []                        # own rows whose next is not known yet
        for batch in (part for b in batches for part in slices(b, "text")):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][2] and row[2]:
                    continue                          # a second guest of the same range (a repeated id)
                held.append(row)
            yield from emit(held)
            held = held[-1:]

    def emit(held):
        own = [(a[0], a[1], b[1]) for a, b in zip(held, held[1:], strict=False) if not a[2]]
        for at in range(0, len(own), 256):
            part = own[at: at + 256]
            yield pa.RecordBatch.from_arrays(fn([x[0] for x in part], [x[1] for x in part], [x[2] for x in part]), schema.names)

    return ordered.mapInArrow(run, schema)


def digests(docs: DataFrame, k: int = K) -> DataFrame:
    """The contract's row of each document: its fingerprint, the edited text's and both likenesses."""
    schema = StructType([docs.schema["doc_id"], StructField("n_chars", LongType()), StructField("edited_sha256", StringType()),
                         StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()),
                         StructField("near_edited", DoubleType()), StructField("near_next", DoubleType()),
                         StructField("distinct_shingles", DoubleType())])

    def fn(ids, texts, after):
        cuts = [len(t) // 4 for t in texts]
        edited = [t[: len(t) - c] + n[:c] for t, n, c in zip(texts, after, cuts, strict=True)]
        own, new = sketches(pa.array(texts, pa.large_string()), k), sketches(pa.array(edited, pa.large_string()), k)
        following = [*own[1:], *sketches(pa.array(after[-1:], pa.large_string()), k)]
        # the next row of a batch is the next document unless a guest stood between them
        following = [s if n is t else sketches(pa.array([n], pa.large_string()), k)[0]
                     for s, n, t in zip(following, after, [*texts[1:], after[-1]], strict=True)]
        return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(map(written, own), pa.string()), pa.array(map(written, new), pa.string()),
                pa.array([resemblance(a, b, k) for a, b in zip(own, new, strict=True)], pa.float64()),
                pa.array([resemblance(a, b, k) for a, b in zip(own, following, strict=True)], pa.float64()),
                pa.array([distinct(a, k) for a in own], pa.float64())]

    return neighbours(docs, fn, schema)
