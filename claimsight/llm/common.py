"""Shared helpers: table readers, Arrow text access and vectorised hashing.

The numpy helpers work on the concatenated UTF-8 bytes of a slice of an Arrow
batch (a few MB), so a task's memory does not depend on the partition size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 20
U = np.uint64
#: odd multipliers of the hashes (any odd 64-bit numbers do)
BASE = U(0x9E3779B97F4A7C15)
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = 2_000


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches of at most ``BATCH_ROWS`` rows in its session: long texts otherwise fill a task's memory."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Only where no cluster names one (tests) a local folder is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        import tempfile
        found = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back (cuts the lineage)."""
    import uuid
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty; offsets has one entry more than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` text bytes; a longer text stands alone."""
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> U(30))
    x *= MIX1
    x ^= x >> U(27)
    x *= MIX2
    x ^= x >> U(31)
    return x


_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n, kept per process."""
    key = str(int(base))
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[key] = have
    return have[:n]


_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    word = ~_space[data]
    before = np.empty(len(data), bool)
    before[1:] = word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(len(data), bool)
    after[:-1] = word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(word & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z lowered)."""
    total = np.zeros(len(data) + 1, U)
    np.cumsum((( _lower[data] if lower else data).astype(U) + U(1)) * powers(BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(BASE_INVERSE, len(data) + 1)[starts])


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle of ``width`` words; a row of fewer words has its whole sequence as one."""
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = word_hashes(data, starts, ends, lower)
    n = len(h)
    g = np.zeros(max(0, n - width + 1), U)
    for k in range(width):
        g = g * BASE + h[k: n - width + 1 + k] if len(g) else g
    whole = rows[:len(g)] == rows[width - 1:] if len(g) else np.zeros(0, bool)
    out, at = mix(g[whole]), rows[:len(g)][whole]
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.zeros(len(short), U)
        for k in range(width - 1):
            has = counts[short] > k
            extra[has] = extra[has] * BASE + h[first[has] + k]
        extra = mix(extra * MIX1 + U(width) + counts[short].astype(U))
        out, at = np.concatenate([out, extra]), np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at


def distinct_sorted(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), by row and then hash; ``rows`` must not descend."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[keep], rows[keep]


def lowest(h: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> list[np.ndarray]:
    """The ``k`` smallest distinct hashes of each row, ascending; ``rows`` must not descend."""
    counts = np.bincount(rows, minlength=n_rows)
    starts = np.concatenate([[0], np.cumsum(counts)])
    # hashes are uniform: all but a few of a long row cannot be among its k smallest
    with np.errstate(divide="ignore"):
        bound = np.where(counts > 4 * k, (k + 6 * np.sqrt(k) + 10) / np.maximum(counts, 1) * 2.0**64, 2.0**64 - 4096)
    keep = h <= np.minimum(bound, 2.0**64 - 4096).astype(U)[rows]
    keep |= (counts <= 4 * k)[rows]
    sh, sr = distinct_sorted(h[keep], rows[keep])
    at = np.searchsorted(sr, np.arange(n_rows + 1))
    out = []
    for i in range(n_rows):
        own = sh[at[i]: min(at[i + 1], at[i] + k)]
        if len(own) < k and counts[i] > 4 * k:       # many repeats: the bound was too low for this row
            own = np.unique(h[starts[i]: starts[i + 1]])[:k]
        out.append(own)
    return out


def ranges(docs: DataFrame, column: str, most: int, rows_each: int) -> list[float]:
    """Ascending split points of a numeric column into at most ``most`` ranges of about ``rows_each`` rows."""
    from pyspark.sql import functions as F
    n = docs.agg(F.count(column)).first()[0]
    parts = int(min(most, max(1, -(-n // rows_each))))
    if parts == 1:
        return []
    at = docs.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 20 * most)).first()[0]
    return sorted({float(x) for x in at})


def range_of(docs: DataFrame, column: str, splits: list[float], out: str) -> DataFrame:
    """``docs`` with the range number of ``column`` (binary search; it never descends as the column grows; nulls last)."""
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql import functions as F
    edges = [float("-inf"), *splits, float("inf")]
    if len(edges) < 3:
        return docs.withColumn(out, F.when(F.col(column).isNull(), 1).otherwise(0))
    temp = docs.withColumn("__as_double", F.col(column).cast("double"))
    found = Bucketizer(splits=edges, inputCol="__as_double", outputCol=out, handleInvalid="keep").transform(temp)
    return found.withColumn(out, F.col(out).cast("int")).drop("__as_double")
