"""Cross-tokenizer alignment: sparse products of token-byte incidence matrices.

A text is cut into units, runs of blanks with the word behind them: before a
single blank that follows a non-space both tokenizers always have a boundary, so
a unit's tokens are those that it has in the whole text.  Units repeat, so each
is encoded once per worker, and whatever the alignment needs is kept for it.

For the units of a batch the tokens of A and B are rows of two incidence matrices
over the bytes, in CSR form built by hand.  Gustavson's row products give

* A · Bᵀ: the overlap links (which occurrences share a byte);
* G_A · G_Bᵀ, where G_A and G_B are the incidences of tokens and groups: the
  links of occurrences that share a group.  Groups are the stretches between byte
  offsets at which tokens of both end.

A pair's count is the number of documents that hold it linked.  Texts are taken in
chunks of about ``CHUNK_BYTES``: each has a table of its distinct pairs with their
document counts, and its documents refer to that table.  Only these tables are
shuffled by pair; the corpus-wide counts return to the chunks, so a pair that stands
everywhere is one row for each chunk.

Results: null and empty texts, and texts whose joined tokens are not a blank and the
text (with U+2581, say), have no tokens and zeros; repeated rows each get their own
row and count as a document each; very long texts form chunks of their own; a text
without blanks is one unit; an empty table gives an empty result; other columns are
ignored unless listed in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import slices, stored, utf8

#: text bytes of a chunk: it bounds what a task holds, and how often a pair is shuffled
CHUNK_BYTES = 4 << 20
#: units and their bytes kept per worker; beyond either the store starts anew (memory only, never results)
KEPT_UNITS, KEPT_BYTES = 200_000, 32 << 20
#: units are encoded together in texts of about so many characters
RUN_CHARS = 1 << 16
CHUNKS_OF_A_TASK = 1 << 20


class CSR:
    """A 0/1 matrix: row i has its columns at indices[indptr[i]:indptr[i + 1]]."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, n_columns: int):
        self.indptr, self.indices, self.n_columns = indptr, indices, n_columns

    @classmethod
    def of_spans(cls, ends: np.ndarray) -> CSR:
        """Rows of adjacent spans over their places: span i covers the places up to ends[i]."""
        n = int(ends[-1]) if len(ends) else 0
        return cls(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), n)

    @classmethod
    def of_labels(cls, labels: np.ndarray, n_columns: int) -> CSR:
        """Rows of one column each."""
        return cls(np.arange(len(labels) + 1), labels, n_columns)

    def transposed(self) -> CSR:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.n_columns)
        return CSR(np.concatenate([[0], np.cumsum(counts)]), rows[order], len(self.indptr) - 1)

    def times(self, other: CSR) -> CSR:
        """Gustavson: row i of the product joins the rows of ``other`` that row i names, each column once."""
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        width = np.diff(other.indptr)[self.indices]
        at = np.repeat(other.indptr[self.indices] - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(int(width.sum()))
        cells = np.sort(np.repeat(rows, width) * other.n_columns + other.indices[at], kind="stable")     # nearly in order as they come
        cells = cells[np.concatenate([[True], cells[1:] != cells[:-1]])] if len(cells) else cells
        counts = np.bincount(cells // other.n_columns, minlength=len(self.indptr) - 1) if len(cells) else np.zeros(len(self.indptr) - 1, np.int64)
        return CSR(np.concatenate([[0], np.cumsum(counts)]), cells % max(1, other.n_columns), other.n_columns)


class Tokenizers:
    """Both tokenizers of a worker process, with the bytes of their tokens and the units aligned so far."""

    _kept: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, path_a: str, path_b: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        # byte-level: printable Latin-1 stands for itself, the other bytes for the code points from 256 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        odd = [x for x in range(256) if x not in plain]
        byte_of = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(odd)}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # units are exact where no piece goes on over a blank
        self.by_units = not any("▁" in p.lstrip("▁") for p in pieces)
        self.units = Units(self)

    @classmethod
    def get(cls, path_a: str, path_b: str) -> Tokenizers:
        if (path_a, path_b) not in cls._kept:
            cls._kept[path_a, path_b] = cls(path_a, path_b)
        return cls._kept[path_a, path_b]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each text (it begins with a blank) by A and B; None where the bytes of either are not the text."""
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for t, x, y in zip(texts, a, b, strict=True):
            raw = t.encode()
            same = b"".join(map(self.bytes_a.__getitem__, x)) == raw == b"".join(map(self.bytes_b.__getitem__, y))
            out.append((x, y) if same else None)
        return out

    def encode_units(self, units: list[str]) -> list[tuple[list[str], list[int] | None, list[int] | None]]:
        """(units, ids of A, ids of B) in runs; ids are None for a single unit whose bytes are not kept.

        Units that end with a non-space are encoded side by side, as in a text.
        """
        runs, alone, size = [[]], [], 0
        for u in units:
            if not self.by_units or "▁" in u or u[-1].isspace():
                alone.append(u)
                continue
            if size > RUN_CHARS:
                runs.append([])
                size = 0
            runs[-1].append(u)
            size += len(u)
        out = []
        for run, ids in zip(runs, self.encode(["".join(r) for r in runs]), strict=True) if runs[0] else ():
            if ids is None:
                alone += run
            else:
                out.append((run, *ids))
        return out + [([u], *(ids or (None, None))) for u, ids in zip(alone, self.encode(alone), strict=True)]


def _unit_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin in texts that each begin with a blank, and the end of all.

    A unit begins where a text does, and at a blank behind a non-space unless only blanks follow in its text.
    """
    blank = data == 0x20
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    at = np.flatnonzero(first)
    at = at[at >= 3]
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    space = (one < 0x20) | (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    space |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    space |= (three == 0xE2) & (two == 0x81) & (one == 0x9F) | (three == 0xE3) & (two == 0x80) & (one == 0x80)
    at = at[~space]
    solid = np.flatnonzero(~blank)
    behind = np.append(solid, len(data))[np.searchsorted(solid, at)]
    row_end = offsets[np.searchsorted(offsets, at, "right")]
    starts = offsets[:-1][np.diff(offsets) > 0]
    return np.unique(np.concatenate([starts, at[behind < row_end], offsets[-1:]]))


class Units:
    """Units by number: whether their bytes are kept, numbers of tokens and groups, groups as text, and the pairs of their links.

    ``pairs`` has an entry for each overlap link (A id * 2**32 + B id), unit by unit up to ``pair_ends``.
    """

    COUNTS = ("n_a", "n_b", "n_groups", "n_shared")

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        # an id with what follows it: the next id of its side, the other side, the next group, or nothing
        a, b = (list(map(str, range(len(x)))) for x in (tokenizers.bytes_a, tokenizers.bytes_b))
        self.spelled = [x + end for ids, ends in ((a, ",|"), (b, ",;")) for end in ends for x in ids] + b
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (tokenizers.bytes_a, tokenizers.bytes_b))
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.good = np.zeros(0, bool)
        self.counts = {n: np.zeros(0, np.int64) for n in self.COUNTS}
        self.pair_ends = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.size = 0

    def add(self, units: list[str]) -> None:
        """Encode and align units that are not known yet."""
        found = self.tokenizers.encode_units(units)
        order = [u for run, _, _ in found for u in run]
        good = np.array([a is not None for run, a, _ in found for _ in run])
        ids_a, ids_b = (np.array([i for f in found for i in f[side] or ()], np.int64) for side in (1, 2))
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends = np.cumsum(np.where(good, [len(u.encode()) for u in order], 0))
        links = CSR.of_spans(ends_a).times(CSR.of_spans(ends_b).transposed())
        pairs = np.repeat(ids_a, np.diff(links.indptr)) << 32 | ids_b[links.indices]
        cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        shared = CSR.of_labels(group_a, len(cuts)).times(CSR.of_labels(group_b, len(cuts)).transposed())
        at_a, at_b, at_group = (np.concatenate([[0], np.searchsorted(x, ends, "right")]) for x in (ends_a, ends_b, cuts))
        self._spell(ids_a, ids_b, ends_a, ends_b, cuts, group_a, group_b, ends, at_a + at_b)
        for u in order:
            self.number[u] = len(self.number)
        self.size += int(ends[-1]) + 8 * len(pairs)
        self.good = np.concatenate([self.good, good])
        for name, new in zip(self.COUNTS, (np.diff(at_a), np.diff(at_b), np.diff(at_group), np.diff(shared.indptr[at_a])), strict=True):
            self.counts[name] = np.concatenate([self.counts[name], new])
        self.pair_ends = np.concatenate([self.pair_ends, self.pair_ends[-1] + links.indptr[at_a[1:]]])
        self.pairs = np.concatenate([self.pairs, pairs])

    def _spell(self, ids_a, ids_b, ends_a, ends_b, cuts, group_a, group_b, ends, at) -> None:
        """Append the groups of each unit as text: every id with what follows it, in the order of groups, A before B."""
        na, nb = len(self.tokenizers.bytes_a), len(self.tokenizers.bytes_b)
        last_a, last_b = np.isin(ends_a, cuts, assume_unique=True), np.isin(ends_b, cuts, assume_unique=True)
        of_unit = np.isin(ends_b, ends)
        codes = np.concatenate([ids_a + na * last_a, 2 * na + ids_b + nb * last_b + nb * of_unit])
        place = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        parts = list(map(self.spelled.__getitem__, codes[place].tolist()))
        bounds = at.tolist()
        self.groups += ["".join(parts[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    def of(self, units: list[str]) -> np.ndarray:
        """Numbers of distinct units."""
        new = [u for u in units if u not in self.number]
        if new and (len(self.number) > KEPT_UNITS or self.size > KEPT_BYTES):
            self.clear()
            new = units
        if new:
            self.add(new)
        return np.array(list(map(self.number.__getitem__, units)), np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of slices that have about ``most`` bytes of text together."""
    held, size = [], 0
    for part in (p for b in batches for p in slices(b, text)):
        more = part.column(part.schema.get_field_index(text)).nbytes
        if held and size + more > most:
            yield held
            held, size = [], 0
        held.append(part)
        size += more
    if held:
        yield held


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each size, one list after the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum())) if len(sizes) else np.zeros(0, np.int64)


def _figures(tokenizers: Tokenizers, texts: pa.Array) -> tuple[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(columns of ``FIGURES``, distinct pairs, and row, place among these and number of links of each text's distinct pairs)."""
    units, n = tokenizers.units, len(texts)
    full = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    data, offsets = utf8(full)
    bounds = _unit_bounds(data, offsets) if tokenizers.by_units else np.unique(offsets)
    count = max(0, len(bounds) - 1)
    every = pa.LargeStringArray.from_buffers(count, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    known = every.dictionary_encode()
    number = units.of(known.dictionary.to_pylist())
    unit, row = known.indices.to_numpy(zero_copy_only=False), np.searchsorted(offsets, bounds[:count], "right") - 1
    good = np.bincount(row, ~units.good[number][unit], minlength=n) == 0
    unit, row = unit[good[row]], row[good[row]]
    sums = {c: np.bincount(row, units.counts[c][number][unit], minlength=n).astype(np.int64) for c in units.COUNTS}
    # the pairs of the distinct units, then of every unit
    size = np.diff(units.pair_ends)[number]
    distinct, place = np.unique(units.pairs[_expanded(units.pair_ends[number], size)], return_inverse=True)
    at = np.concatenate([[0], np.cumsum(size)])[:-1]
    links = place[_expanded(at[unit], size[unit])]
    cells, times = np.unique(np.repeat(row, size[unit]) * max(1, len(distinct)) + links, return_counts=True)
    listed = pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), pa.array([units.groups[i] for i in number.tolist()], pa.large_string()).take(pa.array(unit)))
    spelled, ends = utf8(pc.binary_join(listed, pa.scalar(";", pa.large_string())))
    raw = memoryview(np.ascontiguousarray(spelled))
    digest = [hashlib.sha256(raw[i:j]).hexdigest() if j > i else "" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    n_links = np.bincount(row, size[unit], minlength=n).astype(np.int64)
    columns = [pa.array(x) for x in (sums["n_a"], sums["n_b"], sums["n_groups"], n_links, sums["n_shared"])] + [pa.array(digest, pa.string())]
    return columns, distinct, cells // max(1, len(distinct)), cells % max(1, len(distinct)), times


FIGURES = [("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("n_links", LongType()), ("n_shared", LongType()),
           ("groups_sha256", StringType())]


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of two kinds: of a document (``keep``, figures, and its distinct pairs as places in its chunk's table with the
    number of links of each), and of a chunk's table (pairs with the number of the chunk's documents that hold them)."""
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kept = [StructField(c, rows.schema[c].dataType) for c in keep]
    result = StructType([*kept, *[StructField(n, t) for n, t in FIGURES], StructField("__chunk", LongType()), StructField("__place", BinaryType()),
                         StructField("__times", BinaryType()), StructField("__pairs", BinaryType()), StructField("__docs", BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(result)
        tokenizers = Tokenizers.get(path_a, path_b)
        base = TaskContext.get().partitionId() * CHUNKS_OF_A_TASK
        for k, parts in enumerate(_gathered(batches, "__text", chunk_bytes)):
            chunk = pa.Table.from_batches(parts).combine_chunks()
            m = chunk.num_rows
            figures, pairs, row, place, times = _figures(tokenizers, chunk["__text"].combine_chunks())
            ends = np.searchsorted(row, np.arange(m + 1)).tolist()
            split = [pa.array([x[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary()) for x in (place.astype("<i4"), times.astype("<i4"))]
            number, none = pa.array(np.full(m, base + k)), pa.nulls(m, pa.binary())
            yield from pa.Table.from_arrays([*(chunk[c].combine_chunks() for c in keep), *figures, number, *split, none, none], schema=schema).to_batches()
            docs = np.bincount(place, minlength=len(pairs))
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, f.type) for f in list(schema)[: len(keep) + len(FIGURES)]), number[:1], none[:1], none[:1],
                pa.array([pairs.astype("<i8").tobytes()], pa.binary()), pa.array([docs.astype("<i4").tobytes()], pa.binary())], schema=schema)

    return rows.mapInArrow(run, result)


def pair_counts(found: DataFrame) -> DataFrame:
    """chunk, place, pair, count (documents of the corpus that hold it linked) and best (1 where no pair of its A id has more)."""
    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["__pairs"], "<i8")
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(pairs), row["__chunk"])), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs),
                        pa.array(np.frombuffer(row["__docs"], "<i4").astype(np.int64))], ["chunk", "place", "pair", "docs"])

    tables = found.where("__pairs is not null").select("__chunk", "__pairs", "__docs").mapInArrow(unpack, "chunk long, place int, pair long, docs long")
    # chunks add up in the tasks first; then each pair stands once, and an A id has at most as many as B has ids
    counts = tables.groupBy("pair").agg(F.sum("docs").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    counts = counts.withColumn("best", (F.col("count") == most).cast("int"))
    return tables.select("chunk", "place", "pair").join(counts, "pair")


def links(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """``keep``, the figures of each document and, over its links, n_best (whose count is the highest of their A id) and count_sum."""
    found = stored(aligned(docs, path_a, path_b, text, keep, **options), "alignment")
    counts = pair_counts(found)
    names = [n for n, _ in FIGURES]
    rows = found.where("__pairs is null").select(*keep, *names, "__chunk", "__place", "__times")
    result = StructType([*[StructField(c, rows.schema[c].dataType) for c in [*keep, *names]], StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def run(left, right):
        size = right.num_rows
        place = right["place"].to_numpy()
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        count[place], best[place] = right["count"].to_numpy(), right["best"].to_numpy()
        sums = []
        for at, times in zip(left["__place"].to_pylist(), left["__times"].to_pylist(), strict=True):
            at, times = np.frombuffer(at, "<i4"), np.frombuffer(times, "<i4")
            sums.append((int(best[at] @ times), int(count[at] @ times)))
        best_sums, count_sums = zip(*sums, strict=True) if sums else ((), ())
        return pa.table([*(left[c] for c in [*keep, *names]), pa.array(best_sums, pa.int64()), pa.array(count_sums, pa.int64())], [f.name for f in result])

    counts = counts.select(F.col("chunk").alias("__chunk"), "place", "count", "best")
    return rows.groupBy("__chunk").cogroup(counts.groupBy("__chunk")).applyInArrow(run, result)


def digests(docs: DataFrame, path_a: str, path_b: str, **options) -> DataFrame:
    """The contract's row of each document, and n_shared, its links of occurrences that share a group."""
    return links(docs, path_a, path_b, **options).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")
