"""Suffix dedup: remove every byte of a repeated 100-byte string, by a distributed merge sort of suffixes.

Sorting every suffix of a corpus would move about a hundred bytes per byte of
text, so only suffixes at content-chosen places are sorted, and none is lost:

* An *anchor* is a position whose ``GRAM``-byte string hashes lowest within some
  100-byte window.  The choice depends on the window's bytes only, so two equal
  windows hold the same anchor at the same offset, and every repeated window is
  found at an anchor that its copy has too.
* Anchors whose gram occurs once are done.  Hashes meet in packed buckets; what
  repeats within a task is known there and sends one representative, so a hot
  gram costs one row per task.
* The others become suffixes: 100 bytes from the anchor on, then the bytes before
  it, backwards (no more than any window around it needs).  Each task sorts its
  share, drops equal ones (all but the first are repeats), cuts the run at the
  sampled split points and sends it front coded: the length of the prefix shared
  with the line before, and the rest.
* A range of suffixes merges its runs by a loser tree that keeps the common
  prefix with the last winner; it compares bytes only past a known prefix.  The
  merged lengths are the LCP array.  A window that starts ``a`` bytes before the
  anchor is repeated where suffixes share ``100 - a`` bytes forwards (an LCP
  interval) and ``a`` bytes backwards (an interval of the backward order): all
  but the earliest of such a group are covered.

Results: a null text counts as empty; texts under 100 bytes keep everything;
a null id counts as the largest; rows of equal id and different text rank
equal (neither is earlier), equal rows get equal results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BASE_INVERSE, MIX2, U, bounded_batches, mix, powers, slices, utf8

WINDOW = 100
GRAM = 40
BEFORE = WINDOW - GRAM                # bytes before an anchor that a window around it can have
KEY = WINDOW + BEFORE
NO_ID = (1 << 63) - 1
NEVER = U(0xFFFFFFFFFFFFFFFF)
FLUSH_ANCHORS = 1 << 19
FLUSH_SUFFIXES = 1 << 16
BUCKET_TEXT = 24 << 20                # text bytes per bucket of anchors and per range of suffixes
SAMPLE_DOCS = 2000
SAMPLE_KEYS = 200_000


# ------------------------------------------------------------------ anchors
def _spread(x: np.ndarray, width: int, best) -> np.ndarray:
    """out[i] = best of x[i : i + width], by doubling; the last ``width - 1`` entries see what is left."""
    have, size = x, 1
    while size * 2 <= width:
        out = have.copy()
        best(have[:-size], have[size:], out=out[:-size])
        have, size = out, size * 2
    if size < width:
        step = width - size
        out = have.copy()
        best(have[:-step], have[step:], out=out[:-step])
        have = out
    return have


def anchors(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors of the rows in ``data``; no gram or window crosses rows."""
    n = len(data)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, U)
    sums = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, n), out=sums[1:])
    h = np.full(n, NEVER, U)
    h[: n - gram + 1] = mix((sums[gram:] - sums[:-gram]) * powers(BASE_INVERSE, n)[: n - gram + 1])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        h[(a if b - a < window else b - gram + 1): b] = NEVER
    width = window - gram + 1
    least = _spread(h, width, np.minimum)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        least[(a if b - a < window else b - window + 1): b] = U(0)
    # a position is chosen when it is the least of a window: when the largest of its windows' minima is its own hash
    most = _spread(least[::-1], width, np.maximum)[::-1]
    at = np.flatnonzero((h == most) & (h != NEVER))
    return at, h[at]


def _planes(x: np.ndarray, kind: str) -> bytes:
    """Numbers as byte planes: the high bytes, mostly zero, then compress to nothing in the shuffle."""
    wide = np.ascontiguousarray(x.astype(kind))
    return wide.view(np.uint8).reshape(len(wide), -1).T.tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _stack(frame: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.concatenate([_from_planes(x, kind) for x in frame[column].to_pylist()] or [np.zeros(0, kind)])


# one schema, and one shuffle, for both outputs of the anchor scan: bucket >= 0 is a packed bucket, others hold known repeats
ANCHORS = "bucket int, hashes binary, known binary, docs binary, copies binary, at binary"


def _anchor_rows(rows: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def flush():
            hashes, docs, copies, at = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((at, copies, docs, hashes))
            hashes, docs, copies, at = hashes[order], docs[order], copies[order], at[order]
            first = np.ones(len(hashes), bool)
            first[1:] = hashes[1:] != hashes[:-1]
            many = np.diff(np.append(np.flatnonzero(first), len(hashes)))
            repeated = np.repeat(many > 1, many)
            mixed = mix(hashes + MIX2)                # minima are small numbers: mix them again
            bucket = (mixed % U(n_buckets)).astype(np.int32)
            rows = []
            send = np.flatnonzero(first)
            send = send[np.argsort(bucket[send], kind="stable")]
            cuts = np.searchsorted(bucket[send], np.arange(n_buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                some = send[cuts[b]: cuts[b + 1]]
                rows.append((int(b), _planes(mixed[some] >> U(32), "<u4"), repeated[some].astype(np.uint8).tobytes(),
                             _planes(docs[some], "<i8"), _planes(copies[some], "<i8"), _planes(at[some], "<u4")))
            for some in np.array_split(np.flatnonzero(repeated), max(1, int(repeated.sum()) // 16384)):
                if len(some):
                    rows.append((-1 - int(mixed[some[0]] % U(n_buckets)), b"", b"", _planes(docs[some], "<i8"), _planes(copies[some], "<i8"), _planes(at[some], "<u4")))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                              ["bucket", "hashes", "known", "docs", "copies", "at"])

        for batch in (part for b in batches for part in slices(b, "text")):
            data, offsets = utf8(batch.column("text"))
            at, h = anchors(data, offsets)
            row = np.searchsorted(offsets, at, "right") - 1
            held.append((h, batch.column("doc").to_numpy()[row], batch.column("copy").to_numpy()[row].astype(np.int64), at - offsets[row]))
            waiting += len(at)
            if waiting >= FLUSH_ANCHORS:
                yield flush()
                held, waiting = [], 0
        if waiting:
            yield flush()

    return rows.select("doc", "copy", "text").mapInArrow(run, ANCHORS)


PLACES = "doc long, copy long, at int"


def _places(docs, copies, at) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(copies.astype(np.int64), pa.int64()), pa.array(at.astype(np.int32), pa.int32())],
                                      ["doc", "copy", "at"])


def _meet(frame: pa.Table) -> pa.Table:
    """A bucket's anchors whose gram hash came from two tasks, or twice from one; known ones were sent already.

    A negative bucket holds known ones: they only change their form.
    """
    if frame["bucket"][0].as_py() < 0:
        return pa.Table.from_batches([_places(_stack(frame, "docs", "<i8"), _stack(frame, "copies", "<i8"), _stack(frame, "at", "<u4"))])
    hashes = _stack(frame, "hashes", "<u4")
    known = np.frombuffer(b"".join(frame["known"].to_pylist()), np.uint8)
    _, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    keep = (counts[which] > 1) & (known == 0)
    # a known representative alone tells nothing new; with any other, those others are repeats
    return pa.Table.from_batches([_places(_stack(frame, "docs", "<i8")[keep], _stack(frame, "copies", "<i8")[keep], _stack(frame, "at", "<u4")[keep])])


# ------------------------------------------------------------------ suffixes
def suffix(text: bytes, at: int) -> tuple[bytes, int]:
    """(100 bytes from the anchor on, then the bytes before it backwards; length of the first part)."""
    right = text[at: at + WINDOW]
    return right + text[max(0, at - BEFORE): at][::-1], len(right)


def cover(n_right, n_left):
    """(least, largest) number of bytes by which a window around the anchor can start before it."""
    return np.maximum(0, WINDOW - np.asarray(n_right)), np.minimum(BEFORE, np.asarray(n_left))


COVERS = "doc long, copy long, from_ int, till int"
# one schema, and one shuffle, for both outputs of the suffix scan: part >= 0 is a piece of a run, others hold covers known already
RUNS = "part int, lcps binary, lengths binary, rights binary, tails binary, docs binary, copies binary, at binary, from_ binary, till binary"


def _matrix(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(k.ljust(KEY, b"\0") for k in keys), np.uint8).reshape(-1, KEY)


def shared_prefixes(keys: list[bytes]) -> np.ndarray:
    """Length of each key's common prefix with the key before it (0 for the first)."""
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        m, lengths = _matrix(keys), np.fromiter(map(len, keys), np.int64, len(keys))
        differ = m[1:] != m[:-1]
        first = np.where(differ.any(1), differ.argmax(1), KEY)
        out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def _suffix_runs(splits: list[bytes]):
    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, int], list[tuple[int, int, int]]] = {}
        waiting = 0
        pack = zstandard.ZstdCompressor(level=3)

        def flush():
            keys = sorted(held)
            rows, lines, places, covered = [], [], [], []
            for key in keys:
                where = sorted(set(held[key]))
                doc = where[0][0]
                least, most = cover(key[1], len(key[0]) - key[1])
                heads: set[tuple[int, int]] = set()
                for d, c, a in where:
                    if d == doc and (d, c) not in heads:      # the earliest, and rows of equal id
                        heads.add((d, c))
                        lines.append(key)
                        places.append((d, c, a))
                    elif most >= least:
                        covered.append((d, c, a - int(most), a - int(least) + WINDOW))
            prefixes = shared_prefixes([k for k, _ in lines])
            cuts = [0, *(bisect.bisect_left(lines, s, key=lambda x: x[0][:GRAM]) for s in splits), len(lines)]
            for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a == b:
                    continue
                lcps = prefixes[a:b].copy()
                lcps[0] = 0
                some = lines[a:b]
                where = np.array(places[a:b], np.int64).reshape(-1, 3)
                rows.append((part, lcps.astype(np.uint8).tobytes(), bytes(len(k) for k, _ in some), bytes(r for _, r in some),
                             pack.compress(b"".join(k[n:] for (k, _), n in zip(some, lcps.tolist(), strict=True))),
                             _planes(where[:, 0], "<i8"), _planes(where[:, 1], "<i8"), _planes(where[:, 2], "<u4"), b"", b""))
            for at in range(0, len(covered), 16384):
                some = np.array(covered[at: at + 16384], np.int64)
                rows.append((-1 - int(some[0, 0] + some[0, 2]) % (len(splits) + 1), b"", b"", b"", b"", _planes(some[:, 0], "<i8"), _planes(some[:, 1], "<i8"), b"",
                             _planes(some[:, 2], "<u4"), _planes(some[:, 3], "<u4")))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                              ["part", "lcps", "lengths", "rights", "tails", "docs", "copies", "at", "from_", "till"])

        for batch in (part for b in batches for part in slices(b, "text")):
            for doc, copy, text, at in zip(*(batch.column(c).to_pylist() for c in ("doc", "copy", "text", "places")), strict=True):
                raw = text.encode()
                for a in set(at):
                    held.setdefault(suffix(raw, a), []).append((doc, copy, a))
                waiting += len(at)
                if waiting >= FLUSH_SUFFIXES:
                    yield flush()
                    held, waiting = {}, 0
        if waiting:
            yield flush()
    return run


def _read_run(row: dict) -> tuple[list[bytes], list[int], bytes, np.ndarray]:
    """(keys, LCPs, lengths of first parts, places) of one front-coded run."""
    keys, at, last, tails = [], 0, b"", zstandard.ZstdDecompressor().decompress(row["tails"])
    lcps = list(row["lcps"])
    for n, size in zip(lcps, row["lengths"], strict=True):
        last = last[:n] + tails[at: at + size - n]
        at += size - n
        keys.append(last)
    return keys, lcps, row["rights"], np.stack([_from_planes(row["docs"], "<i8"), _from_planes(row["copies"], "<i8"),
                                                _from_planes(row["at"], "<u4").astype(np.int64)], 1)


def past(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two keys that share ``known`` bytes."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, line, LCP with the line before) of all lines in ascending order, by a loser tree.

    Every loser keeps the length of the prefix it shares with the line that beat it; that line is the
    last winner whenever the loser is met again, so the longer shared prefix decides without a look at
    the bytes, and equal ones are compared past it.
    """
    k = 1
    while k < len(runs):
        k *= 2
    at = [0] * k
    lines = [r[0] for r in runs] + [[]] * (k - len(runs))
    known = [0] * k                                     # each run's line against the last winner

    def beats(x: int, y: int) -> tuple[bool, int]:
        """Whether run x's line comes first, and what the two share; ``known`` holds both against the same line."""
        if at[x] >= len(lines[x]) or at[y] >= len(lines[y]):
            return at[x] < len(lines[x]), 0
        if known[x] != known[y]:
            return known[x] > known[y], min(known[x], known[y])
        a, b = lines[x][at[x]], lines[y][at[y]]
        n = past(a, b, known[x])
        return a[n:n + 1] <= b[n:n + 1], n

    losers = [0] * k
    level = list(range(k))
    size = k
    while size > 1:                                     # first round: all against the empty line
        after = []
        for i in range(0, size, 2):
            x, y = level[i], level[i + 1]
            first, n = beats(x, y)
            win, lose = (x, y) if first else (y, x)
            losers[size // 2 + i // 2] = lose
            if at[lose] < len(lines[lose]):
                known[lose] = n
            after.append(win)
        level, size = after, size // 2
    win = level[0]
    while at[win] < len(lines[win]):
        yield win, at[win], known[win]
        at[win] += 1
        if at[win] < len(lines[win]):
            known[win] = runs[win][1][at[win]]          # its run's own LCP: the line before it was the winner
        node = (win + k) // 2
        while node:
            lose = losers[node]
            first, n = beats(win, lose)
            if first:
                if at[lose] < len(lines[lose]):
                    known[lose] = n
            else:
                if at[win] < len(lines[win]):
                    known[win] = n
                losers[node], win = win, lose
            node //= 2


def repeats(keys: list[bytes], lcps: np.ndarray, rights: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, from, till): the bytes of each line's document that repeated windows around its anchor cover.

    Lines are in ascending order; ``lcps`` is their LCP array.
    """
    n = len(keys)
    lengths = np.fromiter(map(len, keys), np.int64, n)
    lefts = lengths - rights
    alone = np.ones(n, bool)                            # lines that share no gram with a neighbour
    near = lcps[1:] >= GRAM
    alone[1:] &= ~near
    alone[:-1] &= ~near
    use = np.flatnonzero(~alone)
    if not len(use):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lcp = np.zeros(len(use), np.int64)                  # a left-out line stands between groups only
    lcp[1:] = np.where(use[1:] == use[:-1] + 1, lcps[use[1:]], 0)
    rights, lefts, places = rights[use], lefts[use], places[use]
    back = np.zeros((len(use), BEFORE), np.uint8)
    for i, j in enumerate(use.tolist()):
        left = keys[j][rights[i]:]
        back[i, : len(left)] = np.frombuffer(left, np.uint8)
    words = np.zeros((len(use), -(-BEFORE // 8) * 8), np.uint8)
    words[:, :BEFORE] = back
    words = words.view(">u8").astype(U)
    order = np.lexsort(words.T[::-1])                   # the backward order
    differ = back[order[1:]] != back[order[:-1]]
    left_lcp = np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), BEFORE)])
    earliest = np.lexsort((places[:, 2], places[:, 1], places[:, 0]))
    rank = np.empty(len(use), np.int64)
    rank[earliest] = np.arange(len(use))
    least, most = np.full(len(use), WINDOW + 1), np.full(len(use), -1)
    seg, left = np.empty(len(use), np.int64), np.empty(len(use), np.int64)
    for a in range(BEFORE + 1):
        ok = (rights >= WINDOW - a) & (lefts >= a)
        np.cumsum(lcp < WINDOW - a, out=seg)
        left[order] = np.cumsum(left_lcp < a)
        some = np.flatnonzero(ok)
        if len(some) < 2:
            continue
        group = (seg[some] << 32) | left[some]
        by = np.lexsort((rank[some], group))
        some, group = some[by], group[by]
        new = np.ones(len(some), bool)
        new[1:] = group[1:] != group[:-1]
        doc, copy, at = places[some, 0], places[some, 1], places[some, 2]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        # earlier: a smaller id, or the same row at a smaller start (the first of a row's run within the group)
        fresh = new.copy()
        fresh[1:] |= (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])
        own = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        repeated = some[(doc != doc[head]) | (at > at[own])]
        least[repeated] = np.minimum(least[repeated], a)
        most[repeated] = np.maximum(most[repeated], a)
    hit = np.flatnonzero(most >= 0)
    # any two windows around one anchor overlap, so their union is one interval
    return use[hit], places[hit, 2] - most[hit], places[hit, 2] - least[hit] + WINDOW


def _merge_range(frame: pa.Table) -> pa.Table:
    """A range's covers by merging its runs; a negative part holds known covers, which only change their form."""
    if frame["part"][0].as_py() < 0:
        return pa.Table.from_batches([_covers(_stack(frame, "docs", "<i8"), _stack(frame, "copies", "<i8"), _stack(frame, "from_", "<u4"), _stack(frame, "till", "<u4"))])
    runs = [_read_run(r) for r in frame.to_pylist()]
    keys, lcps, rights, places = [], [], [], []
    for r, i, n in merge([(k, n) for k, n, *_ in runs]):
        keys.append(runs[r][0][i])
        lcps.append(n)
        rights.append(runs[r][2][i])
        places.append(runs[r][3][i])
    places = np.array(places, np.int64).reshape(-1, 3)
    line, start, till = repeats(keys, np.array(lcps, np.int64), np.array(rights, np.int64), places)
    return pa.Table.from_batches([_covers(places[line, 0], places[line, 1], start, till)])


def _covers(docs, copies, start, till) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(copies.astype(np.int64), pa.int64()),
                                       pa.array(start.astype(np.int32), pa.int32()), pa.array(till.astype(np.int32), pa.int32())], ["doc", "copy", "from_", "till"])


# ------------------------------------------------------------------ the operator
def split_points(rows: DataFrame, parts: int) -> list[bytes]:
    """Grams that cut the suffixes into about even ranges, from the anchors of a bounded sample of documents."""
    ids = rows.select("doc", "copy").orderBy(F.xxhash64("doc", "copy"), "doc", "copy").limit(SAMPLE_DOCS)

    def run(batches):
        for batch in (part for b in batches for part in slices(b, "text")):
            data, offsets = utf8(batch.column(0))
            at, h = anchors(data, offsets)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[a: a + GRAM] for a in at.tolist()], pa.binary()), pa.array(h.view(np.int64))], ["gram", "h"])

    # at most SAMPLE_DOCS ids are broadcast, and at most SAMPLE_KEYS grams reach the driver
    grams = (rows.join(F.broadcast(ids), ["doc", "copy"]).select("text").mapInArrow(run, "gram binary, h long")
             .orderBy(F.xxhash64("h")).limit(SAMPLE_KEYS).collect())
    grams = sorted(bytes(r["gram"]) for r in grams)
    return sorted({grams[i * len(grams) // parts] for i in range(1, parts)}) if grams else []


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``spans`` (array of from, till in bytes; may overlap) of every row."""
    spark = docs.sparkSession
    rows = bounded_batches(docs).select(F.col(key).alias("doc_id"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # rows of one id (or without one) are told apart by a 64-bit hash of their text, only where ids repeat
    repeated_ids = rows.groupBy("doc").count().where("count > 1").limit(1).count() > 0
    rows = rows.withColumn("copy", F.xxhash64("text") if repeated_ids else F.lit(0).cast("long"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_TEXT + 1)

    found = _anchor_rows(rows, parts)
    places = found.groupBy("bucket").applyInArrow(_meet, PLACES)
    by_doc = places.groupBy("doc", "copy").agg(F.collect_list("at").alias("places"))
    # both joins read the same columns, so the texts are shuffled once and the second join uses that shuffle again
    texts = rows.select("doc_id", "doc", "copy", "text")
    runs = texts.join(by_doc, ["doc", "copy"]).select("doc_id", "doc", "copy", "text", "places").mapInArrow(_suffix_runs(split_points(rows, parts)), RUNS)
    covers = runs.groupBy("part").applyInArrow(_merge_range, COVERS)
    spans = covers.groupBy("doc", "copy").agg(F.collect_list(F.struct("from_", "till")).alias("spans"))
    return texts.join(spans, ["doc", "copy"], "left").select("doc_id", "text", "spans")


def keep_rest(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (the remaining bytes) from ``repeated_spans``."""
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches):
        for batch in (part for b in batches for part in slices(b, "text")):
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, kept, at, removed, count, end = text.encode(), [], 0, 0, 0, -1
                for a, b in sorted((s["from_"], s["till"]) for s in spans or ()):
                    if a > end:                          # touching spans are one
                        count += 1
                        kept.append(raw[at:a])
                        removed += b - a
                        at = end = b
                    elif b > end:
                        removed += b - end
                        at = end = b
                kept.append(raw[at:])
                out.append((len(raw), removed, count, b"".join(kept)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)), pa.array([x[3] for x in out], pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The contract's row of each document."""
    return keep_rest(repeated_spans(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The same in DuckDB over all windows, as hexadecimal text.
SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS MATERIALIZED (SELECT r, k, s, hash(substr(x, 2 * s + 1, 200)) AS h FROM d, unnest(range(0, greatest(length(x) // 2 - 99, 0))) AS u(s)),
m AS (SELECT h, min(k) AS k FROM w GROUP BY h HAVING count(*) > 1),
o AS (SELECT r, h, min(s) AS s FROM w SEMI JOIN m USING (h) GROUP BY r, h),
p AS (SELECT w.r, w.s FROM w JOIN m ON m.h = w.h JOIN o ON o.h = w.h AND o.r = w.r WHERE w.k > m.k OR w.s > o.s),
g AS (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM p),
i AS (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s ROWS UNBOUNDED PRECEDING) AS n FROM g),
c AS (SELECT r, n, min(s) AS a, max(s) + 100 AS b FROM i GROUP BY r, n),
e AS (SELECT r, n, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY n), 0) AS z FROM c),
t AS (SELECT d.r, string_agg(substr(d.x, 2 * e.z + 1, 2 * (e.a - e.z)), '' ORDER BY e.n) || substr(any_value(d.x), 2 * max(e.b) + 1) AS kept,
             sum(e.b - e.a)::BIGINT AS n_removed, count(*) AS n_spans FROM d JOIN e ON e.r = d.r GROUP BY d.r)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""
