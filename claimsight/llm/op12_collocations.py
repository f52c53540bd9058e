"""Phrase collocations by relational (set-oriented) mining.

A text's ASCII letters are lowered; ``.,;:!?`` and line ends cut it into pieces,
blanks and tabs cut pieces into words.  The occurrence relation of length k has a
row (place, item) for every occurrence of a phrase of k words: places number the
words of a chunk in order and skip one between pieces, so that neighbours in a
piece, and only those, stand at adjacent places.  Relations are persisted sorted
by place, as two arrays for each chunk of about ``CHUNK_BYTES`` of text, with the
chunk's item table: what its items stand for and how often they occur, packed in one
row for each range of hashes.  For each length:

* group-count: the item tables are shuffled by range and summed by what the items
  stand for (a word of a lang, then the pair of a phrase's head and tail); a hot phrase
  is one entry for each chunk, never one for each occurrence;
* semi-join: each chunk gets back, packed in the same order, which of its items occur
  ``support`` times and their names, and its relation keeps the occurrences of those;
* merge-join: the kept relation meets itself at adjacent places, which gives the
  occurrences of the next length, whose phrases have only frequent parts; packed
  hashes are summed over all chunks first, to leave out pairs that cannot be frequent.

A frequent phrase is named by its range and its number there, so longer ones are pairs
of numbers; texts and counts are joined to the frequent phrases only.

A phrase cut after k words has l (count of its first part), r (count of the
rest) and the score floor(SCALE * a / (l + r)), by decimals of 38 digits; the
lowest-scoring cut counts, ties go to the smallest k.  A candidate is dropped
where a longer candidate that holds it has at least ``share`` percent of its count.

Results: null and empty texts have no words; a null lang counts as ``und``, also
together with rows that say so; a text is cut at piece ends where it is longer than
a chunk, one piece is never cut; rows that repeat are counted as often as they
stand there; ties go by count and then the phrase's UTF-8 bytes; an empty table, or
one without frequent phrases, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BASE, U, mix, stored, utf8, word_hashes

SUPPORT = 30
LONGEST = 4
TOP = 2_000
SHARE = 80
SCALE = 2_000_000
#: text bytes of a chunk: it bounds what a task holds, and how often a phrase is shuffled
CHUNK_BYTES = 8 << 20
#: occurrences of frequent items for each range of hashes: it bounds the pairs that are sifted together
PAIRS_EACH = 1 << 20
#: chunks' worth of words, and sifted ranges of pairs, whose item tables are counted together
CHUNKS_EACH, RANGES_EACH = 2, 4

# What ends a piece, and what parts the words of a piece.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

_ends = np.zeros(256, bool)
_ends[list(PIECE_ENDS)] = True
_blank = np.zeros(256, bool)
_blank[list(BLANKS)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32

#: a chunk's number is its task's times this and its own in the task; a name is a range times this and a number in it
CHUNKS_OF_A_TASK, NAMES_OF_A_RANGE = 1 << 14, 1 << 32

#: a chunk's relation in one row, then its item table (places and items null): for each range the entries of the items from ``item`` on
WORDS = "chunk long, places binary, items binary, range long, item long, counts binary, lang string, words binary, n long"
PAIRS = "chunk long, places binary, items binary, range long, item long, counts binary, heads binary, tails binary"
#: what a range's count says: to a chunk the (item) places of its frequent items and their numbers in the range, then the frequent items (places null)
ANSWERS = "chunk long, range long, places binary, items binary, name long, f long"


def _packed(numbers: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes by planes of bytes, compressed: small ones take little more than their low bytes."""
    planes = np.ascontiguousarray(numbers, f"<u{width}").view(np.uint8).reshape(-1, width).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64)


def _steps(numbers: np.ndarray, width: int = 4) -> bytes:
    """Ascending numbers, packed as steps."""
    return _packed(np.diff(numbers, prepend=0), width)


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    begin = np.flatnonzero(new)
    return list(zip(begin.tolist(), np.append(begin[1:], len(new)).tolist()))


def _table(chunk: int, places: np.ndarray | None, items: np.ndarray | None, runs: list[tuple[int, int]], ranges: np.ndarray, n: np.ndarray,
           names: list[str], meaning: list[pa.Array]) -> pa.Table:
    """A chunk's relation (one row, unless it is not needed) and its item table, a row for each run; places are stored as steps, and all packed."""
    m, first = len(runs), 0 if places is None else 1

    def column(one, rest, kind):
        return pa.concat_arrays([pa.array([one] * first, kind), rest if isinstance(rest, pa.Array) else pa.array(rest, kind)])

    return pa.table([
        pa.array(np.full(m + first, chunk, np.int64)),
        column(_steps(places) if first else None, pa.nulls(m, pa.binary()), pa.binary()), column(_packed(items) if first else None, pa.nulls(m, pa.binary()), pa.binary()),
        column(None, [int(ranges[i]) for i, _ in runs], pa.int64()), column(None, [i for i, _ in runs], pa.int64()),
        column(None, [_packed(n[i:j]) for i, j in runs], pa.binary()),
        *[column(None, x, x.type) for x in meaning]], names=["chunk", "places", "items", "range", "item", "counts", *names])


def _scaled(h: np.ndarray, ranges: int) -> np.ndarray:
    """The top 64 bits but 32 of hash * ranges, without passing 64 bits: the range and 32 bits of the place in it."""
    return (h >> U(32)) * U(ranges) + (((h & U(0xFFFFFFFF)) * U(ranges)) >> U(32))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(place, row, word) of every word of a column of texts, in order."""
    data, offsets = utf8(texts)
    end = _ends[data]
    word = ~(end | _blank[data])
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[inner] |= word[inner]
    starts = np.flatnonzero(begins)
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] |= word[last]
    stops = np.flatnonzero(closes) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    # a piece ends at each mark and at each row's end
    marks = np.cumsum(end)
    piece = marks[starts] + rows if len(starts) else np.zeros(0, np.int64)
    places = np.arange(len(starts), dtype=np.int64)
    if len(starts):
        places += np.cumsum(np.diff(piece, prepend=piece[0]) != 0)
    kept = _lower[data[word]]
    ends = np.cumsum(stops - starts)
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return places, rows, pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(kept))


def _first_relation(chunk: int, texts: pa.Array, langs: pa.Array, ranges: int) -> pa.Table:
    """The relation of single words, with its item table: a row for each range and lang, whose words ascend."""
    places, rows, words = _words(texts)
    codes = words.dictionary_encode()
    lang = langs.dictionary_encode()
    n_langs = max(1, len(lang.dictionary))
    both = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_langs + lang.indices.to_numpy(zero_copy_only=False)[rows]
    known, items, n = np.unique(both, return_inverse=True, return_counts=True)
    word, of = known // n_langs, known % n_langs
    data, offsets = utf8(codes.dictionary)
    at = (_scaled(word_hashes(data, offsets[:-1], offsets[1:], lower=False), ranges) >> U(32)).astype(np.int64)[word]
    order = np.lexsort((_ranks(codes.dictionary)[word], of, at))
    item = np.empty(len(order), np.int64)
    item[order] = np.arange(len(order))
    word, of, at, n = word[order], of[order], at[order], n[order]
    # words have no tabs: each is ended by one
    data, offsets = utf8(codes.dictionary.take(pa.array(word)))
    ended = np.full(len(data) + len(word), 0x09, np.uint8)
    ended[np.arange(len(data)) + np.repeat(np.arange(len(word)), np.diff(offsets))] = data
    runs, bounds = _runs(at, of), offsets + np.arange(len(offsets))
    return _table(chunk, places, item[items], runs, at, n, ["lang", "words", "n"], [
        lang.dictionary.take(pa.array([int(of[i]) for i, _ in runs], pa.int64())),
        pa.array([zstandard.compress(ended[bounds[i]:bounds[j]].tobytes(), 3) for i, j in runs], pa.binary()),
        pa.array([int(n[i:j].sum()) for i, j in runs], pa.int64())])


def _ranks(words: pa.Array) -> np.ndarray:
    """Place of each of the (distinct) words in their order."""
    rank = np.empty(len(words), np.int64)
    rank[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
    return rank


def _cut_long(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``most`` bytes; a longer text is cut behind the piece ends it has."""
    text, lang = batch.column(0), batch.column(1)
    sizes = np.diff(utf8(text)[1])
    at = 0
    while at < batch.num_rows:
        total = np.cumsum(sizes[at:])
        end = at + max(1, int(np.searchsorted(total, most, "right")))
        if sizes[at] <= most:
            yield batch.slice(at, end - at)
            at = end
            continue
        data, name = np.frombuffer(text[at].as_py().encode(), np.uint8), lang.slice(at, 1)
        cuts, begin = np.flatnonzero(_ends[data]) + 1, 0
        while begin < len(data):
            inside = int(np.searchsorted(cuts, begin + most, "right")) - 1
            stop = int(cuts[inside]) if inside >= 0 and cuts[inside] > begin else int(next(iter(cuts[inside + 1: inside + 2]), len(data)))
            yield pa.RecordBatch.from_arrays([pa.array([data[begin:stop].tobytes().decode()], pa.string()), name], schema=batch.schema)
            begin = stop
        at += 1


def _gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches of about ``most`` bytes of text together."""
    held, size = [], 0
    for part in (p for b in batches for p in _cut_long(b, most)):
        more = int(utf8(part.column(0))[1][-1])
        if held and size + more > most:
            yield held
            held, size = [], 0
        held.append(part)
        size += more
    if held:
        yield held


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The relation of single words of each chunk, with its item table."""
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-total // (CHUNKS_EACH * chunk_bytes)))

    def run(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() * CHUNKS_OF_A_TASK
        for k, parts in enumerate(_gathered(batches, chunk_bytes)):
            both = pa.Table.from_batches(parts).combine_chunks()
            yield from _first_relation(base + k, both["text"].combine_chunks(), both["lang"].combine_chunks(), ranges).to_batches()

    return rows.where("length(text) > 0").mapInArrow(run, WORDS)


def _pairs(relation: pa.Table, answers: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's frequent items merge-joined at adjacent places: its number, places, the pair at each, then head, tail and count of each pair."""
    first = relation.slice(0, 1).to_pylist()[0]
    places, items = np.cumsum(_unpacked(first["places"])), _unpacked(first["items"])
    # semi-join: items are renumbered by the answers, which are about the frequent ones
    frequent = np.concatenate([np.cumsum(_unpacked(x)) for x in answers["places"].to_pylist()])
    name = np.concatenate([r * NAMES_OF_A_RANGE + np.cumsum(_unpacked(x)) for r, x in zip(answers["range"].to_pylist(), answers["items"].to_pylist())])
    number = np.full(int(items.max()) + 1 if len(items) else 0, -1, np.int64)
    number[frequent] = np.arange(len(frequent))
    kept = number[items]
    places, kept = places[kept >= 0], kept[kept >= 0]
    # merge-join: both sides are sorted by place, so the next place, if it is there, is the next row
    next_to = np.flatnonzero(places[1:] == places[:-1] + 1)
    known, pair, n = np.unique(kept[next_to] * len(frequent) + kept[next_to + 1], return_inverse=True, return_counts=True)
    return first["chunk"], places[next_to], pair, name[known // len(frequent)], name[known % len(frequent)], n


def _hashed(head: np.ndarray, tail: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by hash, range of each in that order, 20 bits of its place in the range) of a chunk's pairs; both ascend."""
    h = mix(mix(head.astype(U)) + tail.astype(U) * BASE)
    order = np.argsort(h, kind="stable")
    scaled = _scaled(h[order], ranges)
    return order, scaled >> U(32), ((scaled & U(0xFFFFFFFF)) >> U(12)).astype(np.int64)


def _counts_of_ranges(relation: pa.Table, answers: pa.Table, ranges: int, support: int) -> pa.Table:
    """For each range of hashes the hashes of a chunk's pairs in it (as steps), with their counts (``support`` says enough)."""
    chunk, _, _, head, tail, n = _pairs(relation, answers)
    order, at, bits = _hashed(head, tail, ranges)
    n = np.minimum(n[order], support)
    present, begin = np.unique(at, return_index=True)
    end = np.append(begin[1:], len(at))
    steps = np.diff(bits, prepend=0)
    steps[begin] = bits[begin]
    return pa.table([
        pa.array(np.full(len(present), chunk, np.int64)), pa.array(present.astype(np.int64)),
        pa.array([_packed(steps[i:j]) for i, j in zip(begin, end)], pa.binary()),
        pa.array([_packed(n[i:j]) for i, j in zip(begin, end)], pa.binary())], names=["chunk", "range", "hashes", "counts"])


def _enough(counts: pa.Table, support: int) -> pa.Table:
    """For each chunk one bit for each pair of a range: whether all pairs of its hash together occur ``support`` times."""
    hashes = [np.cumsum(_unpacked(x.as_py())) for x in counts["hashes"]]
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([_unpacked(x.as_py()) for x in counts["counts"]]))
    flags = np.split((total >= support)[which], np.cumsum([len(x) for x in hashes])[:-1])
    return pa.table([counts["chunk"], counts["range"], pa.array([np.packbits(x).tobytes() for x in flags], pa.binary())], names=["chunk", "range", "enough"])


def _extended(relation: pa.Table, answers: pa.Table, ranges: int, last: bool) -> pa.Table:
    """A chunk's relation of the next length (not of the last) and its item table, without the pairs whose hash is not frequent."""
    chunk, places, pair, head, tail, n = _pairs(relation, answers)
    order, at, _ = _hashed(head, tail, ranges)
    bits = {x["range"]: x["enough"] for x in relation["bits"][0].as_py() or []}
    present, size = np.unique(at, return_counts=True)
    keep = np.zeros(len(n), bool)
    if len(n):
        keep[order] = np.concatenate([np.unpackbits(np.frombuffer(bits[int(r)], np.uint8), count=int(m)) for r, m in zip(present, size)]).astype(bool)
    whole = np.empty(len(n), np.int64)
    whole[order] = at.astype(np.int64) // RANGES_EACH
    kept = np.flatnonzero(keep)
    kept = kept[np.lexsort((tail[kept], head[kept], whole[kept]))]
    item = np.zeros(len(n), np.int64)
    item[kept] = np.arange(len(kept))
    there = keep[pair]
    whole, head, tail, runs = whole[kept], head[kept], tail[kept], _runs(whole[kept])
    return _table(chunk, None if last else places[there], None if last else item[pair[there]], runs, whole, n[kept], ["heads", "tails"], [
        pa.array([_steps(head[i:j], 8) for i, j in runs], pa.binary()), pa.array([_packed(tail[i:j], 8) for i, j in runs], pa.binary())])


def grown(relation: DataFrame, frequent: DataFrame, support: int, pairs_each: int = PAIRS_EACH, last: bool = False) -> DataFrame:
    """The relations of the next length with their item tables (``last``: these alone), chunk by chunk, from the last ones and their frequent items.

    Most pairs of frequent items are rare, and nearly each stands in one chunk only.
    Before they are counted by name, chunks exchange packed hashes and counts by range
    of hashes, and get back a bit for each of their pairs: pairs of a hash whose total
    is below ``support`` cannot be frequent and are left out.  What stays is counted
    exactly, so a clash of hashes only lets a rare pair through.
    """
    total = frequent.agg(F.sum("f")).first()[0] or 0
    ranges = max(1, -(-total // pairs_each))
    answers = frequent.where("places is not null").select("chunk", "range", "places", "items").groupBy("chunk")
    # dealt by chunk once: the counts and the join below read one exchange
    places = relation.where("places is not null").select("chunk", "places", "items").repartition("chunk")

    def count(left, right):
        out = _counts_of_ranges(left, right, ranges, support) if left.num_rows and right.num_rows else None
        return out if out is not None else pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]).empty_table()

    def enough(table):
        return _enough(table, support)

    def extend(left, right):
        if left.num_rows and right.num_rows:
            return _extended(left, right, ranges, last)
        return pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("items", pa.binary()), ("range", pa.int64()), ("item", pa.int64()), ("counts", pa.binary()),
                          ("heads", pa.binary()), ("tails", pa.binary())]).empty_table()

    counts = places.groupBy("chunk").cogroup(answers).applyInArrow(count, "chunk long, range long, hashes binary, counts binary")
    bits = counts.groupBy("range").applyInArrow(enough, "chunk long, range long, enough binary")
    sent = bits.groupBy("chunk").agg(F.collect_list(F.struct("range", "enough")).alias("bits"))
    both = places.join(sent, "chunk", "left").select(F.col("chunk").alias("chunk"), "places", "items", "bits")
    return both.groupBy("chunk").cogroup(answers).applyInArrow(extend, PAIRS)


def extended(relation: DataFrame, frequent: DataFrame, support: int, pairs_each: int = PAIRS_EACH) -> DataFrame:
    """name, head, tail and n (in all chunks) of the frequent items of the next length; places (null) as in a relation."""
    pairs = counted(grown(relation, frequent, support, pairs_each, True), ("head", "tail"), support)
    return pairs.where("f is not null").select("places", "name", "head", "tail", F.col("f").alias("n"))


def _words_of(table: pa.Table) -> tuple[np.ndarray, list[pa.Array]]:
    """Which (lang, word) each entry of a range's item tables is, and these; they ascend as the entries of a row do."""
    data = np.frombuffer(b"".join(zstandard.decompress(x) for x in table["words"].to_pylist()), np.uint8)
    ends = np.flatnonzero(data == 0x09)
    bounds = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    codes = pa.StringArray.from_buffers(len(ends), pa.py_buffer(bounds), pa.py_buffer(data[data != 0x09])).dictionary_encode()
    lang = table["lang"].combine_chunks().dictionary_encode()
    size = len(codes.dictionary)
    many = np.array([len(_unpacked(x)) for x in table["counts"].to_pylist()])
    key = np.repeat(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), many) * size + _ranks(codes.dictionary)[codes.indices.to_numpy(zero_copy_only=False)]
    known, which = np.unique(key, return_inverse=True)
    return which, [lang.dictionary.take(pa.array(known // size)), codes.dictionary.take(pc.array_sort_indices(codes.dictionary)).take(pa.array(known % size))]


def _pairs_of(table: pa.Table) -> tuple[np.ndarray, list[pa.Array]]:
    """As ``_words_of``, for (head, tail)."""
    head = np.concatenate([np.cumsum(_unpacked(x, 8)) for x in table["heads"].to_pylist()])
    tail = np.concatenate([_unpacked(x, 8) for x in table["tails"].to_pylist()])
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    new = np.ones(len(order), bool)
    new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return which, [pa.array(head[new]), pa.array(tail[new])]


def _counted(table: pa.Table, by: tuple[str, str], support: int) -> pa.Table:
    """The answers to the chunks of a range, and its frequent items."""
    which, meaning = _words_of(table) if by == ("lang", "word") else _pairs_of(table)
    counts = [_unpacked(x) for x in table["counts"].to_pylist()]
    f = np.zeros(len(meaning[0]), np.int64)
    np.add.at(f, which, np.concatenate(counts))
    often = f >= support
    number, base = np.cumsum(often) - 1, int(table["range"][0].as_py())
    out, begin = [], 0
    for chunk, item, n in zip(table["chunk"].to_pylist(), table["item"].to_pylist(), counts):
        own = which[begin:begin + len(n)]
        begin += len(n)
        there = np.flatnonzero(often[own])
        if len(there):
            out.append((chunk, _steps(item + there), _steps(number[own[there]])))
    m, k = len(out), int(often.sum())

    def column(answers, found, kind):
        return pa.concat_arrays([pa.nulls(m, kind) if answers is None else pa.array(answers, kind), pa.nulls(k, kind) if found is None else found])

    return pa.table([
        column([x[0] for x in out], None, pa.int64()), pa.array(np.full(m + k, base, np.int64)),
        column([x[1] for x in out], None, pa.binary()), column([x[2] for x in out], None, pa.binary()),
        column(None, pa.array(base * NAMES_OF_A_RANGE + np.arange(k)), pa.int64()), column(None, pa.array(f[often]), pa.int64()),
        *[column(None, x.filter(pa.array(often)), x.type) for x in meaning]], names=["chunk", "range", "places", "items", "name", "f", *by])


def counted(relation: DataFrame, by: tuple[str, str], support: int) -> DataFrame:
    """What the chunks need to know of the items that occur ``support`` times in all chunks (places and items), and these (name, f and what each stands for)."""
    def count(table):
        return _counted(table, by, support)

    kind = "string" if by == ("lang", "word") else "long"
    return relation.where("range is not null").drop("places", "items").groupBy("range").applyInArrow(count, f"{ANSWERS}, {by[0]} {kind}, {by[1]} {kind}")


def worded(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """name, lang, phrase, last (word), f, and the arrays l and r of all cuts, of the phrases ``pairs`` (name, head, tail, f) of the shorter ``parts``.

    A word that starts or ends many phrases makes its key large in these joins, which adaptive execution splits.
    """
    head = parts.select(F.col("name").alias("head"), "lang", "phrase", "l", F.col("f").alias("__head_f"))
    tail = parts.select(F.col("name").alias("tail"), "last", "r", F.col("f").alias("__tail_f"))
    both = pairs.join(head, "head").join(tail, "tail")
    return both.select("name", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
                       F.concat("l", F.array("__head_f")).alias("l"), F.concat(F.array("__tail_f"), "r").alias("r"))


def score_of(a: Column, part: Column, rest: Column) -> Column:
    """floor(SCALE * a / (part + rest)), exact: decimals of 38 digits."""
    wide = "decimal(19,0)"
    return F.call_function("div", a.cast(wide) * F.lit(SCALE).cast("decimal(7,0)"), part.cast(wide) + rest.cast(wide))


def best_cut(phrases: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score from the arrays l and r of the cuts."""
    cuts = F.transform(F.arrays_zip("l", "r"), lambda x, i: F.struct(
        score_of(F.col("a"), x["l"], x["r"]).alias("score"), i.alias("k"), x["l"].alias("l"), x["r"].alias("r")))
    return (phrases.withColumn("__cut", F.array_min(cuts))
            .select("lang", "phrase", "words", "a", *[F.col(f"__cut.{c}").alias(c) for c in ("l", "r", "score")]))


def not_inside(phrases: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates that no longer candidate with ``share`` percent of their count holds."""
    def spans_of(size: int) -> Column:
        words = F.split("phrase", " ", -1)
        return F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda i: F.array_join(F.slice(words, i, F.lit(size)), " "))

    spans = F.concat(spans_of(2), spans_of(3))
    longer = phrases.where("words > 2").select("lang", "words", "a", F.explode(
        F.filter(spans, lambda x: F.col("phrase") != x)).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("__longer"))
    exact = "decimal(22,0)"
    return phrases.join(most, ["lang", "phrase"], "left").where(
        F.col("__longer").isNull() | (F.col("__longer").cast(exact) * 100 < F.col("a").cast(exact) * share)).drop("__longer")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST, share: int = SHARE,
         chunk_bytes: int = CHUNK_BYTES, pairs_each: int = PAIRS_EACH) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a, l, r, score of every collocation; lang and n, its number of words).

    ``longest`` is at most 4.
    """
    relation, by = stored(occurrences(docs, text, lang, chunk_bytes), "collocation-1", "zstd"), ("lang", "word")
    totals = relation.where("range is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    none = F.array().cast("array<long>")
    candidates, phrases = None, None
    for words in range(1, longest + 1):
        frequent = stored(counted(relation, by, support), f"collocation-{words}-frequent", "zstd")
        level = frequent.where("f is not null")
        if words == 1:
            phrases = level.select("name", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("l"), none.alias("r"))
        else:
            phrases = stored(worded(level.select("name", "head", "tail", "f"), phrases), f"collocation-{words}-phrases", "zstd")
            level = phrases.select("lang", "phrase", F.lit(words).alias("words"), F.col("f").alias("a"), "l", "r")
            candidates = level if candidates is None else candidates.unionByName(level)
        if words < longest:
            relation, by = stored(grown(relation, frequent, support, pairs_each, words + 1 == longest), f"collocation-{words + 1}", "zstd"), ("head", "tail")
    # read twice: as candidates and as those that hold others
    candidates = stored(best_cut(candidates), "collocation-candidates", "zstd")
    return not_inside(candidates, share), totals


def digests(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The contract's rows: the first ``top`` collocations of each lang."""
    found, totals = mine(docs, **options)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # one row for each lang
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
o1 AS MATERIALIZED (SELECT lang, p, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM w),
o4 AS MATERIALIZED (SELECT lang, w1, w1 || ' ' || lead(w1) OVER s AS w2, w1 || ' ' || lead(w1) OVER s || ' ' || lead(w1, 2) OVER s AS w3,
      w1 || ' ' || lead(w1) OVER s || ' ' || lead(w1, 2) OVER s || ' ' || lead(w1, 3) OVER s AS w4 FROM o1 WINDOW s AS (PARTITION BY p ORDER BY i)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM (
      SELECT lang, 1 AS k, w1 AS phrase FROM o4 UNION ALL SELECT lang, 2, w2 FROM o4 UNION ALL SELECT lang, 3, w3 FROM o4 UNION ALL SELECT lang, 4, w4 FROM o4)
      WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= {SUPPORT}),
n AS (SELECT lang, count(*)::BIGINT AS n FROM o1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
cut AS (SELECT c.lang, c.phrase, c.k, c.a, i, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.a // (x.f + y.f)::HUGEINT)::BIGINT AS score
        FROM c CROSS JOIN unnest(range(1, c.k)) AS u(i)
        JOIN f x ON x.lang = c.lang AND x.k = i AND x.phrase = array_to_string(c.words[1:i], ' ')
        JOIN f y ON y.lang = c.lang AND y.k = c.k - i AND y.phrase = array_to_string(c.words[i + 1:], ' ')),
best AS (SELECT lang, phrase, k, a, arg_min(l, (score, i)) AS l, arg_min(r, (score, i)) AS r, min(score) AS score FROM cut GROUP BY ALL),
inside AS (SELECT c.lang, s.k, array_to_string(c.words[i:i + s.k - 1], ' ') AS phrase, max(c.a) AS longer
           FROM c, (VALUES (2), (3)) AS s(k), unnest(range(1, c.k - s.k + 2)) AS u(i) WHERE s.k < c.k GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.k = b.k AND i.phrase = b.phrase
         WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < {SHARE}::HUGEINT * b.a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= {TOP}"""
