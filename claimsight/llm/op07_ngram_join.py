"""N-gram Jaccard join: documents whose five-word shingle sets are alike, by prefix trees.

Two sets link when ``100 * |x & y| >= 80 * |x | y|``.  All steps are exact (up
to 64-bit hashes of shingles and sets); nothing is capped or sampled.

1. *Sets.*  One scan hashes every shingle and reduces each document to
   (doc_id, size, signature); equal sets are one class from here on.  The same
   scan counts frequent shingles; the ``HOT_TOKENS`` most frequent (a bounded
   broadcast) go last in the global order, all others stand in hash order.
   The order steers cost only.
2. *Long prefixes.*  Linked sets share at least ``least_shared(n)`` of their
   first ``prefix(n)`` tokens.  A second scan sends these tokens, packed by
   token bucket; a bucket keeps those that two classes of like size share, with
   their frequency.
3. *Survivors.*  Packed again by class: a class with fewer shared prefix tokens
   than any link needs is done.  Of the others' shared tokens all but the
   ``least_shared - 1`` most frequent are keys; linked classes share a key.
   Passages that many documents hold fall away here.
4. *Families.*  Classes of like size that share a key are joined to families
   (buckets emit spanning edges only, then connected components).
5. *Prefix trees.*  Only the survivors' texts are shuffled (but for those that a
   bounded broadcast filter of their hashes lets through), shingled again and meet by
   family.  Their ordered sets form a path-compressed trie that all sets of the
   family walk together: the overlaps counted along a common prefix are shared by
   everything below it, and a set leaves a subtree when even all remaining tokens
   could not reach the needed overlap.  A family beyond ``FAMILY_TOKENS`` is first
   compared with one pivot, and the rest meets in pairs of bounded blocks, so no
   task ever holds an unbounded group.

Results: null and empty texts have the empty set, link with nothing and keep
their own id; repeated rows and ids link like any copies; a null id takes part
but names no component; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import MIX1, U, bounded_batches, distinct_sorted, mix, shingle_hashes, slices, stored, utf8
from .graph import components

WIDTH = 5
#: a link: NUM * |x | y| <= DEN * |x & y|
NUM, DEN = 80, 100
HOT_TOKENS = 100_000
BUCKET_BYTES = 8 << 20
FLUSH_ROWS = 1 << 20
FAMILY_TOKENS = 1 << 18
#: at most 8 MB are broadcast; they steer the cost only
FILTER_BITS = 1 << 26


def needed(n):
    """Least overlap with any linked set: |x & y| >= NUM/DEN * |x|."""
    return -(-NUM * n // DEN)


def extra(n):
    """Tokens by which the prefix is longer than the classic one, and so the least number of shared ones."""
    return n // 10 + 1


def prefix(n):
    return n - needed(n) + extra(n)


def least_shared(n):
    """Shared prefix tokens that every link of a set of size n has: its partner may be as small as needed(n)."""
    return extra(needed(n))


def like_sizes(small, large):
    return NUM * large <= DEN * small


def linked(overlap: int, a: int, b: int) -> bool:
    return DEN * overlap >= NUM * (a + b - overlap)


def overlap_for(a: int, b: int) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-NUM * (a + b) // (NUM + DEN))


# ------------------------------------------------------------------ sets
def token_sets(column: pa.Array, hot: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, row bounds, sizes, signatures) of an Arrow text column; tokens in the global order, hot ones last."""
    data, offsets = utf8(column)
    h, rows = shingle_hashes(data, offsets, WIDTH)
    h, rows = distinct_sorted(h >> U(1), rows)
    n = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n + 1))
    sizes = np.diff(bounds)
    mixed = mix(h + MIX1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(mixed)])
    signs = mix(total[bounds[1:]] - total[bounds[:-1]] + sizes.astype(U)).view(np.int64)
    if hot is not None and len(hot):
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        is_hot = hot[at] == h
        if is_hot.any():
            h = h | (is_hot.astype(U) << U(63))
            order = np.lexsort((h, rows))
            h = h[order]
    return h, bounds, sizes, signs


def _summaries(docs: DataFrame) -> DataFrame:
    """kind 0: (doc_id, hash of the text, n, sig) of each document; kind 1: (token, count) of shingles frequent among a million of a task."""
    out = StructType.fromDDL("text_hash long, kind int, n long, sig long")
    out = StructType([docs.schema["doc_id"], *out.fields])

    def run(batches):
        seen, waiting = [], 0

        def frequent():
            every = np.sort(np.concatenate(seen)) if seen else np.zeros(0, U)
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, int)
            counts = np.diff(np.append(first, len(every)))
            often = counts >= 8
            if often.any():
                tokens, counts = every[first[often]].view(np.int64), counts[often].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(tokens), kind), pa.nulls(len(tokens), pa.int64()), pa.array(np.ones(len(tokens), np.int32)),
                                                  pa.array(counts), pa.array(tokens)], out.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, "text"):
                h, bounds, sizes, signs = token_sets(part.column(1), None)
                seen.append(h)
                waiting += len(h)
                zero = np.zeros(len(sizes), np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(zero), pa.array(sizes.astype(np.int64)), pa.array(signs)], out.names)
            if waiting >= FLUSH_ROWS:
                yield from frequent()
                seen, waiting = [], 0
        yield from frequent()

    return docs.select("doc_id", "text", text_hash().alias("text_hash")).mapInArrow(run, out)


def text_hash(text: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _likely(rows: DataFrame, key: list[str], wanted: DataFrame, other: list[str]) -> DataFrame:
    """The rows whose ``key`` may be among the ``other`` columns of ``wanted``: most others stay out of the shuffle of their join.

    A hash sets one bit of at most ``FILTER_BITS``, broadcast in parts of 32,768 (the size of Spark's bitmaps);
    the more hashes for a bit, the more rows come through in vain.
    """
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(15, (16 * wanted.count()).bit_length()))
    parts = wanted.select(F.xxhash64(*other).bitwiseAND(F.lit(bits - 1)).alias("at")).groupBy(F.shiftright("at", 15).alias("__part")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("__bits"))
    at = rows.withColumn("__at", F.xxhash64(*key).bitwiseAND(F.lit(bits - 1)))
    at = at.withColumn("__part", F.shiftright("__at", 15)).withColumn("__at", F.col("__at").bitwiseAND(F.lit(32767)).cast("int"))
    byte = F.conv(F.hex(F.expr("substring(__bits, shiftright(__at, 3) + 1, 1)")), 16, 10).cast("int")
    found = at.join(F.broadcast(parts), "__part").where(F.call_function("getbit", byte, F.expr("__at & 7")) == 1)
    return found.select(rows.columns)


# ------------------------------------------------------------------ packed shuffles
PACKED = "bucket int, tokens binary, sigs binary, sizes binary, counts binary"


def _pack(bucket: np.ndarray, n_buckets: int, tokens: np.ndarray, sigs: np.ndarray, sizes: np.ndarray, counts: np.ndarray | None = None) -> pa.RecordBatch:
    """One row for each bucket with its entries as bytes: fewer and more compact rows to shuffle."""
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    has = np.flatnonzero(np.diff(at))
    cut = lambda x, kind: pa.array([x[order[at[b]: at[b + 1]]].astype(kind).tobytes() for b in has], pa.binary())
    counts = np.zeros(0, np.uint32) if counts is None else counts
    return pa.RecordBatch.from_arrays([
        pa.array(has.astype(np.int32)), cut(tokens, "<u8"), cut(sigs, "<i8"), cut(sizes, "<u4"),
        cut(counts, "<u4") if len(counts) else pa.array([b""] * len(has), pa.binary())], ["bucket", "tokens", "sigs", "sizes", "counts"])


def _unpack(frame: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    one = lambda c, kind: np.frombuffer(b"".join(frame[c].to_pylist()), kind)
    return one("tokens", "<u8"), one("sigs", "<i8"), one("sizes", "<u4").astype(np.int64), one("counts", "<u4").astype(np.int64)


def _bucket(values: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(values.view(U) + U(1)) % U(n_buckets)).astype(np.int32)


def _prefix_rows(docs: DataFrame, hot: np.ndarray, n_buckets: int) -> DataFrame:
    def run(batches) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()                       # classes that this task has sent (a hint that saves copies)
        held: list[tuple] = []
        waiting = 0

        def flush():
            t, s, z = (np.concatenate(x) for x in zip(*held, strict=True))
            return _pack(_bucket(t, n_buckets), n_buckets, t, s, z)

        for batch in (part for b in batches for part in slices(b, "text")):
            h, bounds, sizes, signs = token_sets(batch.column(0), hot)
            new = np.zeros(len(sizes), bool)
            for i, s in enumerate(signs.tolist()):
                if sizes[i] and s not in seen:
                    new[i] = True
                    seen.add(s)
            if len(seen) > 2_000_000:
                seen.clear()
            many = np.where(new, prefix(sizes), 0)
            take = np.repeat(bounds[:-1] - np.cumsum(many) + many, many) + np.arange(many.sum())
            held.append((h[take], np.repeat(signs, many), np.repeat(sizes, many)))
            waiting += len(take)
            if waiting >= FLUSH_ROWS:
                yield flush()
                held, waiting = [], 0
        if waiting:
            yield flush()

    return docs.select("text").mapInArrow(run, PACKED)


def _groups(tokens: np.ndarray, sigs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Entries by (token, size, sig) without repeats, and the number of each entry's run of like sizes."""
    order = np.lexsort((sigs, sizes, tokens))
    tokens, sigs, sizes = tokens[order], sigs[order], sizes[order]
    if not len(tokens):
        return tokens, sigs, sizes, np.zeros(0, np.int64)
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (sigs[1:] != sigs[:-1])
    tokens, sigs, sizes = tokens[fresh], sigs[fresh], sizes[fresh]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | ~like_sizes(sizes[:-1], sizes[1:])
    return tokens, sigs, sizes, np.cumsum(new) - 1


def _shared(n_buckets: int):
    """Step 2: entries whose token another class of like size holds too, with the token's frequency, by class bucket."""
    def run(frame: pa.Table) -> pa.Table:
        tokens, sigs, sizes, run_of = _groups(*_unpack(frame)[:3])
        often = np.bincount(run_of)[run_of] if len(run_of) else run_of
        _, which, df = np.unique(tokens, return_inverse=True, return_counts=True)
        keep = often > 1
        return pa.Table.from_batches([_pack(_bucket(sigs[keep], n_buckets), n_buckets, tokens[keep], sigs[keep], sizes[keep], df[which][keep])])
    return run


def _survivors(n_buckets: int):
    """Step 3: of the classes with enough shared tokens, all but the most frequent ones, by token bucket."""
    def run(frame: pa.Table) -> pa.Table:
        tokens, sigs, sizes, df = _unpack(frame)
        order = np.lexsort((tokens, df, sigs))
        tokens, sigs, sizes = tokens[order], sigs[order], sizes[order]
        if not len(sigs):
            return pa.Table.from_batches([_pack(np.zeros(0, np.int32), n_buckets, tokens, sigs, sizes)])
        first = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
        many = np.diff(np.append(first, len(sigs)))
        keys = np.maximum(many - least_shared(sizes[first]) + 1, 0)
        place = np.arange(len(sigs)) - np.repeat(first, many)
        keep = place < np.repeat(keys, many)
        return pa.Table.from_batches([_pack(_bucket(tokens[keep], n_buckets), n_buckets, tokens[keep], sigs[keep], sizes[keep])])
    return run


def _spanning(frame: pa.Table) -> pa.Table:
    """Step 4: spanning edges between the classes of a bucket that share a key and are of like size."""
    tokens, sigs, _, run_of = _groups(*_unpack(frame)[:3])
    nodes, index = np.unique(sigs, return_inverse=True)
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    same = np.flatnonzero(run_of[1:] == run_of[:-1]) if len(run_of) else []
    pairs = np.unique(np.stack([index[:-1][same], index[1:][same]], 1), axis=0) if len(same) else np.zeros((0, 2), int)
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    # ``nodes`` ascend, so a root is the least of its component: stars keep the rounds of the components few
    up = np.fromiter((root(i) for i in range(len(nodes))), np.int64, len(nodes))
    moved = up != np.arange(len(nodes))
    return pa.table([pa.array(nodes[moved], pa.int64()), pa.array(nodes[up[moved]], pa.int64())], ["a", "b"])


# ------------------------------------------------------------------ prefix tree
class PrefixTree:
    """Path-compressed trie of ordered token sets, with the bounds that pruning needs."""

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = sets
        # node: (run of tokens, depth after the run, smallest and largest size below, members that end here, children)
        self.first, self.last = [], []               # each node's range in ``order``
        self.order = order
        self.root = self._grow(0, len(order), 0) if order else None

    def _grow(self, a: int, b: int, depth: int):
        """Built without recursion on depth: one stack of pending ranges."""
        root = None
        stack = [(a, b, depth, None)]
        while stack:
            a, b, depth, parent = stack.pop()
            head, tail = self.sets[self.order[a]], self.sets[self.order[b - 1]]
            n = min(len(head), len(tail))
            differ = np.flatnonzero(head[depth:n] != tail[depth:n])
            stop = depth + int(differ[0]) if len(differ) else n
            sizes = [len(self.sets[i]) for i in self.order[a:b]]
            node = [head[depth:stop], stop, min(sizes), max(sizes), [], [], a, b]
            if parent is None:
                root = node
            else:
                parent[5].append(node)
            at = a
            while at < b and len(self.sets[self.order[at]]) == stop:
                node[4].append(self.order[at])
                at += 1
            while at < b:
                token = self.sets[self.order[at]][stop]
                low, high = at + 1, b
                while low < high:                    # the last one with this next token
                    mid = (low + high) // 2
                    if self.sets[self.order[mid]][stop] == token:
                        low = mid + 1
                    else:
                        high = mid
                stack.append((at, low, stop, node))
                at = low
        return root

    def links(self, queries: list[np.ndarray], settled) -> Iterator[tuple[int, np.ndarray]]:
        """(member, numbers of the queries linked with it), over all members.

        All queries walk the tree together: a node's run is counted once, as a vector of overlaps that its
        whole subtree shares.  A query leaves a subtree when its size is unlike all sets below or when all
        remaining tokens could not reach the overlap it needs; a subtree without queries is not walked.
        ``settled()``: whether nothing more can be learned.
        """
        if self.root is None or not queries:
            return
        sizes = np.array([len(q) for q in queries], np.int64)
        tokens = np.concatenate(queries)
        order = np.argsort(tokens, kind="stable")
        holders = np.repeat(np.arange(len(queries)), sizes)[order]      # queries by token: posting lists
        tokens = tokens[order]
        stack = [(self.root, np.zeros(len(queries), np.int64))]
        while stack and not settled():
            (run, depth, small, large, ends, children, _, _), overlap = stack.pop()
            if len(run):
                low, high = np.searchsorted(tokens, run, "left").tolist(), np.searchsorted(tokens, run, "right").tolist()
                hit = [holders[x:y] for x, y in zip(low, high, strict=True) if y > x]
                if hit:
                    overlap = overlap + np.bincount(np.concatenate(hit), minlength=len(queries))
            reach = overlap + np.minimum(sizes - overlap, large - depth)
            alive = (large * DEN >= NUM * sizes) & (sizes * DEN >= NUM * small) & (reach >= overlap_for(sizes, np.maximum(small, needed(sizes))))
            if not alive.any():
                continue
            for i in ends:
                found = np.flatnonzero(alive & (DEN * overlap >= NUM * (sizes + len(self.sets[i]) - overlap)))
                if len(found):
                    yield i, found
            stack.extend((c, overlap) for c in children)


def family_links(sets: list[np.ndarray], against: list[np.ndarray] | None = None, joined: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that span the components of the sets (or, with ``against``, of the links between the two lists,
    whose numbers follow those of ``sets``).

    ``joined``: a component number per set where some are known to be linked already.
    """
    every = sets if against is None else sets + against
    if not every:
        return []
    label = np.arange(len(every)) if joined is None else np.unique(np.array(joined), return_inverse=True)[1].reshape(-1)
    left = len(np.unique(label))
    # ranks stand for tokens: smaller and in the same order
    names = np.unique(np.concatenate(every))
    ranked = [np.searchsorted(names, x) for x in every]
    tree, shift = (PrefixTree(ranked), 0) if against is None else (PrefixTree(ranked[len(sets):]), len(sets))
    for i, found in tree.links(ranked[:len(sets)], lambda: left == 1):
        meet = np.unique(np.append(label[found], label[shift + i]))
        if len(meet) > 1:
            label[np.isin(label, meet)] = meet[0]
            left -= len(meet) - 1
    first = np.full(int(label.max()) + 1, -1)
    out = []
    for i, c in enumerate(label.tolist()):
        if first[c] < 0:
            first[c] = i
        else:
            out.append((int(first[c]), i))
    return out


def _as_set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _edges(sigs: list[int], links: list[tuple[int, int]]) -> pa.Table:
    """The links' components as stars around their least class."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(sigs[a]), root(sigs[b])
        parent[max(x, y)] = min(x, y)
    rows = [(x, root(x)) for x in list(parent) if root(x) != x]
    return pa.table([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], ["a", "b"])


EDGES = "a long, b long"


def _small_families(frame: pa.Table) -> pa.Table:
    return _edges(frame["sig"].to_pylist(), family_links([_as_set(x) for x in frame["tokens"].to_pylist()]))


def _against_pivot(batches) -> Iterator[pa.RecordBatch]:
    """(sig, family, n, tokens, whether linked with the family's pivot)."""
    for batch in batches:
        core = []
        for raw, pivot in zip(batch.column("tokens").to_pylist(), batch.column("pivot").to_pylist(), strict=True):
            a, b = _as_set(raw), _as_set(pivot)
            core.append(linked(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("sig", "family", "n", "tokens", "pivot_sig")] + [pa.array(core, pa.bool_())],
                                         ["sig", "family", "n", "tokens", "pivot_sig", "core"])


def _block_pair(frame: pa.Table) -> pa.Table:
    """Links between (or, for a block with itself, within) two blocks of a family; core members count as joined."""
    left = frame.filter(pc.equal(frame["side"], 0))
    right = frame.filter(pc.equal(frame["side"], 1))
    sigs = left["sig"].to_pylist() + right["sig"].to_pylist()
    joined = [0 if c else i + 1 for i, c in enumerate(left["core"].to_pylist() + right["core"].to_pylist())]
    a, b = [_as_set(x) for x in left["tokens"].to_pylist()], [_as_set(x) for x in right["tokens"].to_pylist()]
    return _edges(sigs, family_links(a, b if len(b) else None, joined))


def _large_families(sets: DataFrame, block_tokens: int) -> DataFrame:
    """Edges of families too large for one task (``tokens_in`` all together)."""
    members = sets.withColumn("blocks", F.ceil(F.col("tokens_in") / block_tokens).cast("int"))
    pivots = members.groupBy("family").agg(F.min("sig").alias("pivot_sig"), F.min_by("tokens", "sig").alias("pivot"), F.first("blocks").alias("blocks"))
    # the pivot goes to every block of its family: no block holds more than a bounded share of it
    salted = pivots.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    compared = stored(members.join(salted.select("family", "block", "pivot", "pivot_sig"), ["family", "block"])
                      .select("sig", "family", "n", "tokens", "pivot", "pivot_sig")
                      .mapInArrow(_against_pivot, "sig long, family long, n long, tokens binary, pivot_sig long, core boolean"), "pivot")
    stars = compared.where("core and sig <> pivot_sig").select(F.col("sig").alias("a"), F.col("pivot_sig").alias("b"))
    # blocks of the core and of the rest; two core blocks need no comparison
    count = compared.groupBy("family", "core").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("blocks"))
    wide = count.groupBy("family").agg(F.max(F.when(F.col("core"), F.col("blocks"))).alias("cores"), F.max(F.when(~F.col("core"), F.col("blocks"))).alias("rests"))
    wide = wide.where(F.col("rests").isNotNull())
    dealt = compared.join(wide, "family").withColumn("block", F.pmod(F.xxhash64("sig", F.lit(1)), F.when(F.col("core"), F.col("cores")).otherwise(F.col("rests"))).cast("int"))
    rest = dealt.where("not core")
    core = dealt.where("core")
    # rest block i meets rest blocks j >= i and every core block; side 0 walks the tree of side 1
    as_left = rest.select("*", F.lit(0).alias("side"), F.explode(F.concat(
        F.transform(F.sequence(F.col("block"), F.col("rests") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(False).alias("c"))),
        F.transform(F.sequence(F.lit(0), F.coalesce("cores", F.lit(1)) - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("c"))))).alias("p"))
    as_right = rest.where("block > 0").select("*", F.lit(1).alias("side"), F.explode(F.transform(
        F.sequence(F.lit(0), F.col("block") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(False).alias("c")))).alias("p"))
    core_right = core.select("*", F.lit(1).alias("side"), F.explode(F.transform(
        F.sequence(F.lit(0), F.col("rests") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(True).alias("c")))).alias("p"))
    columns = ["family", "p", "side", "sig", "core", "tokens"]
    pairs = as_left.select(columns).unionByName(as_right.select(columns)).unionByName(core_right.select(columns))
    # a (rest, core) pair whose core block is empty has one side only: nothing to do there
    return stars.unionByName(pairs.groupBy("family", "p").applyInArrow(_block_pair, EDGES))


# ------------------------------------------------------------------ the join
def groups(docs: DataFrame, family_tokens: int = FAMILY_TOKENS, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component, component_id of every row of ``docs`` (columns doc_id and text).

    ``component`` numbers the linked groups (null for an empty set); ``component_id`` is the smallest id of one.
    """
    spark = docs.sparkSession
    rows = bounded_batches(docs).select("doc_id", "text")
    seen = stored(_summaries(rows), "ngram-sets")
    by_doc = seen.where("kind = 0").select("doc_id", "text_hash", "n", "sig")
    # bounded by hot_tokens
    hot = seen.where("kind = 1").groupBy("sig").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "sig").limit(hot_tokens).select("sig").collect()
    hot = np.sort(np.array([r[0] for r in hot], np.int64).view(U)) if hot else np.zeros(0, U)
    # a representative with an id where there is one; documents without id have their text's hash
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = by_doc.where("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("rep"), F.min(order).alias("carrier"))
    total = by_doc.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * 0.3 * 20 / BUCKET_BYTES) + 1)

    entries = _prefix_rows(rows, hot, n_buckets)
    common = entries.groupBy("bucket").applyInArrow(_shared(n_buckets), PACKED)
    keys = common.groupBy("bucket").applyInArrow(_survivors(n_buckets), PACKED)
    spanning = keys.groupBy("bucket").applyInArrow(_spanning, EDGES)
    families = stored(components(spanning, "ngram-families"), "ngram-families")

    # one document of each surviving class carries its set; how many tokens its family has is known before the sets are made
    wanted = families.join(classes, families["node"] == classes["sig"]).select(
        F.col("carrier.doc_id").alias("__id"), F.col("carrier.text_hash").alias("__hash"), "sig", "n", F.col("component").alias("family"))
    weight = wanted.groupBy("family").agg(F.sum("n").alias("tokens_in"), F.count("*").alias("members")).where("members > 1")
    wanted = stored(wanted.join(weight.select("family", "tokens_in"), "family").select("__id", "__hash", "sig", "family", "tokens_in"), "ngram-wanted")

    def shingle(batches):
        for batch in (part for b in batches for part in slices(b, "text")):
            h, bounds, sizes, signs = token_sets(batch.column("text"), hot)
            same = np.array(batch.column("sig").to_pylist(), np.int64) == signs     # equal hashes of other texts
            at = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(at)) for c in ("sig", "family", "tokens_in")], pa.array(sizes[at].astype(np.int64)),
                                              pa.array([h[bounds[i]: bounds[i + 1]].tobytes() for i in at], pa.binary())], ["sig", "family", "tokens_in", "n", "tokens"])

    carried = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    carriers = _likely(rows.withColumn("text_hash", text_hash()), ["doc_id", "text_hash"], wanted, ["__id", "__hash"])
    sets = carriers.join(wanted, carried).select("sig", "family", "tokens_in", "text").mapInArrow(shingle, "sig long, family long, tokens_in long, n long, tokens binary")
    sets = stored(sets.dropDuplicates(["sig"]), "ngram-survivors")
    edges = sets.where(F.col("tokens_in") <= family_tokens).groupBy("family").applyInArrow(_small_families, EDGES)
    if wanted.where(F.col("tokens_in") > family_tokens).limit(1).count():
        edges = edges.unionByName(_large_families(sets.where(F.col("tokens_in") > family_tokens), max(1, family_tokens // 2)))
    linked_classes = components(edges, "ngram-components")

    # the smallest id of each component; a class without links is its own
    named = classes.join(linked_classes, classes["sig"] == linked_classes["node"], "left").select(
        "sig", F.coalesce("component", "sig").alias("component"), "rep")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = named.join(least, "component").select("sig", "component", "component_id")
    full = by_doc.where("n > 0").join(labels, "sig").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", "component_id")
    empty = by_doc.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component"),
                                         F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    return groups(docs, **options).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when each group keeps its smallest id (documents without a group all stay)."""
    found = stored(groups(docs, **options), "ngram-groups")
    id_order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.where("component is not null").groupBy("component").agg(F.min(id_order).alias("k"), F.count_if(F.lit(True)).alias("rows"))
    stay = (first.select("k.doc_id", "k.text_hash").unionByName(found.where("component is null").select("doc_id", "text_hash")).distinct()
            .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    rows = docs.withColumn("__text_hash", text_hash())
    kept = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    # equal rows (same id and text) of a group are copies of each other too
    again = found.where("component is not null").groupBy("component", "doc_id", "text_hash").count().where("count > 1")
    if again.limit(1).count():
        empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        kept = kept.where(~empty).dropDuplicates(["doc_id", "__text_hash"]).unionByName(kept.where(empty))
    return kept.drop("__text_hash")


SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i : i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(r, to_) AS (SELECT r, r FROM w UNION SELECT reach.r, l.b FROM reach JOIN l ON l.a = reach.to_)
SELECT w.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM w JOIN reach ON reach.r = w.r JOIN w t ON t.r = reach.to_ LEFT JOIN n ON n.r = w.r GROUP BY w.r, w.doc_id
"""
