"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks of ``chunk_chars`` code points that overlap by
``overlap``.  Every chunk is pre-tokenised on its own, so a long text is
spread over tasks.  A split of the pattern depends only on what follows its
start, so two runs that share one boundary agree from there on: the stitch
takes the first boundary that a chunk shares with its predecessor's run over
the overlap, keeps the predecessor's pieces before it and the chunk's after
it.  Where the overlap holds no shared boundary (one piece longer than the
overlap), the chunk is pre-tokenised again from the last shared boundary over
the joined text.  Decoding concatenates the raw bytes of the ids.

Texts of one chunk are encoded in place without a shuffle; only the chunks of
longer texts meet again by row.

Results: a null text counts as empty; an empty text has no ids; repeated rows
(same id, even same text) stay separate rows; an empty table gives an empty
result; other columns of the input are ignored unless listed in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import slices

CHUNK_CHARS = 1 << 15
OVERLAP = 1 << 10
#: the pattern's longest literal alternative ('re, 've, 'll) and one: a cut can change splits this close to it
CUT_CHARS = 4
#: pieces kept per worker; the cache starts anew beyond it (memory only, never results)
CACHE_PIECES = 100_000


class Codec:
    """Ranks, pre-tokeniser and piece cache of one worker process."""

    _kept: dict[tuple[str, str], Codec] = {}

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.general = regex.compile(pattern)
        self.fast, self.odd = _ascii_class_pattern(pattern, regex)
        self.pieces: dict[str, bytes] = {}
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    @classmethod
    def get(cls, path: str, pattern: str) -> Codec:
        key = (path, pattern)
        if key not in cls._kept:
            cls._kept[key] = cls(path, pattern)
        return cls._kept[key]

    def split(self, text: str) -> list[str]:
        if self.fast is None or self.odd.search(text):
            return [m[0] for m in self.general.finditer(text)]
        return self.fast.findall(text)

    def ids(self, pieces: list[str]) -> bytes:
        """Little-endian unsigned 32-bit ids of the pieces."""
        known = self.pieces
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if len(known) > CACHE_PIECES:
            known.clear()
        for p in set(pieces).difference(known):
            known[p] = np.array(self.bpe.encode_ordinary(p), "<u4").tobytes()
        return b"".join(map(known.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _ascii_class_pattern(pattern: str, regex):
    """For the usual pattern of the rank files: an equal pattern for ``re`` (twice as fast), and a
    pattern of the characters on which the two modules' classes may differ; else (None, None)."""
    import public_tokenizers
    if pattern != public_tokenizers.PATTERN:
        return None, None
    fast = re.compile(r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x10000))))
    odd = set()
    for ours, theirs in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s")):
        odd |= set(re.findall(ours, every)) ^ set(regex.findall(theirs, every))
    return fast, re.compile("[\U00010000-\U0010FFFF" + "".join(map(re.escape, sorted(odd))) + "]")


def _ends(pieces: list[str]) -> list[int]:
    return list(itertools.accumulate(map(len, pieces)))


def stitch(codec: Codec, chunks: list[tuple[int, str]], chunk_chars: int) -> bytes:
    """Ids of one text from its overlapping chunks [(number, text with overlap)], in order.

    ``run`` holds the pieces known to be right and where they end.  Each chunk is split alone; its
    run joins at the first boundary shared with the run before.
    """
    out: list[bytes] = []
    run, at = codec.split(chunks[0][1]), 0         # at: text position where run starts
    for k, text in chunks[1:]:
        start = k * chunk_chars
        own = codec.split(text)
        ends = [at, *(at + e for e in _ends(run))]
        mine = {start, *(start + e for e in _ends(own))}
        # what stands before the cut of a run may split otherwise: no boundary of the last few characters counts
        sure = ends[-1] - CUT_CHARS
        shared = next((i for i, e in enumerate(ends) if start <= e <= sure and e in mine), None)
        if shared is None:                          # no shared boundary in the overlap: split the joined text again
            kept = max((i for i, e in enumerate(ends) if e <= min(start, sure)), default=0)
            out.append(codec.ids(run[:kept]))
            joined = "".join(run[kept:])
            run = codec.split(joined[: start - ends[kept]] + text)
            at = ends[kept]
            continue
        out.append(codec.ids(run[:shared]))
        at = ends[shared]
        run = own[0 if at == start else next(i + 1 for i, e in enumerate(_ends(own)) if start + e == at):]
    out.append(codec.ids(run))
    return b"".join(out)


def _with_ids(docs: DataFrame, ranks_path: str, pattern: str, text: str, keep: tuple[str, ...], chunk_chars: int, overlap: int, fields: list[StructField], more) -> DataFrame:
    """``keep`` columns and ``fields``: what ``more`` makes of the codec and each text's ids."""
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    result = StructType([*[rows.schema[c] for c in keep], *fields])
    names = [f.name for f in result]

    def arrays(codec, ids):
        return [pa.array(c, to_arrow_type(f.dataType)) for f, c in zip(fields, zip(*[more(codec, x) for x in ids], strict=True), strict=True)]

    def whole(batches):
        codec = Codec.get(ranks_path, pattern)
        for batch in (part for b in batches for part in slices(b, "__text")):
            ids, last = [], None
            for t in batch.column(len(keep)).to_pylist():
                if t != last or not ids:              # a mix repeats a document in rows that follow each other
                    ids.append(codec.ids(codec.split(t)))
                else:
                    ids.append(ids[-1])
                last = t
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *arrays(codec, ids)], names)

    short = rows.where(F.length("__text") <= chunk_chars).mapInArrow(whole, result)

    long = (rows.where(F.length("__text") > chunk_chars).withColumn("__row", F.monotonically_increasing_id())
            .withColumn("__k", F.explode(F.sequence(F.lit(0), ((F.length("__text") - 1) / chunk_chars).cast("int"))))
            .withColumn("__text", F.substring(F.col("__text"), F.col("__k") * chunk_chars + 1, F.lit(chunk_chars + overlap))))

    def join(frame):
        codec = Codec.get(ranks_path, pattern)
        frame = frame.sort_by("__k")
        parts = list(zip(frame["__k"].to_pylist(), frame["__text"].to_pylist(), strict=True))
        first = frame.slice(0, 1)
        return pa.table([*(first[c] for c in keep), *arrays(codec, [stitch(codec, parts, chunk_chars)])], names)

    stitched = long.groupBy("__row").applyInArrow(join, result)
    return short.unionByName(stitched)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP, out: str = "token_ids") -> DataFrame:
    """``keep`` columns and ``out``: the ids of the whole text as little-endian unsigned 32-bit (binary)."""
    return _with_ids(docs, ranks_path, pattern, text, keep, chunk_chars, overlap, [StructField(out, BinaryType())], lambda codec, ids: (ids,))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True,
               chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns, n_tokens, token_ids (on request) and the SHA-256 of the ids and of the decoded bytes, in one pass over slices."""
    def more(codec, ids):
        return (len(ids) // 4, *((ids,) if with_ids else ()), hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest())

    fields = [StructField("n_tokens", LongType()), *([StructField("token_ids", BinaryType())] if with_ids else []),
              StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _with_ids(docs, ranks_path, pattern, text, keep, chunk_chars, overlap, fields, more)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the bytes that the ids of the binary column ``ids`` stand for (null: empty)."""
    schema = StructType([*df.schema.fields, StructField(out, BinaryType())])
    at = df.columns.index(ids)
    names = [f.name for f in schema]

    def run(batches):
        codec = Codec.get(ranks_path, pattern)
        for batch in (part for b in batches for part in slices(b, ids)):
            raw = pa.array([codec.decode(x or b"") for x in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names)

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``."""
    return round_trip(docs, ranks_path, pattern, with_ids=False, **options)
