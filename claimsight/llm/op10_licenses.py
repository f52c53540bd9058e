"""License scan: an Aho-Corasick automaton over normalised words, and licence expressions.

A text's ASCII letters are lowered and everything between words (runs of
ASCII letters, digits and non-ASCII characters) becomes one blank, so a phrase
is found however its words are spaced or punctuated.  One automaton holds the
base phrases, the method's own notice phrases and the words of the identifier
tag.  After a tag the licence expression is read from the raw text, turned to
postfix by the shunting-yard algorithm and evaluated: ``and`` needs every
licence, ``or`` the best of them, ``with`` an exception that does not weaken
its licence.

``score`` (0 to 1) is how surely the document states a licence: evidence of
notices and tags combines as independent, ``1 - prod(1 - weight)``, over
distinct labels.  ``openness`` is the evaluated expression's value, null
without a readable tag.

Results: null and empty texts have no words, no places, empty labels and score
0; repeated rows each get their own; an empty table gives an empty result;
other columns are ignored unless listed in ``keep``.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import bounded_batches, slices

# The contract's phrases and labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: the method's own notice phrases, with the label and the weight as evidence
NOTICE_PHRASES = {
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "bsd license": ("bsd", 0.7),
    "bsd 2 clause": ("bsd", 0.7),
    "bsd 3 clause": ("bsd", 0.7),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc0 1 0": ("cc0", 0.7),
    "creative commons attribution": ("cc-by", 0.7),
    "permission is hereby granted free of charge": ("mit", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.7),
    "all rights reserved": ("proprietary", 0.3),
}
BASE_WEIGHT, TAG_WEIGHT = 0.7, 0.9
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"spdx-license-identifier\s*:[ \t]*", re.IGNORECASE)
#: an expression's tokens; the end of its line is one
TOKEN = re.compile(r"[()\r\n]|[A-Za-z0-9][A-Za-z0-9.+:-]*|\S")
#: families by the start of an identifier, longest first, with how freely a corpus may use them
FAMILIES = {
    "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.6, "cc-by": 0.8, "cc0": 1.0, "agpl": 0.2, "lgpl": 0.5, "gpl": 0.4,
    "mpl": 0.6, "epl": 0.6, "apache": 1.0, "bsd": 1.0, "mit": 1.0, "isc": 1.0, "unlicense": 1.0, "proprietary": 0.0,
}
UNKNOWN_OPENNESS = 0.1

_words = np.full(256, 0x20, np.uint8)
_words[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_words[0x41:0x5B] = np.arange(0x61, 0x7B)
TO_WORDS = _words.tobytes()


def automaton() -> ahocorasick.Automaton:
    """Phrases between blanks; each entry is its number of blanks and [(kind, label, weight)]."""
    entries: dict[str, list] = {}
    for phrase, label in BASE_PHRASES.items():
        entries.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        entries.setdefault(phrase, []).append(("notice", label, weight))
    entries.setdefault(TAG_WORDS, []).append(("tag", "", 0.0))
    found = ahocorasick.Automaton()
    for phrase, kinds in entries.items():
        found.add_word(f" {phrase} ", (phrase.count(" ") + 2, kinds))
    found.make_automaton()
    return found


def family(identifier: str) -> str:
    name = identifier.lower().rstrip("+")
    return next((f for f in FAMILIES if name == f or name.startswith(f + "-")), name)


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the tokens of a licence expression in postfix order; ValueError without any licence."""
    out, _ = read_expression(expression, 0)
    if not out:
        raise ValueError("no licence")
    return out


def read_expression(text: str, at: int) -> tuple[list[str], int]:
    """The expression from ``at`` on in postfix order, and where it stops: the line's end or before what can't continue it.

    ``with`` binds closer than ``and``, ``and`` closer than ``or``.
    """
    rank = {"or": 1, "and": 2, "with": 3}
    out: list[str] = []
    waiting: list[str] = []
    operand = True                                   # whether an operand may come next
    end = at
    for m in TOKEN.finditer(text, at):
        token = m[0]
        low = token.lower()
        if operand and token == "(":
            waiting.append("(")
        elif operand and re.match(r"[A-Za-z0-9]", token) and low not in rank:
            out.append(token.rstrip(".:"))
            operand = False
        elif not operand and low in rank:
            while waiting and waiting[-1] != "(" and rank[waiting[-1]] >= rank[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = True
        elif not operand and token == ")" and "(" in waiting:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            break
        end = m.end()
    if operand and waiting and waiting[-1] != "(":    # an operator without its right side
        waiting.pop()
    out += [t for t in reversed(waiting) if t != "("]
    return out, end


def evaluate(tokens: list[str]) -> tuple[float, set[str]]:
    """(openness, labels) of a postfix expression."""
    stack: list[tuple[float, set[str]]] = []
    for t in tokens:
        if t in ("and", "or", "with") and len(stack) > 1:
            (rv, rl), (lv, ll) = stack.pop(), stack.pop()
            if t == "with":
                stack.append((lv, ll))
            else:
                few, many = sorted((ll, rl), key=len)
                many |= few
                stack.append(((min if t == "and" else max)(lv, rv), many))
        else:
            stack.append((FAMILIES.get(family(t), UNKNOWN_OPENNESS), {family(t)}))
    return stack[-1]


def scan_text(raw: bytes, found: ahocorasick.Automaton) -> tuple:
    """(words, base places [(start word, label)], labels {label: weight}, openness or None) of one text."""
    words = raw.translate(TO_WORDS).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    base, labels, openness, tagged = [], {}, None, False
    blanks = counted = 0                              # blanks up to the end of the hit: ends never descend, so each is counted once
    for end, (inner, kinds) in found.iter(line):
        blanks, counted = blanks + line.count(" ", counted, end + 1), end + 1
        for kind, label, weight in kinds:
            if kind == "base":
                base.append((blanks - inner, label))
            if kind == "tag":
                tagged = True
            else:
                labels[label] = max(weight, labels.get(label, 0.0))
    text, at = raw.decode("utf-8") if tagged else "", 0
    while m := TAG.search(text, at):
        tokens, at = read_expression(text, m.end())
        if not tokens:
            continue
        value, named = evaluate(tokens)
        openness = value if openness is None else min(openness, value)
        for label in named:
            labels[label] = max(TAG_WEIGHT, labels.get(label, 0.0))
    return len(words), sorted(base), labels, openness


RESULT = [StructField("n_words", LongType()), StructField("n_base", LongType()), StructField("first_word", LongType()),
          StructField("last_word", LongType()), StructField("base_places", ArrayType(StructType([
              StructField("word", LongType()), StructField("label", StringType())]))),
          StructField("base_labels", ArrayType(StringType())), StructField("labels", ArrayType(StringType())),
          StructField("openness", DoubleType()), StructField("score", DoubleType())]


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and what the scan found in the whole text of each row."""
    rows = bounded_batches(docs).select(*keep, text)
    schema = StructType([*(rows.schema[c] for c in keep), *RESULT])
    names = [f.name for f in schema]
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])

    def run(batches):
        found = automaton()
        for batch in (part for b in batches for part in slices(b, text)):
            out = [scan_text((t or "").encode(), found) for t in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(len(keep))),
                pa.array([n for n, *_ in out], pa.int64()),
                pa.array([len(b) for _, b, *_ in out], pa.int64()),
                pa.array([b[0][0] if b else None for _, b, *_ in out], pa.int64()),
                pa.array([b[-1][0] if b else None for _, b, *_ in out], pa.int64()),
                pa.array([[{"word": w, "label": x} for w, x in b] for _, b, *_ in out], pa.list_(place)),
                pa.array([sorted({x for _, x in b}) for _, b, *_ in out], pa.list_(pa.string())),
                pa.array([sorted(names) for _, _, names, _ in out], pa.list_(pa.string())),
                pa.array([o for *_, o in out], pa.float64()),
                pa.array([1.0 - float(np.prod([1.0 - w for w in names.values()])) if names else 0.0 for _, _, names, _ in out], pa.float64()),
            ], names)

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The contract's row of each document."""
    from pyspark.sql import functions as F
    return scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word",
                             F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
                             "score", "openness")
