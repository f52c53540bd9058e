"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lowers the text, maps homoglyphs (Cyrillic, Greek and full-width
letters that look Latin) and, inside a word, digits and signs that stand for
letters; every other character ends a word.  Lexicon entries are whole words
or word beginnings; an entry that stands inside an exception phrase (learned:
a toxic entry with its next or previous word that in training text is mostly
clean) does not count.  The sum of the weights is normalised by the length and
turned into a score by a logistic fit on the same training rows.

The lexicon, its weights, the exceptions and the logistic fit are learned from
labelled rows only, at most ``MAX_TRAINING_ROWS`` of them, drawn per class (the
first of each in a hashed order, so the same rows whatever the partitioning; a
rare class comes in with up to half of the rows, and the fit's constant is set
back to the share that the class has in all labelled rows).  Entries are counted
by Spark tasks over their share of the sample; only counts of candidate entries
(at most ``MAX_ENTRIES`` survive) reach the driver.  What makes an entry is a
significance test, the same at every size and share of the classes.

Results: null and empty texts have no hits and score as a text without any
entry; repeated rows score alike; without any labelled row (or only one class)
the lexicon is empty and every score is the base rate, 0 without rows; an empty
table gives an empty result; other columns are ignored unless listed in ``keep``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import bounded_batches, slices, stored

MAX_TRAINING_ROWS = 8_000
MAX_ENTRIES = 2_000
#: word beginnings of these lengths are candidates beside whole words
STEMS = (4, 5, 6, 7, 8, 10)
#: an entry is in two training documents of the toxic class at least, and its documents lean to that class by a
#: likelihood ratio (G) test: chi-square of one degree of freedom at p = 0.001
MIN_TOXIC_DOCS, MIN_G = 2, 10.83

# Homoglyphs as pairs of look-alike and Latin letter.
HOMOGLYPHS = ("аa вb еe кk мm нh оo рp сc тt уy хx іi јj ѕs ԁd ԛq ԝw ɡg ɑa αa βb εe ιi κk νv οo ρp τt υu χx ıi ł1 øo "
              "ａa ｂb ｃc ｄd ｅe ｆf ｇg ｈh ｉi ｊj ｋk ｌl ｍm ｎn ｏo ｐp ｑq ｒr ｓs ｔt ｕu ｖv ｗw ｘx ｙy ｚz")
#: digits and signs that stand for letters, inside a word
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_glyphs = str.maketrans({p[0]: p[1] for p in HOMOGLYPHS.split() if p[1].isalpha()})
_swap = str.maketrans(SUBSTITUTES)
_mixed = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![\w@$!|])[0134578@$]{1,2}(?=[^\W\d_]{2})")
_break = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    """Words in one-blank spacing, with a blank at both ends."""
    low = text.lower().translate(_glyphs)
    low = _mixed.sub(lambda m: m[0].translate(_swap), low)
    return f" {_break.sub(' ', low).strip()} "


@dataclass
class Lexicon:
    """weights: entry -> weight (entries begin with a blank; whole words also end with one)."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    #: logistic fit over (density, hits), first the constant
    fit: tuple[float, float, float] = (-30.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        entries: dict[str, tuple] = {e: (len(e), w, False) for e, w in self.weights.items()}
        entries |= {e: (len(e), 0.0, True) for e in self.exceptions}
        for e, what in entries.items():
            found.add_word(e, what)
        found.make_automaton()
        return found


def hits(line: str, found: ahocorasick.Automaton | None) -> tuple[int, float, int]:
    """(words, weight, places): at each word the heaviest entry counts, unless an exception phrase covers it."""
    words = line.count(" ") - 1 if line.strip() else 0
    if found is None:
        return words, 0.0, 0
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight, exception) in found.iter(line):
        at = end - size + 1
        if exception:
            spared.append((at, end))
        elif abs(weight) > abs(best.get(at, 0.0)):
            best[at] = weight
    if spared:
        # both in order, so each place and each exception is passed once
        places, left, reach = sorted(best), sorted(spared), 0
        k = 0
        for at in places:
            while k < len(left) and left[k][0] <= at:
                reach = max(reach, left[k][1])
                k += 1
            if at < reach:
                del best[at]
    return words, sum(best.values()), len(best)


def features(words, weight) -> np.ndarray:
    """Constant, weight per length (over the square root of the words) and weight, both damped."""
    words, weight = np.asarray(words, float), np.asarray(weight, float)
    damp = lambda x: np.sign(x) * np.log1p(np.abs(x))
    return np.stack([np.ones(len(words)), damp(weight / np.sqrt(np.maximum(words, 1))), damp(100 * weight / np.maximum(words, 20))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    """Ridge-regularised logistic fit by Newton steps."""
    b = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in b)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS, held_out: Column | None = None) -> DataFrame:
    """text, label and stands_for (labelled rows of the class for one drawn) of the bounded sample, a row for each (doc_id, text); ``held_out`` rows never enter."""
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = (labels.where(~held_out & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    # the bound is on rows of different (id, text) that are there: neither ids without document nor repeated rows use it up
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    there = docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_hash.alias("text_hash")).distinct()
    known = stored(there.join(known, "doc_id"), "toxicity-labelled")
    is_toxic = F.col("label") == 1
    clean, toxic = known.agg(F.count_if(~is_toxic), F.count_if(is_toxic)).first()
    quota = {True: min(toxic, max(most // 2, most - clean))}
    quota[False] = min(clean, most - quota[True])
    first = lambda y: (known.where(is_toxic if y else ~is_toxic).orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash").limit(quota[y])
                       .withColumn("stands_for", F.lit((toxic if y else clean) / max(quota[y], 1))))
    rows = first(True).unionByName(first(False))
    # at most ``most`` rows: a proven bound for the broadcast; the sample's texts are written once and read for each pass
    taken = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
             .join(F.broadcast(rows), ["doc_id", "text_hash"]).select("doc_id", "text", "label", "stands_for").distinct())
    return stored(taken.select("text", "label", "stands_for"), "toxicity-sample")


def _g(a: Column, b: Column, n_a: int, n_b: int) -> Column:
    """G statistic of ``a`` of ``n_a`` documents against ``b`` of ``n_b``."""
    with_, total = a + b, float(n_a + n_b)
    cell = lambda seen, n, all_: F.when(seen > 0, seen * F.log(seen * F.lit(total) / (F.lit(float(n)) * all_))).otherwise(0.0)
    without = F.lit(total) - with_
    return 2 * (cell(a, n_a, with_) + cell(b, n_b, with_) + cell(F.lit(n_a) - a, n_a, without) + cell(F.lit(n_b) - b, n_b, without))


def learn(sample: DataFrame) -> Lexicon:
    """Lexicon, exceptions and fit from rows of (text, label 0/1[, stands_for])."""
    if "stands_for" not in sample.columns:
        sample = sample.withColumn("stands_for", F.lit(1.0))
    schema = StructType([StructField("entry", sample.schema["text"].dataType), StructField("label", LongType()),
                         StructField("docs", LongType()), StructField("places", LongType())])

    def count(batches):
        for batch in batches:
            docs, places = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter()
                words = fold(text or "").split()
                for w in words:
                    own[f" {w} "] += 1
                    for n in STEMS:
                        if len(w) > n:
                            own[f" {w[:n]}"] += 1
                label = int(label)
                for e, n in own.items():
                    docs[e, label] += 1
                    places[e, label] += n
                docs["", label] += 1
                places["", label] += len(words)
            keys = list(docs)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                              pa.array([docs[k] for k in keys], pa.int64()), pa.array([places[k] for k in keys], pa.int64())],
                                             schema.names)

    is_toxic = F.col("label") == 1
    table = (sample.select("text", F.col("label").cast("long").alias("label")).mapInArrow(count, schema).groupBy("entry")
             .agg(*[F.sum(F.when(is_toxic if y else ~is_toxic, F.col(c)).otherwise(0)).alias(f"{c}{y}") for c in ("docs", "places") for y in (0, 1)]))
    total = table.where("entry = ''").collect()
    if not total or not total[0]["docs0"] or not total[0]["docs1"]:
        rows = total[0] if total else None
        only = 30.0 if rows and rows["docs1"] else -30.0
        return Lexicon(fit=(only, 0.0, 0.0))
    all_ = total[0]
    # log of the ratio of rates per word, with one place in a million words on either side
    rate = lambda y: (F.col(f"places{y}") + 0.5) / F.lit(all_[f"places{y}"] + 1.0)
    spread = F.log((F.col("docs1") + 0.5) / F.lit(all_["docs1"] + 1.0)) - F.log((F.col("docs0") + 0.5) / F.lit(all_["docs0"] + 1.0))
    found = (table.where((F.col("entry") != "") & (F.col("docs1") >= MIN_TOXIC_DOCS))
             .withColumn("weight", F.least(F.log(rate(1)) - F.log(rate(0)), F.lit(6.0))).withColumn("spread", spread)
             .where((F.col("weight") > 1.0) & (F.col("spread") > 1.0) & (_g(F.col("docs1"), F.col("docs0"), all_["docs1"], all_["docs0"]) >= MIN_G))
             .withColumn("gain", F.col("spread") * F.sqrt("docs1")).orderBy(F.desc("gain"), "entry").limit(MAX_ENTRIES).collect())
    lexicon = Lexicon({r["entry"]: r["weight"] for r in found})
    _add_exceptions(lexicon, sample)
    found_by = lexicon.automaton
    score_schema = StructType([StructField("label", LongType()), StructField("words", LongType()), StructField("weight", DoubleType()), StructField("stands_for", DoubleType())])

    def measure(batches):
        automaton = found_by()
        for batch in batches:
            out = [hits(fold(t or ""), automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([w for w, *_ in out], pa.int64()), pa.array([x for _, x, _ in out], pa.float64()),
                                              batch.column(2)], score_schema.names)

    rows = sample.select("text", F.col("label").cast("long").alias("label"), "stands_for").mapInArrow(measure, score_schema).collect()
    x = features([r["words"] for r in rows], [r["weight"] for r in rows])
    constant, *slopes = _logistic(x, np.array([float(r["label"] == 1) for r in rows]))
    # the sample is drawn per class: back to the odds of the labelled rows
    stand = {y: max(r["stands_for"] for r in rows if (r["label"] == 1) == y) for y in (True, False)}
    lexicon.fit = (constant + math.log(stand[True] / stand[False]), *slopes)
    return lexicon


def _add_exceptions(lexicon: Lexicon, sample: DataFrame, min_docs: int = 5) -> None:
    """Two-word phrases with an entry that occur in ``min_docs`` clean training texts and, by the labelled rows that the texts stand for, at most a fifth as many toxic ones."""
    automaton_of = lexicon.automaton
    schema = StructType([StructField("phrase", sample.schema["text"].dataType), StructField("label", LongType()), StructField("stands_for", DoubleType())])

    def pairs(batches):
        automaton = automaton_of()
        for batch in batches:
            phrases, labels, stand = [], [], []
            for text, label, each in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                line, own = fold(text or ""), set()
                for end, (size, _, _) in automaton.iter(line) if automaton else ():
                    at = end - size + 1
                    close = line.find(" ", at + 1)
                    after, before = line.find(" ", close + 1), line.rfind(" ", 0, at)
                    if after > 0:
                        own.add(line[at: after + 1])
                    if before >= 0:
                        own.add(line[before: close + 1])
                phrases += own
                labels += [int(label)] * len(own)
                stand += [each] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int64()), pa.array(stand, pa.float64())], schema.names)

    of = lambda y, c: F.sum(F.when((F.col("label") == 1) == F.lit(y), c).otherwise(0))
    rows = (sample.select("text", F.col("label").cast("long").alias("label"), "stands_for").mapInArrow(pairs, schema).groupBy("phrase")
            .agg(of(False, F.lit(1)).alias("clean"), of(False, F.col("stands_for")).alias("all_clean"), of(True, F.col("stands_for")).alias("all_toxic"))
            .where((F.col("clean") >= min_docs) & (F.col("all_toxic") * 5 <= F.col("all_clean")))
            .orderBy(F.desc("clean"), "phrase").limit(MAX_ENTRIES).collect())
    lexicon.exceptions = [r["phrase"] for r in rows]


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          out: tuple[str, str, str] = ("score", "n_words", "n_hits")) -> DataFrame:
    """``keep`` columns with score (0 to 1), words and places of the whole text, named by ``out`` (which replaces columns named so)."""
    keep = tuple(c for c in keep if c not in out)
    taken = list(dict.fromkeys([*keep, text]))
    rows = bounded_batches(docs).select(*[F.col(f"`{c}`") for c in taken])
    schema = StructType([*(rows.schema[c] for c in keep), StructField(out[0], DoubleType()), StructField(out[1], LongType()), StructField(out[2], LongType())])

    def run(batches):
        automaton = lexicon.automaton()
        for batch in (part for b in batches for part in slices(b, text)):
            found = [hits(fold(t or ""), automaton) for t in batch.column(taken.index(text)).to_pylist()]
            z = features([w for w, *_ in found], [x for _, x, _ in found]) @ np.array(lexicon.fit)
            yield pa.RecordBatch.from_arrays([*(batch.column(taken.index(c)) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))),
                                              pa.array([w for w, *_ in found], pa.int64()), pa.array([n for *_, n in found], pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row of each document."""
    lexicon = learn(training_rows(docs, labels))
    return score(docs, lexicon).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "n_hits")
