"""Secret scan: long random-looking strings, with false positives removed by a random forest.

Only DataFrame and SQL functions and Spark's own ``RandomForestClassifier``
run here (no Python on the executors).  Every run of ``[A-Za-z0-9+/_=-]`` of at
least ``MIN_CHARS`` characters is a candidate.  The forest judges it by

* its length;
* its character transitions: the share of steps between lower case, upper case,
  digits and signs, of steps between vowels and consonants, of pairs that are
  common in the corpus's words, and the shares of the classes themselves;
* dictionary coverage: the share of its characters that frequent corpus words cover;
* path: slashes in it, and a slash, dot or ``://`` around it;
* neighbouring words: words of secrets, words of harmless digests and ids, an
  assignment and a quote before it.

The forest learns from labelled findings (text, start, end, label).  Where the
caller has none, ``planted_findings`` derives them from a bounded sample of the
corpus (the dictionary and the common pairs are counted over all of it): derived random strings in the contexts of secrets and, as false
positives, digests and ids in harmless contexts, paths, compounds of corpus
words, placeholders, numbers and the corpus's own long words.

Results: null and empty texts have no candidates; a run of any length is one
candidate, judged whole; repeated rows each get their row; an empty table (no
sample) gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .op09_pii import positions

MIN_CHARS = 16
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{16,}+"
NEAR_CHARS = 40
#: documents that the planted findings come from, at most
SAMPLE_DOCS = 600
DICTIONARY_WORDS, COMMON_PAIRS = 300, 80
TREES, DEPTH = 24, 8
THRESHOLD = 0.5

SECRET_WORDS = "token|secret|passw|pwd|api.?key|apikey|auth|bearer|credential|private|access.?key|signature"
HARMLESS_WORDS = "commit|sha1|sha256|sha512|md5|checksum|digest|hash|uuid|guid|etag|revision|integrity|fingerprint|example|sample|placeholder"

FEATURES = ("length", "lower", "upper", "digit", "sign", "class_steps", "vowel_steps", "common_pairs", "distinct", "hex",
            "dictionary", "slashes", "in_path", "secret_word", "harmless_word", "assigned", "quoted")


def sample_docs(docs: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """A bounded sample, the same whatever the partitioning: the first ids in hashed order."""
    ids = (docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])   # at most ``most`` ids


def vocabulary(docs: DataFrame) -> tuple[list[str], list[str]]:
    """(frequent words of 4 letters and more, common letter pairs) of all documents; both of bounded size."""
    words = stored(docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w"))
                   .groupBy("w").count(), "secrets-words")
    top = words.orderBy(F.desc("count"), "w").limit(DICTIONARY_WORDS)
    pairs = (words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("p"), "count")
             .groupBy("p").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "p").limit(COMMON_PAIRS))
    return [r["w"] for r in top.collect()], [r["p"] for r in pairs.collect()]


def features(value: Column, before: Column, after: Column, words: list[str], pairs: list[str]) -> dict[str, Column]:
    n = F.length(value).cast("double")
    share = lambda pattern, c=value: F.regexp_count(c, F.lit(pattern)) / n
    low = F.lower(value)
    covering = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    context = F.lower(before)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return {
        "length": F.log(n), "lower": share("[a-z]"), "upper": share("[A-Z]"), "digit": share("[0-9]"), "sign": share("[^A-Za-z0-9]"),
        "class_steps": share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])|[^A-Za-z0-9](?=[A-Za-z0-9])"),
        "vowel_steps": share("[aeiou](?=[bcdfghjklmnpqrstvwxyz])|[bcdfghjklmnpqrstvwxyz](?=[aeiou])", low),
        "common_pairs": share("(?=" + ("|".join(pairs) or "(?!)") + ")", low),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(64.0)),
        "hex": flag(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "dictionary": (n - F.length(F.regexp_replace(low, covering, ""))) / n,
        "slashes": F.least(F.regexp_count(value, F.lit("/")), F.lit(6)).cast("double"),
        "in_path": flag(before.rlike(r"(?:://|[/.\\])$") | after.rlike(r"^(?:[/\\]|\.[a-z])")),
        "secret_word": flag(context.rlike(SECRET_WORDS)), "harmless_word": flag(context.rlike(HARMLESS_WORDS)),
        "assigned": flag(before.rlike("[=:]\\s*[\"']?$")), "quoted": flag(before.rlike("[\"']$")),
    }


def candidates(docs: DataFrame, words: list[str], pairs: list[str], text: str = "text") -> DataFrame:
    """Every column of ``docs`` but the text, with start, end and the features; a row without candidate keeps one row (pos null)."""
    body = F.coalesce(F.col(text), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    around = positions(body, CANDIDATE, r"[A-Za-z0-9+/_=-]{16}")
    spans = F.transform(around, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
        F.substring(body, F.greatest(x["start"] - NEAR_CHARS, F.lit(0)) + 1, F.least(x["start"], F.lit(NEAR_CHARS))).alias("before"),
        F.substring(body, x["end"] + 1, F.lit(NEAR_CHARS)).alias("after")))
    rows = docs.select(*others, F.posexplode_outer(spans).alias("pos", "c"))
    made = features(F.col("c.value"), F.col("c.before"), F.col("c.after"), words, pairs)
    return rows.select(*others, "pos", F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                       *[F.coalesce(made[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])


def planted_findings(sample: DataFrame) -> DataFrame:
    """text, start, end, label: labelled findings in the sample's own prose."""
    seed = lambda name: F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(name)), 256)
    b64 = lambda name, n: F.substring(F.base64(F.unhex(seed(name))), 1, n)
    hexa = lambda name, n: F.substring(seed(name), 1, n)
    tokens = F.split(F.substring("text", 1, 4000), r"\s+")
    word = lambda i: F.lower(F.regexp_replace(F.coalesce(F.get(F.col("ws"), F.lit(i)), F.lit("file")), "[^A-Za-z]", ""))
    prose = lambda i: F.array_join(F.slice("ws", i, 6), " ")
    one = F.lit("")
    made = [  # (label, what stands before, the string, what stands after)
        (1, F.lit('token = "'), hexa("t1", 40), F.lit('"')), (1, F.lit('TOKEN = "'), F.upper(hexa("t2", 40)), F.lit('"')),
        (1, F.lit("api_key: "), b64("t3", 32), one), (1, F.lit("password="), b64("t4", 24), one),
        (1, F.lit("secret = '"), F.concat(F.lit("sk_live_"), hexa("t5", 24)), F.lit("'")),
        (1, F.lit("Authorization: Bearer "), b64("t6", 43), one), (1, one, F.concat(F.lit("ghp_"), F.regexp_replace(b64("t7", 40), "[+/=]", "7")), one),
        (1, F.lit("auth "), hexa("t8", 32), one),
        (0, F.lit("commit "), hexa("f1", 40), one), (0, F.lit("sha256 "), hexa("f2", 64), one), (0, F.lit("checksum: "), hexa("f3", 32), one),
        (0, F.lit("uuid "), F.concat_ws("-", hexa("f4", 8), hexa("f5", 4), hexa("f6", 4), hexa("f7", 4), hexa("f8", 12)), one),
        (0, one, F.concat(F.lit("/usr/lib/"), word(1), F.lit("/"), word(2), F.lit("/"), word(3)), F.lit(".so")),
        (0, F.lit("see https://"), F.concat(word(4), F.lit("/"), word(5), F.lit("/"), word(6), F.lit("-"), word(7)), F.lit(".html")),
        (0, F.lit('token = "'), F.concat_ws("_", F.lit("your"), word(2), F.lit("token_here")), F.lit('"')),
        (0, F.lit("password: "), F.concat_ws("-", word(3), word(4), word(5), word(8)), one),
        (0, one, F.concat(word(5), word(6), word(7), word(8)), one), (0, F.lit("no. "), F.translate(hexa("f9", 20), "abcdef", "012345"), one),
        (0, one, F.lit("================================"), one), (0, one, F.lit("--------------------"), one),
    ]
    rows = sample.select("doc_id", tokens.alias("ws")).select("*", F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.concat(prose(i % 5 + 1), F.lit(" "), left).alias("left"), value.alias("value"),
                 F.concat(right, F.lit(" "), prose(i % 7 + 6)).alias("right")) for i, (label, left, value, right) in enumerate(made)])).alias("x"))
    planted = rows.select(F.concat("x.left", "x.value", "x.right").alias("text"), F.length("x.left").alias("start"),
                          (F.length("x.left") + F.length("x.value")).alias("end"), F.col("x.label").alias("label"))
    # the corpus's own long words are not secrets
    own = (sample.select("text", F.explode(positions(F.col("text"), "[A-Za-z-]{16,}+", "[A-Za-z-]{16}")).alias("x"))
           .select("text", F.col("x.start").alias("start"), F.col("x.end").alias("end"), F.lit(0).alias("label")))
    return planted.unionByName(own)


def train(findings: DataFrame, words: list[str], pairs: list[str]) -> RandomForestClassificationModel | None:
    """The forest, from labelled findings (text, start, end, label); a candidate that covers a finding has its label."""
    rows = candidates(findings.select("text", F.col("start").alias("at"), F.col("end").alias("till"), F.col("label").cast("double").alias("label")), words, pairs)
    rows = rows.where((F.col("start") <= F.col("at")) & (F.col("end") >= F.col("at") + MIN_CHARS)).select("label", *FEATURES)
    rows = rows.cache()
    try:
        if rows.select("label").distinct().count() < 2:
            return None
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows)
        return RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=7,
                                      featureSubsetStrategy="sqrt", minInstancesPerNode=3).fit(ready)
    finally:
        rows.unpersist()


def scan(docs: DataFrame, model: RandomForestClassificationModel | None, words: list[str], pairs: list[str]) -> DataFrame:
    """doc_id, pos, start, end, score for each candidate; a document without candidate keeps one row without pos."""
    rows = candidates(docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text"), words, pairs)
    if model is None:
        return rows.select("doc_id", "text_hash", "pos", "start", "end", F.lit(0.0).alias("score"))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="__x").transform(rows)
    named = model.setFeaturesCol("__x").setProbabilityCol("__p").setRawPredictionCol("").setPredictionCol("")
    return named.transform(ready).select("doc_id", "text_hash", "pos", "start", "end", vector_to_array("__p")[1].alias("score"))


def digests(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: candidates, secrets, their spans (start:end, code points) and the highest score."""
    sample = sample_docs(docs)
    words, pairs = vocabulary(docs)
    model = train(planted_findings(sample), words, pairs)
    found = scan(docs, model, words, pairs)
    # rows of equal id and text share a group; their number is counted and they are dealt out again
    by_doc = found.groupBy("doc_id", "text_hash").agg(
        F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("start", "end", F.round("score", 6).alias("score"))))).alias("c"))
    secret = F.filter("c", lambda x: x["score"] >= threshold)
    return by_doc.select(
        "doc_id", F.size("c").cast("long").alias("n_candidates"), F.size(secret).cast("long").alias("n_secrets"),
        F.array_join(F.transform(secret, lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("c", lambda x: x["score"])), F.lit(0.0)).alias("max_score"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
