"""A training corpus from the documents table: five stages, each on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.llm import op02_mixing, op03_byte_bpe, op06_toxicity, op07_ngram_join, op09_pii
from claimsight.llm.common import stored, table

#: documents of this score and more go
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not hold for toxic."""
    lexicon = op06_toxicity.learn(op06_toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = op06_toxicity.score(docs, lexicon, keep=tuple(docs.columns), out=("__score", "__words", "__hits"))
    return scored.where(F.col("__score") < TOXIC).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of linked documents."""
    return op07_ngram_join.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each personal data span replaced by its kind."""
    return op09_pii.redacted(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a document without words is not part of a mix of words and stays once."""
    mixed, _ = op02_mixing.mix(docs, F.array("source"), op02_mixing.size_of(F.col("text")), out=("__size", "__pattern", "__taken"))
    times = F.when(F.col("__size") > 0, (F.col("__taken") / F.col("__size")).cast("int")).otherwise(1)
    return mixed.withColumn("__times", times).where("__times > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__time")).drop("__time")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, token_ids (little-endian unsigned 32-bit) and the digests of the ids and of the decoded bytes."""
    import public_tokenizers
    how = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return op03_byte_bpe.round_trip(docs, *how, keep=("doc_id", "source"))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("pii", redact), ("mixing", mix), ("byte_bpe", encode)]

#: a learned classifier and a tokenizer are not SQL; tests/llm holds the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
