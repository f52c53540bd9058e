"""The registered queries of the operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op01_suffix_dedup, op02_mixing, op03_byte_bpe, op04_secrets, op05_fingerprints, op06_toxicity, op07_ngram_join, op08_vantage_points, op09_pii
from . import op10_licenses as op10_licenses_
from . import op11_alignment as op11_alignment_
from . import op12_collocations as op12_collocations_
from . import op13_url_filters as op13_url_filters_
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 100-byte strings."""
    return op01_suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return op02_mixing.digests(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document by the byte_bpe_multi_50k ranks."""
    import public_tokenizers
    return op03_byte_bpe.digests(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by a forest trained on findings planted in a bounded sample."""
    return op04_secrets.digests(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return op05_fingerprints.digests(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    return op06_toxicity.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 0.8 alike."""
    return op07_ngram_join.join(table(spark, sf_dir, "documents"))


def op8_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return op08_vantage_points.digests(table(spark, sf_dir, "embeddings"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return op09_pii.digests(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and tags of every document."""
    return op10_licenses_.digests(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens that byte_bpe_50k and piece_bpe_32k give every document."""
    import public_tokenizers
    return op11_alignment_.digests(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each lang."""
    return op12_collocations_.digests(table(spark, sf_dir, "documents"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url, by rule or by what its url is an alias of."""
    return op13_url_filters_.digests(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_secrets": op4_secrets,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_vantage_points": op8_vantage_points,
    "op9_pii": op9_pii,
    "op10_licenses": op10_licenses,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_url_filters": op13_url_filters,
}

#: DuckDB statements, where SQL can state the result
SQL: dict[str, str] = {
    "op1_suffix_dedup": op01_suffix_dedup.SQL,
    "op2_mixing": op02_mixing.oracle_sql(),
    "op7_ngram_join": op07_ngram_join.SQL,
    "op8_vantage_points": op08_vantage_points.SQL,
    "op9_pii": op09_pii.oracle_sql(),
    "op12_collocations": op12_collocations_.SQL,
    "op13_url_filters": op13_url_filters_.oracle_sql(),
}
