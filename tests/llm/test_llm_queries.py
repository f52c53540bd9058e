"""The registered queries against DuckDB, and the pipeline's stages against plain versions."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimsight.llm.common import table
from claimsight.llm.queries import QUERIES, SQL
from tests.llm.test_llm_operators import plain_components, plain_pii, words
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_join", "pii", "mixing", "byte_bpe"]
    before = [(r["doc_id"], r["text"]) for r in docs.collect()]

    clean = stages["toxicity"](spark, docs, SF)
    kept = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert clean.columns == docs.columns
    assert sum(i in kept for i, _ in before if labels.get(i) == 0) >= 0.97 * sum(labels.get(i) == 0 for i, _ in before)

    one = stages["ngram_join"](spark, docs, SF)
    assert one.columns == docs.columns
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == {c for _, _, c in plain_components(before)}

    red = {r["doc_id"]: r for r in stages["pii"](spark, docs, SF).collect()}
    for i, t in before:
        assert red[i]["n_chars"] == len(red[i]["text"])
        assert (red[i]["text"] == t) or any(plain_pii(t).values()) or "<TEL>" in red[i]["text"] or "<IBAN>" in red[i]["text"]
        assert not any(plain_pii(red[i]["text"])[k] for k in ("email", "ip"))

    mixed = stages["mixing"](spark, docs, SF)
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == docs.columns and max(times.values()) <= 3
    total = sum(len(words(t)) for _, t in before)
    assert abs(sum(times.get(i, 0) * len(words(t)) for i, t in before) - total) < 0.25 * total

    ids = stages["byte_bpe"](spark, docs, SF)
    import hashlib
    assert {r["doc_id"]: r["decoded_sha256"] for r in ids.collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in before}


def test_pipeline_rejects_toxic_documents_of_a_small_table(spark):
    docs = table(spark, SF, "documents")
    toxic = {r["doc_id"] for r in table(spark, SF, "labels").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, SF).select("doc_id").collect()}
    # 4 of the 11 hold no word that other toxic documents have
    assert len(toxic) == 11 and len(toxic - kept) >= 7


def test_pipeline_runs_and_reruns_agree(spark):
    a = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").groupBy("doc_id", "ids_sha256").count()
    b = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").groupBy("doc_id", "ids_sha256").count()
    assert a.count() > 0 and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_pipeline_takes_no_rows_and_extra_columns(spark):
    docs = table(spark, SF, "documents").limit(0)
    wide = table(spark, SF, "documents").withColumns({"size": F.lit(1), "taken": F.lit(2), "score": F.lit(0.1), "n_words": F.lit(1), "findings": F.lit("x")})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
        if name in ("toxicity", "mixing"):
            assert stage(spark, wide, SF).columns == wide.columns
