import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"
SAMPLE = ["dq_07_t14", "dq_15_t03", "dq_15_t04_wide", "dq_12_t02", "gate_checks", "post_load_summary",
          "fraud_f03_same_diagnosis", "upsert_u03_claims", "upsert_u02_members", "mart_m04_dim_members",
          "mart_m07_provider_analytics", "feat_x01_x11_claim_features", "feat_x08_provider_fraud_history",
          "train_x17_metrics", "report_q02_approval_trend", "stream_r05_provider_bursts_low"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "total_claimed" in df.columns


def test_registry_contract():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) > 200


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(ocols, res.fetchall())[0]
