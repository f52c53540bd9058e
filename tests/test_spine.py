"""The claim spine: written once for queries with several branches over claims, with the same rows."""

import re

import pytest

from claimsight.operators.gate import gate_checks
from claimsight.operators.quality import SUITE, run_suite
from claimsight.plans.features import claim_features
from claimsight.sources.mapping import SPINE_RELATIONS, Relations, stored_spine

SF = "/root/testdata/sf0.001"


def joins_of_lineitem(df):
    """How often the plan reads lineitem's prices, which only the claim spine needs."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"Relation \[[^\]]*l_extendedprice[^\]]*\] parquet", plan)), len(re.findall(r"Join Inner, \(l_orderkey", plan))


@pytest.mark.parametrize("name", sorted(SPINE_RELATIONS))
def test_same_rows(spark, name):
    rel = Relations(spark, SF)
    a, b = getattr(rel, name), getattr(stored_spine(rel), name)
    assert a.schema.simpleString() == b.schema.simpleString() and a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_stored_once(spark):
    once = stored_spine(Relations(spark, SF))
    assert stored_spine(once) is once and stored_spine(other := object()) is other


@pytest.mark.parametrize("build", [run_suite, gate_checks, claim_features, next(r for r in SUITE.rules if r.test_id == "CK10").spark],
                         ids=["dq_suite_row_rules", "gate_checks", "feat_x01_x11_claim_features", "dq_ck10"])
def test_branches_do_not_join_again(spark, build):
    assert joins_of_lineitem(Relations(spark, SF).claims)[1] == 1     # what a branch costs without the stored spine
    assert joins_of_lineitem(build(Relations(spark, SF)))[1] == 0
