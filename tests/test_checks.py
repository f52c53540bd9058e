import datetime as dt

from pyspark.sql import functions as F

from claimsight.operators.checks import RowRule, dup_key, enum_rule, fused_row_rules, null_check, orphans


def test_dup_key_counts_only_repeated(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    out = {r.k: r.duplicate_count for r in dup_key(df, ["k"], "dup").collect()}
    assert out == {"a": 2, None: 2}


def test_null_check_one_row_per_null_column(spark):
    df = spark.createDataFrame([("1", None, "x"), ("2", None, None), ("3", "y", "z")], "id string, a string, b string")
    rows = sorted((r.row_id, r.failure_reason) for r in null_check(df, "id", ["a", "b"], "t").collect())
    assert rows == [("1", "a NULL"), ("2", "a NULL"), ("2", "b NULL")]


def test_orphans_null_fk_reported_unless_allowed(spark):
    child = spark.createDataFrame([("c1", "p1"), ("c2", "p9"), ("c3", None)], "id string, fk string")
    parent = spark.createDataFrame([("p1",)], "pk string")
    strict = sorted(r.id for r in orphans(child, parent, "fk", "pk", ["id"], "x").collect())
    lenient = sorted(r.id for r in orphans(child, parent, "fk", "pk", ["id"], "x", allow_null=True).collect())
    assert strict == ["c2", "c3"] and lenient == ["c2"]


def test_enum_rule_ignores_null(spark):
    class R:
        t = spark.createDataFrame([("1", "M"), ("2", "X"), ("3", None)], "id string, g string")
    rule = enum_rule("T", "t", "id", "g", ["M", "F"], "bad")
    assert [r.id for r in rule.spark(R).collect()] == ["2"]


def test_fused_rules_match_individual_rules(spark):
    df = spark.createDataFrame([("1", 5, 3), ("2", -1, 4), ("3", 2, 2)], "id string, a int, b int")
    rules = [RowRule("R1", "t", "id", ("a",), "a < 0", "negative"), RowRule("R2", "t", "id", ("a", "b"), "a >= b", "a not below b")]
    fused = sorted((r.test_id, r.row_id) for r in fused_row_rules(df, "t", "id", rules).collect())
    single = sorted((r.test_id, x.id) for r in rules for x in df.filter(F.expr(r.pred)).collect())
    assert fused == single == [("R1", "2"), ("R2", "1"), ("R2", "3")]


def test_rules_with_computed_columns_are_fused_too(spark):
    from claimsight.operators.checks import Suite
    plain = RowRule("R1", "t", "id", ("a",), "a < 0", "negative")
    computed = RowRule("R2", "t", "id", ("a", "b"), "a >= b", "a not below b", extra=(("gap", "a - b", "a - b"),))
    suite = Suite([plain, computed])
    assert suite.row_rules_by_table() == {"t": [plain, computed]}
    df = spark.createDataFrame([("1", 5, 3), ("2", -1, 4)], "id string, a int, b int")
    assert sorted((r.test_id, r.row_id) for r in fused_row_rules(df, "t", "id", suite.rules).collect()) == [("R1", "2"), ("R2", "1")]


def test_orphans_counted_by_kind_of_key(spark):
    """Every rule's orphans from one aggregate, as the rules find them one by one: rows without a key, conditions on both sides, no rows."""
    from types import SimpleNamespace

    from claimsight.operators.checks import DupRule, FkRule, orphan_counts
    rel = SimpleNamespace(
        claims=spark.createDataFrame([("c1", "m1", "paid"), ("c2", "m9", "open"), ("c3", None, "paid"), ("c3", None, "open"), (None, "m1", "open")], "claim_id string, member_id string, status string"),
        members=spark.createDataFrame([("m1",), (None,)], "member_id string"),
        claim_events=spark.createDataFrame([("e1", "c1", "paid"), ("e2", "c2", "paid"), ("e3", "c8", "sent"), ("e4", None, "sent")], "event_id string, claim_id string, kind string"))
    rules = [FkRule("F1", "claims", "member_id", "members", "member_id", ("claim_id",), "x"),
             FkRule("F2", "claims", "member_id", "members", "member_id", ("claim_id",), "x", allow_null=True),
             FkRule("F3", "claim_events", "claim_id", "claims", "claim_id", ("event_id",), "x"),
             FkRule("F4", "claims", "claim_id", "claim_events", "claim_id", ("claim_id",), "x", child_where="status = 'paid'", parent_where="kind = 'paid'"),
             FkRule("F5", "claims", "claim_id", "claim_events", "claim_id", ("claim_id",), "x", parent_where="kind = 'none'")]
    got = {r.test_id: r.violation_count for r in orphan_counts(rel, rules).collect()}
    assert got == {r.test_id: r.spark(rel).count() for r in rules} and got["F1"] == 3 and got["F2"] == 1
    assert DupRule("D1", "claims", ("claim_id",), "x").count(rel).first().violation_count == 1


def test_summary_counts_every_declared_rule(spark, rel):
    from claimsight.operators.quality import SUITE, suite_summary
    got = {(r.test_id, r.table_name): r.violation_count for r in suite_summary(rel).collect()}
    found = {}
    for rule in SUITE.rules:
        if rule.test_id in ("02-T05", "04-T06", "04-T09", "04-T13", "06-T09", "12-T05", "12-T06", "CK11-06", "07-T13"):
            found[rule.test_id, getattr(rule, "child", None) or rule.table] = rule.spark(rel).count()
    assert {k: v for k, v in found.items() if v} == {k: got[k] for k in found if k in got} and len([v for v in found.values() if v]) >= 3
