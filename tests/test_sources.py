import datetime as dt
import os

from pyspark.sql import functions as F

from claimsight.operators.quality import type_conformance
from claimsight.sources.io import export_csv, publish, read_csv, row_counts
from claimsight.sources.schemas import SCHEMAS


def test_csv_round_trip_with_declared_schema(spark, rel, scratch):
    path = os.path.join(scratch, "claims_csv")
    export_csv(rel.claims.drop("_loaded_at"), path)
    back = read_csv(spark, path, "claims")
    # (Spark refuses a query that reads only the corrupt-record column, so select a key too)
    assert back.filter(F.col("_corrupt").isNotNull()).select("claim_id", "_corrupt").collect() == []
    a = {tuple(r) for r in rel.claims.drop("_loaded_at").collect()}
    b = {tuple(r) for r in back.drop("_corrupt").collect()}
    assert a == b


def test_csv_bad_value_lands_in_corrupt_column(spark, scratch):
    path = os.path.join(scratch, "plans.csv")
    with open(path, "w") as f:
        f.write("plan_code,plan_name,plan_tier,annual_limit_kes,inpatient_limit_kes,outpatient_limit_kes,"
                "premium_monthly_kes,is_family_plan\n")
        f.write("A,A cover,basic,100.00,60.00,40.00,5.00,false\n")
        f.write("B,B cover,basic,lots,60.00,40.00,5.00,false\n")
        f.write("C,,basic,100.00,60.00,40.00,5.00,true\n")
    rows = {r.plan_code: r for r in read_csv(spark, path, "plans").collect()}
    assert rows["A"]._corrupt is None and rows["B"]._corrupt is not None and rows["C"].plan_name is None


def test_publish_and_type_conformance(spark, rel):
    msgs = publish(rel.plans, "plan_code")
    assert msgs.columns == ["key", "value"] and msgs.count() == rel.plans.count()
    raw = spark.createDataFrame([("1", "x", "2001-01-01"), ("2", "3", "not a date")], "a string, quantity string, date_of_service string")
    got = {r.column_name: r.bad_values for r in type_conformance(raw, SCHEMAS["claims"], "claims").collect()}
    assert got == {"quantity": 1, "date_of_service": 1}


def test_row_counts_sorted(rel):
    rows = row_counts({"plans": rel.plans, "employers": rel.employers}).collect()
    assert [r.table_name for r in rows] == ["employers", "plans"]
