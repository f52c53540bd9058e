"""Claim relations derived from the benchmark tables.

The benchmark ships TPC-H style tables; the claims platform needs its 17 raw
relations.  Each relation below is a lazy DataFrame whose columns are pure
expressions of the benchmark columns (integer and day arithmetic only, no
randomness), so every query that uses them scales with the input and the
oracle can state the same relation in SQL.

Layout at scale: ``claims`` is ``lineitem JOIN orders`` on the order key - one
sort-merge join whose two sides are both hash-partitioned on ``l_orderkey``.
Everything that derives from claims (events, vitals, prescriptions, payments,
predictions, cases) is a projection / generate over that same join, so no
further shuffle is needed to build them.  Branches that read different columns
of that join each run it again (their exchanges differ); a query with several
such branches calls :func:`stored_spine`, which writes the join once and lets
every branch scan it.  Dimension relations (plans,
employers, providers, icd10) come from small tables and are joined by the
planner (broadcast only when the measured size is under the threshold).

Planted violations (the ``% n`` terms) give every quality rule rows to find.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .tables import read_table


def _i(n) -> Column:
    return F.lit(n) if not isinstance(n, Column) else n


def ts_add(ts: Column, days=0, hours=0, minutes=0) -> Column:
    """timestamp + day-time interval (works for TIMESTAMP_NTZ)."""
    return ts + F.make_dt_interval(_i(days).cast("int"), _i(hours).cast("int"),
                                   _i(minutes).cast("int"), F.lit(0))


def _lpad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Relations:
    """Lazy claim relations over one benchmark directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.spine_stored = False
        self.spine_dealt = False

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ claims
    @cached_property
    def claim_rows(self) -> DataFrame:
        """lineitem joined to orders: the columns that claims and their dependents derive from."""
        li = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        od = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        # broadcast orders would leave the rows where they were read
        od = od.hint("merge") if self.spine_dealt else od
        return li.join(od, li.l_orderkey == od.o_orderkey, "inner").drop("o_orderkey")

    @cached_property
    def claim_full(self) -> DataFrame:
        """Claims plus the helper keys (k_*) the dependent relations derive from."""
        flag = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
        status = (F.when(flag == "NO", "submitted").when(flag == "NF", "approved")
                  .when(flag == "AF", "paid").when(flag == "AO", "pending_review")
                  .when(flag == "RF", "rejected").otherwise("flagged_fraud"))
        price = F.col("l_extendedprice").cast("decimal(15,2)")
        approved = (
            F.when(flag.isin("NF", "AF"),
                   F.round(price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(15,2)"))
            .when(F.col("l_orderkey") % 89 == 0,
                  F.round(price * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)")), 2).cast("decimal(15,2)")))
        pm = F.col("l_partkey") % 50
        dos = F.to_date("o_orderdate")
        base = self.claim_rows.select(
            F.col("l_orderkey").alias("k_order"), F.col("l_partkey").alias("k_part"),
            F.col("l_suppkey").alias("k_supp"), F.col("l_linenumber").alias("k_line"),
            F.col("l_quantity").alias("k_qty"), F.col("o_custkey").alias("k_cust"),
            F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
                        F.date_format("l_shipdate", "yyyyMMdd")).alias("claim_id"),
            _s("o_custkey").alias("member_id"),
            _s("l_suppkey").alias("provider_id"),
            dos.alias("date_of_service"),
            F.date_add(dos, (F.col("l_linenumber") * 15).cast("int")).alias("date_submitted"),
            F.concat(F.when(pm < 20, "CONS-").when(pm < 35, "LAB-").otherwise("PROC-"), _lpad2(pm)).alias("procedure_code"),
            F.concat(F.lit("DX"), _lpad2(F.col("l_partkey") % 25)).alias("diagnosis_code"),
            F.col("l_quantity").cast("int").alias("quantity"),
            price.alias("amount_claimed"),
            approved.alias("amount_approved"),
            status.alias("status"),
            F.element_at(F.array(*[F.lit(c) for c in ("portal", "mobile", "api", "paper")]),
                         (F.col("l_linenumber") % 4 + 1).cast("int")).alias("submission_channel"),
            (F.col("o_orderpriority") == "1-URGENT").alias("is_emergency"),
            F.when((F.col("l_extendedprice") > 50000) & (F.col("l_orderkey") % 3 != 0),
                   F.concat(F.lit("PA-"), _s("l_orderkey"))).alias("prior_auth_number"),
        )
        sub = ts_add(F.col("date_submitted").cast("timestamp_ntz"),
                     hours=F.col("k_order") % 24, minutes=F.col("k_part") % 60)
        base = base.withColumn("submitted_at", sub)
        upd = (F.when(F.col("k_order") % 83 == 0, ts_add(F.col("submitted_at"), hours=-1))
               .when(F.col("status") == "submitted", F.col("submitted_at"))
               .otherwise(ts_add(F.col("submitted_at"), days=F.col("k_line") * 2)))
        return base.withColumn("updated_at", upd)

    CLAIM_COLUMNS = ["claim_id", "member_id", "provider_id", "date_of_service", "date_submitted",
                     "procedure_code", "diagnosis_code", "quantity", "amount_claimed",
                     "amount_approved", "status", "submission_channel", "is_emergency",
                     "prior_auth_number", "submitted_at", "updated_at"]

    @cached_property
    def claims_dealt(self) -> DataFrame:
        """Claims with the order key that their rows are dealt by."""
        return self.claim_full.select(*self.CLAIM_COLUMNS,
                                      ts_add(F.col("updated_at"), hours=1).alias("_loaded_at"), "k_order")

    @cached_property
    def claims(self) -> DataFrame:
        return self.claims_dealt.drop("k_order")

    # -------------------------------------------------------------- dimensions
    @cached_property
    def plans(self) -> DataFrame:
        seg = F.col("plan_code")
        tier = (F.when(seg == "AUTOMOBILE", "basic").when(seg == "BUILDING", "corporate")
                .when(seg == "FURNITURE", "family").when(seg == "HOUSEHOLD", "premium")
                .otherwise("standard"))
        r = (F.when(seg == "AUTOMOBILE", 1).when(seg == "BUILDING", 2).when(seg == "FURNITURE", 3)
             .when(seg == "HOUSEHOLD", 4).otherwise(5))
        d = (self.table("customer").select(F.col("c_mktsegment").alias("plan_code")).distinct()
             .select("plan_code", F.concat(seg, F.lit(" cover")).alias("plan_name"),
                     tier.alias("plan_tier"), r.alias("r")))
        return d.select(
            "plan_code", "plan_name", "plan_tier",
            (F.lit(100000) * (F.col("r") + 1)).cast("decimal(15,2)").alias("annual_limit_kes"),
            (F.lit(60000) * (F.col("r") + 1)).cast("decimal(15,2)").alias("inpatient_limit_kes"),
            (F.when(F.col("plan_tier") == "standard", 50000).otherwise(40000) * (F.col("r") + 1))
            .cast("decimal(15,2)").alias("outpatient_limit_kes"),
            (F.lit(500) * F.col("r")).cast("decimal(15,2)").alias("premium_monthly_kes"),
            (F.col("plan_tier") == "family").alias("is_family_plan"),
            F.lit("2001-08-02 04:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    @cached_property
    def employers(self) -> DataFrame:
        n = self.table("nation")
        k = F.col("n_nationkey")
        start = F.date_add(F.lit("1994-01-01").cast("date"), (k * 30).cast("int"))
        return n.select(
            _s(k).alias("employer_id"), F.concat(F.col("n_name"), F.lit(" Holdings")).alias("employer_name"),
            F.concat(F.lit("sector "), _s("n_regionkey")).alias("industry"), F.col("n_name").alias("county"),
            (k * 10).cast("int").alias("member_count"),
            start.alias("contract_start"),
            F.when(k % 6 == 0, F.date_add(F.lit("1994-01-01").cast("date"), (k * 30 - 1).cast("int")))
            .when(k % 4 == 1, F.lit("2003-12-31").cast("date")).alias("contract_end"),
            (k % 8 != 0).alias("is_active"),
            F.lit("2001-08-02 03:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    @cached_property
    def members(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        n = self.table("nation").select("n_nationkey", "n_name")
        j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        k = F.col("c_custkey")
        enrol = F.date_add(F.lit("1994-01-01").cast("date"), (k % 900).cast("int"))
        id_type = F.element_at(F.array(*[F.lit(v) for v in ("National ID", "Passport", "Alien ID", "Military ID")]),
                               (k % 4 + 1).cast("int"))
        return j.select(
            _s(k).alias("member_id"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(k % 250 == 0, F.lit("1870-05-05").cast("date"))
            .otherwise(F.date_add(F.lit("1940-01-01").cast("date"), (k * 37 % 25000).cast("int"))).alias("date_of_birth"),
            F.when(k % 97 == 0, "U").when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.when(k % 113 == 0, "Staff Card").otherwise(id_type).alias("id_type"),
            F.when(k % 151 == 0, "00000000").when(k % 157 == 0, "TEST")
            .otherwise(F.lpad(_s(k * 7919 % 100000000), 8, "0")).alias("id_number"),
            F.when(k % 4 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("+2547"), F.lpad(_s(k % 100000000), 8, "0"))).alias("phone_number"),
            F.col("n_name").alias("county"),
            F.lit(None).cast("string").alias("sub_county"),
            enrol.alias("enrol_date"),
            F.when(k % 350 == 0, enrol).when(k % 7 == 0, F.date_add(enrol, 1500)).alias("term_date"),
            F.col("c_mktsegment").alias("plan_code"),
            F.when(k % 211 == 0, "99").when(k % 10 < 3, _s("c_nationkey")).alias("employer_id"),
            (k % 7 != 0).alias("is_active"),
            F.lit("2001-08-02 05:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    @cached_property
    def providers(self) -> DataFrame:
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name")
        j = s.join(n, s.s_nationkey == n.n_nationkey, "inner")
        k = F.col("s_suppkey")
        start = F.date_add(F.lit("1994-01-01").cast("date"), (k % 365).cast("int"))
        acc = (F.when(k % 20 == 0, "Suspended").when(k % 20 == 1, "Terminated")
               .when(k % 20 == 2, "Probation").otherwise("Active"))
        return j.select(
            _s(k).alias("provider_id"), F.col("s_name").alias("provider_name"),
            F.concat(F.lit("Level "), _s(1 + k % 6)).alias("facility_type"),
            F.col("n_name").alias("county"), F.lit(None).cast("string").alias("sub_county"),
            F.concat(F.lit("LIC-"), _s(k)).alias("license_number"),
            acc.alias("accreditation_status"),
            (100 + k % 400).cast("int").alias("panel_capacity"),
            F.when(k % 47 == 0, F.lit("2002-01-01").cast("date")).otherwise(start).alias("contract_start_date"),
            F.when(k % 9 == 0, start).alias("contract_end_date"),
            ((k * 13 % 1100) / F.lit(1000).cast("decimal(4,0)")).cast("decimal(4,3)").alias("risk_score"),
            F.lit("2001-08-01 23:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    @cached_property
    def drug_formulary(self) -> DataFrame:
        p = self.table("part")
        cost = F.col("p_retailprice").cast("decimal(10,2)")
        return p.select(
            _s("p_partkey").alias("drug_code"), F.col("p_name").alias("drug_name"),
            F.col("p_type").alias("drug_class"),
            (F.col("p_size") % 2 == 0).alias("is_essential_medicine"),
            (F.col("p_size") == 1).alias("is_controlled_substance"),
            F.when(F.col("p_partkey") % 199 == 0, -cost).otherwise(cost).alias("unit_cost_kes"),
            F.lit("2001-07-20 00:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    @cached_property
    def icd10_codes(self) -> DataFrame:
        g = F.col("g")
        cat = F.element_at(F.array(*[F.lit(v) for v in
                                     ("Respiratory", "Gastrointestinal", "Injury", "Cardiovascular", "Other")]),
                           (g % 5 + 1).cast("int"))
        d = (self.table("part").select((F.col("p_partkey") % 25).alias("g"))
             .filter(F.col("g") != 24).distinct())
        return d.select(
            F.concat(F.lit("DX"), _lpad2(g)).alias("icd10_code"),
            F.concat(F.lit("Diagnosis group "), _s(g)).alias("description"),
            cat.alias("clinical_category"),
            F.lit("2001-08-02 01:00:00").cast("timestamp_ntz").alias("_loaded_at"))

    # ------------------------------------------------------- claim dependents
    @cached_property
    def vitals(self) -> DataFrame:
        return self.vitals_dealt.drop("k_order")

    @cached_property
    def vitals_dealt(self) -> DataFrame:
        """Vitals with the order key that their rows are dealt by."""
        c = self.claim_full.filter(F.col("procedure_code").startswith("CONS")
                                   & ((F.col("k_order") + F.col("k_part")) % 10 != 0))
        o, p, q = F.col("k_order"), F.col("k_part"), F.col("k_qty")
        h = 150 + p % 40
        hundredths = F.expr("cast(40 + k_qty as bigint) * 1000000 div ((150 + k_part % 40) * (150 + k_part % 40))") \
            + F.when(o % 23 == 0, 500).otherwise(0)
        return c.select(
            F.concat(F.lit("V-"), F.col("claim_id")).alias("vitals_id"), "claim_id",
            F.when(o % 101 == 0, _s(F.col("k_cust") + 1)).otherwise(F.col("member_id")).alias("member_id"),
            F.date_add(F.col("date_of_service"), F.when(o % 19 == 0, 3).otherwise(0)).alias("date_taken"),
            (100 + q).cast("smallint").alias("systolic_bp"),
            (55 + 2 * q).cast("smallint").alias("diastolic_bp"),
            F.when(o % 97 == 0, 310).otherwise(50 + 2 * q).cast("smallint").alias("heart_rate"),
            F.when(o % 31 == 0, F.lit(98.6).cast("decimal(4,1)"))
            .otherwise(((360 + p % 20) / F.lit(10).cast("decimal(3,0)")).cast("decimal(4,1)")).alias("temperature_c"),
            (40 + q).cast("decimal(5,1)").alias("weight_kg"),
            h.cast("decimal(5,1)").alias("height_cm"),
            (hundredths / F.lit(100).cast("decimal(3,0)")).cast("decimal(5,2)").alias("bmi"),
            (100 - q.cast("int") % 15).cast("smallint").alias("spo2_pct"),
            F.lit(None).cast("string").alias("notes"),
            ts_add(F.date_add(F.col("date_of_service"), F.when(o % 19 == 0, 3).otherwise(0)).cast("timestamp_ntz"),
                   hours=12).alias("_loaded_at"), "k_order")

    @cached_property
    def prescriptions(self) -> DataFrame:
        return self.prescriptions_dealt.drop("k_order")

    @cached_property
    def prescriptions_dealt(self) -> DataFrame:
        """Prescriptions with the order key that their rows are dealt by."""
        c = self.claim_full.filter(~F.col("procedure_code").startswith("LAB")
                                   & ((F.col("k_order") + F.col("k_supp")) % 7 != 0))
        o, p, ln = F.col("k_order"), F.col("k_part"), F.col("k_line")
        dts = F.col("date_of_service").cast("timestamp_ntz")
        presc = F.when(o % 41 == 0, ts_add(dts, days=-2)).otherwise(ts_add(dts, hours=10))
        freq = F.element_at(F.array(F.lit("once daily"), F.lit("twice daily"), F.lit("three times daily")),
                            (ln % 3 + 1).cast("int"))
        return c.select(
            F.concat(F.lit("RX-"), F.col("claim_id")).alias("prescription_id"), "claim_id",
            F.when(o % 103 == 0, _s(F.col("k_cust") + 1)).otherwise(F.col("member_id")).alias("member_id"),
            F.when(o % 37 == 0, F.concat(F.lit("X"), _s(p))).otherwise(_s(p)).alias("drug_code"),
            F.lit("1 tablet").alias("dosage"), freq.alias("frequency"),
            (3 + p % 40).cast("int").alias("duration_days"),
            F.col("k_qty").cast("int").alias("quantity_dispensed"),
            (ln % 2 == 1).alias("dispensed_on_site"),
            presc.alias("prescribed_at"),
            ts_add(presc, hours=1).alias("_loaded_at"), "k_order")

    @cached_property
    def payments(self) -> DataFrame:
        return self.payments_dealt.drop("k_order")

    @cached_property
    def payments_dealt(self) -> DataFrame:
        """Payments with the order key that their rows are dealt by."""
        o, p = F.col("k_order"), F.col("k_part")
        st = F.col("status")
        c = self.claim_full.filter((st.isin("approved", "paid") & (o % 11 != 0))
                                   | ((st == "rejected") & (o % 47 == 0)))
        amt = (F.coalesce(F.col("amount_approved"), F.col("amount_claimed"))
               * F.when(o % 97 == 0, 2).otherwise(1)).cast("decimal(15,2)")
        method = F.element_at(F.array(*[F.lit(v) for v in ("EFT", "MPESA", "Cheque", "Cash")]), (p % 4 + 1).cast("int"))
        paid = F.when(o % 43 == 0, ts_add(F.col("submitted_at"), days=-1)).otherwise(ts_add(F.col("updated_at"), days=1))
        return c.select(
            F.concat(F.lit("PAY-"), F.col("claim_id")).alias("payment_id"), "claim_id",
            amt.alias("amount_paid_kes"), method.alias("payment_method"),
            F.concat(F.lit("REF-"), _s(o), F.lit("-"), _s("k_line")).alias("reference_number"),
            paid.alias("paid_at"), paid.alias("_loaded_at"), "k_order")

    @cached_property
    def stock_levels(self) -> DataFrame:
        li = self.table("lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_quantity")
        g = (li.groupBy("l_suppkey", (F.col("l_partkey") % 50).alias("drug"), "l_shipdate")
             .agg(F.sum("l_quantity").alias("q")))
        return g.select(
            F.concat(F.lit("ST-"), _s("l_suppkey"), F.lit("-"), _s("drug"), F.lit("-"),
                     F.date_format("l_shipdate", "yyyyMMdd")).alias("stock_id"),
            _s("l_suppkey").alias("facility_id"), _s("drug").alias("drug_code"),
            F.to_date("l_shipdate").alias("reported_date"),
            F.col("q").cast("int").alias("quantity_on_hand"),
            F.lit(20).alias("reorder_level"),
            ts_add(F.to_date("l_shipdate").cast("timestamp_ntz"), hours=18).alias("_loaded_at"))

    @cached_property
    def pred_full(self) -> DataFrame:
        o, p, s = F.col("k_order"), F.col("k_part"), F.col("k_supp")
        # one row per (claim, model version): version 2.1 scored line 1 only
        versions = F.filter(F.array(F.lit("v1.0"), F.when(F.col("k_line") == 1, F.lit("v2.1"))),
                            lambda v: v.isNotNull())
        c = self.claim_full.select("k_order", "k_part", "k_supp", "k_line", "k_qty", "claim_id",
                                   "submitted_at", "amount_claimed",
                                   F.explode(versions).alias("model_version"))
        kp = F.when(F.col("model_version") == "v1.0", (o * 31 + p * 17 + s * 7) % 1000) \
            .otherwise((o * 13 + p * 7 + s * 3) % 1000)
        c = c.withColumn("k_prob", kp)
        k = F.col("k_prob")
        tier = (F.when(p % 50 == 0, "low").when(k >= 800, "critical").when(k >= 600, "high")
                .when(k >= 300, "medium").otherwise("low"))
        snap = F.when(o % 59 == 0, F.concat(F.lit("["), _s("k_line"), F.lit("]"))) \
            .otherwise(F.concat(F.lit('{"qty": '), _s(F.col("k_qty").cast("int")),
                                F.lit(', "line": '), _s("k_line"), F.lit("}")))
        pred_at = F.when(o % 61 == 0, ts_add(F.col("submitted_at"), hours=-1)) \
            .otherwise(ts_add(F.col("submitted_at"), minutes=p % 90))
        return c.select(
            F.concat(F.lit("P-"), F.col("model_version"), F.lit("-"), F.col("claim_id")).alias("prediction_id"),
            "claim_id", "model_version",
            (k / F.lit(1000).cast("decimal(4,0)")).cast("decimal(6,5)").alias("fraud_probability"),
            tier.alias("risk_tier"), snap.alias("feature_snapshot"), pred_at.alias("predicted_at"),
            "k_order", "k_part", "k_supp", "k_prob", "amount_claimed")

    @cached_property
    def fraud_predictions_dealt(self) -> DataFrame:
        """Predictions with the order key that their rows are dealt by."""
        return self.pred_full.select("prediction_id", "claim_id", "model_version", "fraud_probability",
                                     "risk_tier", "feature_snapshot", "predicted_at",
                                     F.col("predicted_at").alias("_loaded_at"), "k_order")

    @cached_property
    def fraud_predictions(self) -> DataFrame:
        return self.fraud_predictions_dealt.drop("k_order")

    @cached_property
    def inv_full(self) -> DataFrame:
        o, p, s, k = F.col("k_order"), F.col("k_part"), F.col("k_supp"), F.col("k_prob")
        c = self.pred_full.filter(k > 800)
        status = F.when(o % 2 == 0, "closed").otherwise(
            F.element_at(F.array(F.lit("open"), F.lit("in_progress"), F.lit("escalated")), (p % 3 + 1).cast("int")))
        opened = ts_add(F.col("predicted_at"), days=1)
        inv = c.select(
            F.concat(F.lit("INV-"), F.col("prediction_id")).alias("investigation_id"), "claim_id",
            F.when(o % 67 == 0, F.concat(F.col("prediction_id"), F.lit("-x"))).otherwise(F.col("prediction_id")).alias("prediction_id"),
            F.concat(F.lit("investigator_"), _s(s % 5)).alias("assigned_to"),
            opened.alias("opened_at"), status.alias("status"),
            F.when(k >= 950, "critical").when(k >= 900, "high").otherwise("medium").alias("priority"),
            F.lit(None).cast("string").alias("notes"),
            "k_order", "k_part", "k_supp", "amount_claimed")
        closed = (F.when(F.col("status") != "closed", F.lit(None).cast("timestamp_ntz"))
                  .when(o % 71 == 0, ts_add(F.col("opened_at"), hours=-1))
                  .otherwise(ts_add(F.col("opened_at"), days=5 + p % 30)))
        return inv.withColumn("closed_at", closed)

    @cached_property
    def fraud_investigations(self) -> DataFrame:
        return self.fraud_investigations_dealt.drop("k_order")

    @cached_property
    def fraud_investigations_dealt(self) -> DataFrame:
        """Cases with the order key that their rows are dealt by."""
        return self.inv_full.select("investigation_id", "claim_id", "prediction_id", "assigned_to",
                                    "opened_at", "closed_at", "status", "priority", "notes",
                                    F.coalesce("closed_at", "opened_at").alias("_loaded_at"), "k_order")

    @cached_property
    def fraud_investigation_outcomes(self) -> DataFrame:
        return self.fraud_investigation_outcomes_dealt.drop("k_order")

    @cached_property
    def fraud_investigation_outcomes_dealt(self) -> DataFrame:
        """Outcomes with the order key that their rows are dealt by."""
        o, p, s = F.col("k_order"), F.col("k_part"), F.col("k_supp")
        st = F.col("status")
        c = self.inv_full.filter(((st == "closed") & (o % 10 != 4)) | ((st != "closed") & (o % 9 == 0)))
        label = F.element_at(F.array(F.lit("confirmed_fraud"), F.lit("legitimate"), F.lit("inconclusive")),
                             (p % 3 + 1).cast("int"))
        c = c.withColumn("final_label", label)
        lab = F.col("final_label")
        ftype = F.element_at(F.array(*[F.lit(v) for v in
                                       ("phantom_billing", "threshold_manip", "benefit_sharing", "duplicate_claim", "other")]),
                             (s % 5 + 1).cast("int"))
        fraud_type = (F.when((lab == "confirmed_fraud") & (s % 7 == 0), F.lit(None).cast("string"))
                      .when(lab == "confirmed_fraud", ftype)
                      .when((lab == "legitimate") & (s % 11 == 0), "other"))
        conf = F.coalesce(F.col("closed_at"), ts_add(F.col("opened_at"), days=3))
        amt = F.col("amount_claimed")
        recovered = (F.when(lab != "confirmed_fraud", F.lit(None).cast("decimal(15,2)"))
                     .when(o % 79 == 0, (amt + 100).cast("decimal(15,2)"))
                     .otherwise(F.round(amt * F.lit(0.5).cast("decimal(2,1)"), 2).cast("decimal(15,2)")))
        return c.select(
            F.concat(F.lit("OUT-"), F.col("investigation_id")).alias("outcome_id"),
            F.when(o % 73 == 0, F.concat(F.col("claim_id"), F.lit("-x"))).otherwise(F.col("claim_id")).alias("claim_id"),
            "investigation_id", "final_label", fraud_type.alias("fraud_type"),
            F.concat(F.lit("investigator_"), _s(s % 5)).alias("confirmed_by"),
            conf.alias("confirmed_at"),
            F.when(lab == "confirmed_fraud", amt).alias("estimated_loss_kes"),
            recovered.alias("amount_recovered_kes"),
            F.lit(None).cast("string").alias("notes"),
            conf.alias("_loaded_at"), "k_order")

    @cached_property
    def model_performance_log(self) -> DataFrame:
        g = (self.pred_full.groupBy("model_version", F.year("predicted_at").alias("y"))
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("risk_tier").isin("high", "critical")).alias("n_hi"),
                  F.sum("k_prob").alias("s_prob"),
                  F.count_if(F.col("risk_tier") == "critical").alias("n_crit")))
        y = F.col("y")
        thousand = F.lit(1000).cast("decimal(4,0)")

        def frac(num):
            return (num / thousand).cast("decimal(6,5)")

        promoted = y % 2 == 0
        return g.select(
            F.concat(F.col("model_version"), F.lit("-"), _s(y)).alias("log_id"), "model_version",
            F.make_date(y, F.lit(12), F.lit(31)).alias("evaluation_date"),
            F.col("n").cast("int").alias("training_claim_count"),
            F.col("n_hi").cast("int").alias("training_fraud_count"),
            frac(F.expr("s_prob div n")).alias("auc_roc"),
            frac(F.expr("n_crit * 1000 div n")).alias("precision_at_10pct"),
            frac(F.expr("n_hi * 1000 div n")).alias("recall"),
            F.lit(None).cast("decimal(6,5)").alias("f1_score"),
            promoted.alias("promoted"),
            F.when(promoted & (y % 4 != 0), "auc gain over champion").alias("promotion_reason"),
            F.when(promoted, F.concat(F.lit("models/"), F.col("model_version"), F.lit("/"), _s(y))).alias("s3_artefact_path"),
            F.make_timestamp_ntz(y, F.lit(12), F.lit(31), F.lit(6), F.lit(0), F.lit(0)).alias("logged_at"))

    @cached_property
    def dlq_events(self) -> DataFrame:
        e = self.table("events").select("event_id", "ts", "user_id", "event_type", "props") \
            .filter(F.col("event_type") == "error")
        i, u = F.col("event_id"), F.col("user_id")
        topic = F.element_at(F.array(*[F.lit(v) for v in
                                       ("claims", "claim_events", "vitals", "prescriptions", "payments")]),
                             (u % 5 + 1).cast("int"))
        return e.select(
            F.concat(F.lit("DLQ-"), _s(i)).alias("dlq_id"), topic.alias("source_topic"),
            F.col("ts").alias("failed_at"), F.concat(F.lit("E"), _s(u % 3)).alias("error_code"),
            F.lit("schema mismatch").alias("error_message"), F.col("props").alias("raw_payload"),
            (i % 4).cast("smallint").alias("retry_count"),
            (i % 2 == 0).alias("resolved"),
            F.when((i % 2 == 0) & (i % 10 != 0), ts_add(F.col("ts"), hours=1))
            .when((i % 2 == 1) & (i % 15 == 1), ts_add(F.col("ts"), hours=2)).alias("resolved_at"),
            F.col("ts").alias("_loaded_at"))

    @cached_property
    def claim_events(self) -> DataFrame:
        return self.claim_events_dealt.drop("k_order")

    @cached_property
    def claim_events_dealt(self) -> DataFrame:
        """Event log as one generate over the claim rows (no union of scans), with the order key that they are dealt by."""
        o, st = F.col("k_order"), F.col("status")
        keep = o % 101 != 0
        upd, sub = F.col("updated_at"), F.col("submitted_at")

        def ev(cond, seq, etype, prev, new, at, actor):
            return F.when(cond, F.struct(
                F.concat(F.col("claim_id"), F.lit(f"-e{seq}")).alias("event_id"),
                F.lit(etype).alias("event_type") if isinstance(etype, str) else etype.alias("event_type"),
                (F.lit(prev) if isinstance(prev, (str, type(None))) else prev).cast("string").alias("previous_status"),
                (F.lit(new) if isinstance(new, str) else new).alias("new_status"),
                at.alias("event_at"),
                (F.lit(actor) if isinstance(actor, str) else actor).alias("triggered_by")))

        terminal_type = (F.when(st.isin("approved", "paid"), "approved")
                         .when(st == "pending_review", "status_changed")
                         .when(st == "rejected", "rejected").otherwise("flagged"))
        terminal_actor = (F.when(st.isin("approved", "paid"), "auto_approve")
                          .when(st == "pending_review", "airflow").otherwise("investigator"))
        paid_ok = keep & (st == "paid") & (o % 13 != 0)
        events = F.array(
            ev(keep, 1, "submitted", None, "submitted", sub,
               F.when(F.col("submission_channel") == "api", "api").otherwise("system")),
            ev(keep & (st != "submitted") & ~((st == "flagged_fraud") & (o % 17 == 0)), 2,
               terminal_type, "submitted", F.when(st == "paid", "approved").otherwise(st),
               F.when(st == "paid", ts_add(upd, days=-1)).otherwise(upd), terminal_actor),
            ev(paid_ok, 3, "paid", "approved", "paid", upd, "system"),
            ev(paid_ok & (o % 29 == 0), 4, "paid", "approved", "paid", upd, "system"),
            ev(keep & (st == "rejected"), 5, "closed", "rejected", "closed", ts_add(upd, days=1), "system"),
            ev(keep & (st == "rejected") & (o % 7 == 0), 6, "appealed", "closed", "closed", ts_add(upd, days=2), "api"),
        )
        x = self.claim_full.select("claim_id", "k_order", F.inline(F.filter(events, lambda e: e.isNotNull())))
        return x.select(
            "event_id", "claim_id", "event_type", "previous_status", "new_status", "event_at", "triggered_by",
            F.concat(F.lit('{"source": "'), F.col("triggered_by"), F.lit('"}')).alias("metadata"),
            ts_add(F.col("event_at"), minutes=5).alias("_loaded_at"), "k_order")


RELATION_NAMES = ["claims", "plans", "employers", "members", "providers", "drug_formulary", "icd10_codes",
                  "claim_events", "vitals", "prescriptions", "payments", "stock_levels", "fraud_predictions",
                  "fraud_investigations", "fraud_investigation_outcomes", "model_performance_log", "dlq_events"]


#: relations that derive from the claim spine
SPINE_RELATIONS = frozenset(("claims", "claim_events", "vitals", "prescriptions", "payments", "fraud_predictions",
                             "fraud_investigations", "fraud_investigation_outcomes", "model_performance_log"))
#: those whose rows know the order key (:func:`dealt`), and ids that hold it whole
DEALT_RELATIONS = SPINE_RELATIONS - {"model_performance_log"}
DEALT_IDS = frozenset(("claim_id", "prediction_id", "investigation_id", "reference_number"))


def stored_spine(rel, by: Column | None = None):
    """``rel`` with the claim spine (lineitem joined to orders, the 14 columns
    that claims derive from) written once to a new folder of the shared
    checkpoint directory and read back, so each further branch over claims or
    their dependents is a scan instead of another shuffled join.  With ``by`` the
    rows of one value of it lie together, in one file or a few.  Relations of
    another kind (stored ones, or with a stored spine already) come back as they are."""
    if not isinstance(rel, Relations) or rel.spine_stored:
        return rel
    path = f"{checkpoint_dir(rel.spark)}/spine-{uuid.uuid4().hex}"
    rows = rel.claim_rows
    dealt = rows if by is None else rows.withColumn("_by", by).hint("rebalance", "_by").drop("_by")
    dealt.write.option("compression", "zstd").parquet(path)
    out = Relations(rel.spark, rel.sf_dir)
    out.__dict__["claim_rows"] = rel.spark.read.schema(rows.schema).parquet(path)
    out.spine_stored = True
    return out


def dealt_spine(rel):
    """:func:`stored_spine` in buckets of the order key: branches that are dealt by it (:func:`dealt`) meet
    where they were read, without a shuffle.  The table's name is dropped, its files stay."""
    if not isinstance(rel, Relations) or rel.spine_stored:
        return rel
    spark, name = rel.spark, f"spine_{uuid.uuid4().hex}"
    out = Relations(spark, rel.sf_dir)
    out.spine_dealt = True
    (out.claim_rows.write.format("parquet").option("compression", "zstd").option("path", f"{checkpoint_dir(spark)}/{name}")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey").saveAsTable(name))
    out.__dict__["claim_rows"] = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    out.spine_stored = True
    return out


def dealt(rel, *names: str) -> tuple[list[DataFrame], tuple[str, ...]]:
    """Relations of the claim spine, and the columns that their rows are dealt by.

    Ids of claims, events and predictions hold the order key whole, so grouping by the order key and
    the id is the same as by the id, and leaves the rows where the spine's join put them, or where
    :func:`dealt_spine` stored them.  Other kinds of relations (stored ones, or with a stored spine
    of another kind) are dealt by nothing.
    """
    if not isinstance(rel, Relations) or rel.spine_stored and not rel.spine_dealt:
        return [getattr(rel, n) for n in names], ()
    out = rel
    if not rel.spine_dealt:
        out = Relations(rel.spark, rel.sf_dir)
        out.spine_dealt = True
    return [getattr(out, f"{n}_dealt") for n in names], ("k_order",)


class StoredRelations:
    """The 17 relations read back from a written raw layer (production layout).

    :func:`materialize` writes them once (the load step); every query then
    scans stored Parquet with column pruning and filter pushdown instead of
    re-deriving the relations from the benchmark tables.
    """

    def __init__(self, spark: SparkSession, root: str, sf_dir: str):
        self.spark, self.root, self.sf_dir = spark, root.rstrip("/"), sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in RELATION_NAMES:
            return self.spark.read.parquet(f"{self.root}/{name}")
        raise AttributeError(name)


def materialize(spark: SparkSession, sf_dir: str, root: str) -> StoredRelations:
    """Load step: write every relation as Parquet under ``root`` (a shared
    location).  The claim spine (lineitem joined to orders) and the two
    prediction/case spines are written first and read back, so the
    dependent relations derive from stored files instead of recomputing the
    join - the lineage is cut with a written table, which also makes the
    load restartable after an executor loss."""
    root = root.rstrip("/")
    rel = Relations(spark, sf_dir)
    for spine in ("claim_full", "pred_full", "inv_full"):
        getattr(rel, spine).write.mode("overwrite").parquet(f"{root}/_spine/{spine}")
        rel.__dict__[spine] = spark.read.parquet(f"{root}/_spine/{spine}")
    for name in RELATION_NAMES:
        getattr(rel, name).write.mode("overwrite").parquet(f"{root}/{name}")
    return StoredRelations(spark, root, sf_dir)
