"""Staging (G), intermediate (I) and mart (M) models.

Layout at scale: marts are written as Parquet partitioned by month/date
(see :func:`write_mart`); the claim spine is the only relation several models
share.  Dimension lookups (plans, employers, icd10, providers) are joined by
the planner - broadcast when their measured size is under the threshold,
sort-merge otherwise - and per-claim facts (payments, predictions, outcomes)
are aggregated to one row per claim *before* they meet the claims, so no join
multiplies rows.  Rolling measures pre-aggregate to (key, day) and use RANGE
frames partitioned by the key.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.exprs import lit_date, lit_ts, safe_ratio, stable_id
from ..registry import register
from ..sources.mapping import dealt, dealt_spine

REFRESHED = _dt.datetime(2001, 8, 2, 7, 0, 0)
REFRESHED_SQL = "TIMESTAMP '2001-08-02 07:00:00'"
D = K.AS_OF_DATE_SQL
AS_OF_D = K.AS_OF_DATE


def write_mart(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write a mart partitioned for pruning (e.g. by month), one file set per partition."""
    df.repartition(*partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


# ================================================================ staging
def stg_claims(claims: DataFrame) -> DataFrame:
    """Latest load per claim, submission lag, approval share and type."""
    latest = claims.groupBy("claim_id").agg(F.max_by(F.struct(*[c for c in claims.columns if c != "claim_id"]),
                                                     "_loaded_at").alias("r")).select("claim_id", "r.*")
    ap = F.col("amount_approved")
    return latest.select(
        "claim_id", "member_id", "provider_id", "date_of_service", "date_submitted", "diagnosis_code", "procedure_code",
        "amount_claimed", "amount_approved", "status",
        F.datediff("date_submitted", "date_of_service").alias("days_to_submit"),
        F.round(safe_ratio(ap, "amount_claimed"), 4).alias("approval_pct"),
        F.when(ap.isNull() | (ap == 0), "none").when(ap >= F.col("amount_claimed"), "full").otherwise("partial")
        .alias("approval_type"),
        (F.col("date_submitted") == F.col("date_of_service")).alias("is_same_day_submission"))


register("stg_g01_claims", sql=(
    "SELECT claim_id, member_id, provider_id, date_of_service, date_submitted, diagnosis_code, procedure_code, "
    "CAST(amount_claimed AS DOUBLE) AS amount_claimed, CAST(amount_approved AS DOUBLE) AS amount_approved, status, "
    "CAST(date_diff('day', date_of_service, date_submitted) AS INTEGER) AS days_to_submit, "
    "round(CAST(amount_approved AS DOUBLE) / NULLIF(CAST(amount_claimed AS DOUBLE), 0), 4) AS approval_pct, "
    "CASE WHEN amount_approved IS NULL OR amount_approved = 0 THEN 'none' WHEN amount_approved >= amount_claimed "
    "THEN 'full' ELSE 'partial' END AS approval_type, date_submitted = date_of_service AS is_same_day_submission "
    "FROM (SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY _loaded_at DESC) = 1)"))(
    lambda rel: stg_claims(rel.claims))


def stg_members(members: DataFrame, as_of: _dt.date = AS_OF_D) -> DataFrame:
    """Active flag, age, tenure in months, cleaned names."""
    d = lit_date(as_of)
    return members.select(
        "member_id", F.initcap(F.trim("first_name")).alias("first_name"), F.initcap(F.trim("last_name")).alias("last_name"),
        "gender", "county", "plan_code", "employer_id", "enrol_date", "term_date",
        (F.col("is_active") & (F.col("term_date").isNull() | (F.col("term_date") > d))).alias("is_active"),
        F.timestamp_diff("YEAR", F.col("date_of_birth"), d).cast("int").alias("age_years"),
        F.floor(F.months_between(d, F.col("enrol_date"))).cast("int").alias("tenure_months"))


def _initcap_sql(c: str) -> str:
    return f"upper(substr(trim({c}), 1, 1)) || lower(substr(trim({c}), 2))"


register("stg_g02_members", sql=(
    f"SELECT member_id, {_initcap_sql('first_name')} AS first_name, {_initcap_sql('last_name')} AS last_name, gender, "
    "county, plan_code, employer_id, enrol_date, term_date, "
    f"is_active AND (term_date IS NULL OR term_date > {D}) AS is_active, "
    f"CAST(date_sub('year', date_of_birth, {D}) AS INTEGER) AS age_years, "
    f"CAST(date_sub('month', enrol_date, {D}) AS INTEGER) AS tenure_months FROM members"))(
    lambda rel: stg_members(rel.members))


def stg_providers(providers: DataFrame) -> DataFrame:
    """Numeric facility tier and accreditation flag."""
    return providers.select(
        "provider_id", "provider_name", "facility_type", "county", "accreditation_status", "risk_score",
        F.regexp_extract("facility_type", r"Level (\d)", 1).cast("int").alias("tier_level"),
        F.concat(F.lit("Tier "), F.regexp_extract("facility_type", r"Level (\d)", 1)).alias("tier_label"),
        (F.col("accreditation_status") == "Active").alias("is_accredited"))


register("stg_g03_providers", sql=(
    "SELECT provider_id, provider_name, facility_type, county, accreditation_status, CAST(risk_score AS DOUBLE) AS risk_score, "
    "CAST(regexp_extract(facility_type, 'Level (\\d)', 1) AS INTEGER) AS tier_level, "
    "'Tier ' || regexp_extract(facility_type, 'Level (\\d)', 1) AS tier_label, "
    "accreditation_status = 'Active' AS is_accredited FROM providers"))(lambda rel: stg_providers(rel.providers))


def latest_model_rows(log: DataFrame) -> DataFrame:
    """Newest evaluation row per model version (``max_by``, one aggregate)."""
    return log.groupBy("model_version").agg(
        F.max_by(F.struct("evaluation_date", "auc_roc", "promoted"), F.struct("evaluation_date", "log_id")).alias("m")) \
        .select("model_version", F.col("m.evaluation_date").alias("model_evaluated_on"),
                F.col("m.auc_roc").alias("model_auc_roc"), F.col("m.promoted").alias("model_promoted"))


def stg_fraud_predictions(preds: DataFrame, log: DataFrame) -> DataFrame:
    """Predictions with the context of their model version.

    One row per version is broadcast: a join by version would send all
    predictions of a version to one task."""
    return preds.select("prediction_id", "claim_id", "model_version", "fraud_probability", "risk_tier", "predicted_at") \
        .join(F.broadcast(latest_model_rows(log)), "model_version", "left")


register("stg_g04_predictions", sql=(
    "WITH m AS (SELECT model_version, arg_max(evaluation_date, (evaluation_date, log_id)) AS model_evaluated_on, "
    "arg_max(auc_roc, (evaluation_date, log_id)) AS model_auc_roc, arg_max(promoted, (evaluation_date, log_id)) AS "
    "model_promoted FROM model_performance_log GROUP BY model_version) "
    "SELECT p.prediction_id, p.claim_id, p.model_version, CAST(p.fraud_probability AS DOUBLE) AS fraud_probability, "
    "p.risk_tier, p.predicted_at, m.model_evaluated_on, CAST(m.model_auc_roc AS DOUBLE) AS model_auc_roc, m.model_promoted "
    "FROM fraud_predictions p LEFT JOIN m ON m.model_version = p.model_version"))(
    lambda rel: stg_fraud_predictions(rel.fraud_predictions, rel.model_performance_log))


def stg_outcomes(outcomes: DataFrame, investigations: DataFrame) -> DataFrame:
    """Case duration and a timeline check."""
    i = investigations.select("investigation_id", "opened_at", "assigned_to")
    return outcomes.select("outcome_id", "investigation_id", "claim_id", "final_label", "fraud_type", "confirmed_at",
                           "estimated_loss_kes", "amount_recovered_kes").join(i, "investigation_id", "left") \
        .withColumn("investigation_duration_days", F.datediff(F.to_date("confirmed_at"), F.to_date("opened_at"))) \
        .withColumn("is_timeline_valid", F.col("confirmed_at") >= F.col("opened_at"))


register("stg_g05_outcomes", sql=(
    "SELECT o.investigation_id, o.outcome_id, o.claim_id, o.final_label, o.fraud_type, o.confirmed_at, "
    "CAST(o.estimated_loss_kes AS DOUBLE) AS estimated_loss_kes, CAST(o.amount_recovered_kes AS DOUBLE) AS amount_recovered_kes, "
    "i.opened_at, i.assigned_to, CAST(date_diff('day', CAST(i.opened_at AS DATE), CAST(o.confirmed_at AS DATE)) AS INTEGER) "
    "AS investigation_duration_days, o.confirmed_at >= i.opened_at AS is_timeline_valid "
    "FROM fraud_investigation_outcomes o LEFT JOIN fraud_investigations i ON i.investigation_id = o.investigation_id"))(
    lambda rel: stg_outcomes(rel.fraud_investigation_outcomes, rel.fraud_investigations))

register("stg_g06_payments", sql=(
    "SELECT payment_id, claim_id, CAST(amount_paid_kes AS DOUBLE) AS amount_paid_kes, upper(payment_method) AS payment_method, "
    "reference_number, paid_at, CAST(paid_at AS DATE) AS payment_date FROM payments"))(
    lambda rel: rel.payments.select("payment_id", "claim_id", "amount_paid_kes",
                                    F.upper("payment_method").alias("payment_method"), "reference_number", "paid_at",
                                    F.to_date("paid_at").alias("payment_date")))


def stg_stock(stock: DataFrame, prescriptions: DataFrame, claims: DataFrame, days: int = 30) -> DataFrame:
    """Stock-out flag and days of stock left = on hand / mean daily
    dispensed at that facility over the ``days`` days up to the snapshot.

    Dispensing is aggregated to (facility, drug, day) and unioned with the
    snapshots; one RANGE frame per (facility, drug) then sums the trailing
    window - a bounded range join without a cross product.
    """
    disp = (prescriptions.select("claim_id", "drug_code", F.to_date("prescribed_at").alias("d"), "quantity_dispensed")
            .join(claims.select("claim_id", F.col("provider_id").alias("facility_id")), "claim_id")
            .groupBy("facility_id", "drug_code", "d").agg(F.sum("quantity_dispensed").alias("q")))
    ev = disp.select("facility_id", "drug_code", F.unix_date("d").alias("dn"), "q",
                     F.lit(None).cast("string").alias("stock_id"), F.lit(None).cast("int").alias("quantity_on_hand"),
                     F.lit(None).cast("int").alias("reorder_level"))
    st = stock.select("facility_id", "drug_code", F.unix_date("reported_date").alias("dn"), F.lit(None).cast("bigint").alias("q"),
                      "stock_id", "quantity_on_hand", "reorder_level")
    w = Window.partitionBy("facility_id", "drug_code").orderBy("dn").rangeBetween(-(days - 1), 0)
    u = ev.unionByName(st).withColumn("disp_30d", F.sum("q").over(w))
    mean_daily = F.col("disp_30d") / F.lit(float(days))
    return u.filter(F.col("stock_id").isNotNull()).select(
        "stock_id", "facility_id", "drug_code", F.date_from_unix_date("dn").alias("reported_date"), "quantity_on_hand",
        "reorder_level", (F.col("quantity_on_hand") == 0).alias("is_stockout"),
        F.round(F.col("quantity_on_hand") / F.nullif(mean_daily, F.lit(0.0)), 2).alias("days_of_stock_remaining"))


register("stg_g07_stock", sql=(
    "WITH disp AS (SELECT c.provider_id AS facility_id, p.drug_code, CAST(p.prescribed_at AS DATE) AS d, "
    "SUM(p.quantity_dispensed) AS q FROM prescriptions p JOIN claims c ON c.claim_id = p.claim_id GROUP BY 1, 2, 3) "
    "SELECT s.stock_id, s.facility_id, s.drug_code, s.reported_date, s.quantity_on_hand, s.reorder_level, "
    "s.quantity_on_hand = 0 AS is_stockout, round(s.quantity_on_hand / NULLIF((SELECT CAST(SUM(q) AS DOUBLE) FROM disp "
    "WHERE disp.facility_id = s.facility_id AND disp.drug_code = s.drug_code AND disp.d BETWEEN s.reported_date - INTERVAL 29 DAY "
    "AND s.reported_date) / 30.0, 0), 2) AS days_of_stock_remaining FROM stock_levels s"))(
    lambda rel: stg_stock(rel.stock_levels, rel.prescriptions, rel.claims))


# =========================================================== intermediate
def claims_enriched(rel) -> DataFrame:
    """Claim + member + provider + plan + employer + diagnosis + payments.

    Payments are aggregated to one row per claim first; every other side is a
    dimension keyed lookup, so the result has exactly one row per claim.
    """
    (claims, payments), by = dealt(rel, "claims", "payments")
    key = [*by, "claim_id"]
    c = claims.select(*key, "member_id", "provider_id", "diagnosis_code", "date_of_service", "amount_claimed", "amount_approved", "status")
    m = rel.members.select("member_id", "plan_code", "employer_id", F.col("county").alias("member_county"))
    p = rel.providers.select("provider_id", "facility_type", F.col("county").alias("provider_county"), "accreditation_status")
    # reference tables (plans, employers, diagnosis codes) do not grow with claim volume: broadcast
    pl = F.broadcast(rel.plans.select("plan_code", "plan_tier", "annual_limit_kes"))
    e = F.broadcast(rel.employers.select("employer_id", "employer_name"))
    dx = F.broadcast(rel.icd10_codes.select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category"))
    both = c.withColumn("_claim", F.lit(True)).unionByName(
        payments.select(*key, "amount_paid_kes", F.lit(1).alias("_paid")), allowMissingColumns=True)
    of_claim = Window.partitionBy(*key)
    paid = both.withColumns({"total_paid": F.sum("amount_paid_kes").over(of_claim), "payment_count": F.count("_paid").over(of_claim)}) \
        .where("_claim").select("claim_id", *c.columns[len(key):], "total_paid", "payment_count")
    out = paid.join(m, "member_id", "left").join(p, "provider_id", "left").join(pl, "plan_code", "left") \
        .join(e, "employer_id", "left").join(dx, "diagnosis_code", "left")
    facts = ["total_paid", "payment_count"]
    return out.select("claim_id", *[x for x in out.columns if x not in ("claim_id", *facts)], *facts)


_ENRICHED_SQL = (
    "SELECT c.claim_id, c.member_id, c.provider_id, c.diagnosis_code, c.date_of_service, c.amount_claimed, c.amount_approved, "
    "c.status, m.plan_code, m.employer_id, m.county AS member_county, p.facility_type, p.county AS provider_county, "
    "p.accreditation_status, pl.plan_tier, pl.annual_limit_kes, e.employer_name, dx.clinical_category, pay.total_paid, "
    "COALESCE(pay.payment_count, 0) AS payment_count FROM claims c LEFT JOIN members m ON m.member_id = c.member_id "
    "LEFT JOIN providers p ON p.provider_id = c.provider_id LEFT JOIN plans pl ON pl.plan_code = m.plan_code "
    "LEFT JOIN employers e ON e.employer_id = m.employer_id LEFT JOIN icd10_codes dx ON dx.icd10_code = c.diagnosis_code "
    "LEFT JOIN (SELECT claim_id, SUM(amount_paid_kes) AS total_paid, COUNT(*) AS payment_count FROM payments GROUP BY claim_id) pay "
    "ON pay.claim_id = c.claim_id")
register("int_i02_claims_enriched", sql=(
    "SELECT claim_id, member_id, provider_id, diagnosis_code, date_of_service, CAST(amount_claimed AS DOUBLE) AS amount_claimed, "
    "CAST(amount_approved AS DOUBLE) AS amount_approved, status, plan_code, employer_id, member_county, facility_type, "
    "provider_county, accreditation_status, plan_tier, CAST(annual_limit_kes AS DOUBLE) AS annual_limit_kes, employer_name, "
    f"clinical_category, CAST(total_paid AS DOUBLE) AS total_paid, payment_count FROM ({_ENRICHED_SQL})"))(claims_enriched)


def latest_outcome_per_claim(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("claim_id").agg(
        F.max_by(F.struct("final_label", "confirmed_at"), F.struct("confirmed_at", "outcome_id")).alias("o")) \
        .select("claim_id", F.col("o.final_label").alias("final_label"), F.col("o.confirmed_at").alias("outcome_confirmed_at"))


def fraud_scoring(preds: DataFrame, outcomes: DataFrame, threshold: float = 0.5) -> DataFrame:
    """M02 core: prediction + latest outcome of its claim; was_correct is NULL
    until a fraud/legitimate verdict exists (inconclusive stays NULL)."""
    o = latest_outcome_per_claim(outcomes)
    p = preds.select("prediction_id", "claim_id", "model_version", "fraud_probability", "risk_tier", "predicted_at")
    j = p.join(o, "claim_id", "left")
    pos = F.col("fraud_probability") >= threshold
    correct = (F.when(F.col("final_label") == "confirmed_fraud", pos)
               .when(F.col("final_label") == "legitimate", ~pos))
    return j.withColumn("was_correct", correct)


@register("int_i03_model_evaluation", sql=(
    "WITH o AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS final_label "
    "FROM fraud_investigation_outcomes GROUP BY claim_id), "
    "j AS (SELECT p.risk_tier, p.fraud_probability >= 0.5 AS pos, o.final_label FROM fraud_predictions p "
    "LEFT JOIN o ON o.claim_id = p.claim_id) "
    "SELECT risk_tier, COUNT(*) AS predictions, COUNT(*) FILTER (WHERE final_label IN ('confirmed_fraud', 'legitimate')) "
    "AS labelled, COUNT(*) FILTER (WHERE (final_label = 'confirmed_fraud' AND pos) OR (final_label = 'legitimate' AND NOT pos)) "
    "AS correct, round(CAST(COUNT(*) FILTER (WHERE final_label = 'legitimate' AND pos) AS DOUBLE) / NULLIF(COUNT(*) FILTER "
    "(WHERE final_label IN ('confirmed_fraud', 'legitimate') AND pos), 0), 6) AS false_positive_rate FROM j GROUP BY risk_tier"))
def model_evaluation(rel) -> DataFrame:
    """Per risk tier - predictions, labelled, correct, false-positive rate among flagged."""
    s = fraud_scoring(rel.fraud_predictions, rel.fraud_investigation_outcomes)
    pos = F.col("fraud_probability") >= 0.5
    lab = F.col("final_label").isin("confirmed_fraud", "legitimate")
    g = s.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("predictions"), F.count_if(lab).alias("labelled"),
        F.count_if(F.col("was_correct")).alias("correct"),
        F.count_if((F.col("final_label") == "legitimate") & pos).alias("_fp"), F.count_if(lab & pos).alias("_lp"))
    return g.select("risk_tier", "predictions", "labelled", "correct",
                    F.round(F.col("_fp") / F.nullif(F.col("_lp"), F.lit(0)), 6).alias("false_positive_rate"))


def provider_risk_profile(rel, as_of: _dt.date = AS_OF_D) -> DataFrame:
    """Per provider - fraud rate, 30-day frequency and amount trend vs the
    previous 30 days, and flagged claims in the last 30 days (one aggregate)."""
    d = lit_date(as_of)
    c = rel.claims.select("claim_id", "provider_id", "date_of_service", F.col("amount_claimed").alias("a"), "status")
    age = F.datediff(d, F.col("date_of_service"))
    cur, prev = (age >= 0) & (age < 30), (age >= 30) & (age < 60)

    def mean(cond):  # exact decimal sum / count (order-independent)
        return F.sum(F.when(cond, F.col("a"))).cast("double") / F.nullif(F.count_if(cond), F.lit(0))
    g = c.groupBy("provider_id").agg(
        F.count_if(cur).alias("claims_30d"), F.count_if(prev).alias("claims_prev_30d"),
        mean(cur).alias("_m1"), mean(prev).alias("_m0"),
        F.count_if(cur & (F.col("status") == "flagged_fraud")).alias("anomaly_count_30d"))
    o = rel.fraud_investigation_outcomes.select("claim_id", "final_label").join(c.select("claim_id", "provider_id"), "claim_id") \
        .groupBy("provider_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("final_label") == "confirmed_fraud").alias("_f"))
    return g.join(o, "provider_id", "left").select(
        "provider_id", "claims_30d", "claims_prev_30d",
        F.round(safe_ratio("claims_30d", "claims_prev_30d"), 4).alias("frequency_trend"),
        F.round(F.col("_m1") / F.nullif(F.col("_m0"), F.lit(0.0)), 4).alias("amount_trend"),
        "anomaly_count_30d", F.round(F.col("_f") / F.nullif(F.col("_n"), F.lit(0)), 5).alias("fraud_rate"))


register("int_i04_provider_risk", sql=(
    f"WITH c AS (SELECT claim_id, provider_id, amount_claimed AS a, status, date_diff('day', date_of_service, {D}) AS age "
    "FROM claims), g AS (SELECT provider_id, COUNT(*) FILTER (WHERE age >= 0 AND age < 30) AS claims_30d, "
    "COUNT(*) FILTER (WHERE age >= 30 AND age < 60) AS claims_prev_30d, "
    "CAST(SUM(a) FILTER (WHERE age >= 0 AND age < 30) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE age >= 0 AND age < 30), 0) AS m1, "
    "CAST(SUM(a) FILTER (WHERE age >= 30 AND age < 60) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE age >= 30 AND age < 60), 0) AS m0, COUNT(*) FILTER (WHERE age >= 0 AND age < 30 AND status = 'flagged_fraud') "
    "AS anomaly_count_30d FROM c GROUP BY provider_id), o AS (SELECT c.provider_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE "
    "x.final_label = 'confirmed_fraud') AS f FROM fraud_investigation_outcomes x JOIN c ON c.claim_id = x.claim_id GROUP BY 1) "
    "SELECT g.provider_id, claims_30d, claims_prev_30d, round(CAST(claims_30d AS DOUBLE) / NULLIF(CAST(claims_prev_30d AS DOUBLE), 0), 4) "
    "AS frequency_trend, round(m1 / NULLIF(m0, 0), 4) AS amount_trend, anomaly_count_30d, round(CAST(f AS DOUBLE) / NULLIF(n, 0), 5) "
    "AS fraud_rate FROM g LEFT JOIN o ON o.provider_id = g.provider_id"))(provider_risk_profile)


# ------------------------------------------------------------- SCD2
TRACKED = ("plan_code", "employer_id", "county", "term_date")
SNAPSHOT_TS = (_dt.datetime(1993, 1, 1), _dt.datetime(1995, 6, 1), _dt.datetime(1998, 1, 1))   # inside the claim years


def member_snapshots(rel) -> DataFrame:
    """Three daily-refresh snapshots derived from ``members``: moves, plan
    changes, a change back, and members that disappear from later loads."""
    m = rel.members.drop("_loaded_at")
    k = F.col("member_id").cast("bigint")
    s1 = m.withColumn("snapshot_ts", lit_ts(SNAPSHOT_TS[0]))
    s2 = (m.filter(k % 97 != 3)
          .withColumn("county", F.when(k % 5 == 0, F.lit("NAIROBI")).otherwise(F.col("county")))
          .withColumn("plan_code", F.when(k % 10 == 0, F.lit("HOUSEHOLD")).otherwise(F.col("plan_code")))
          .withColumn("snapshot_ts", lit_ts(SNAPSHOT_TS[1])))
    s3 = (m.filter(k % 97 != 3)
          .withColumn("county", F.when((k % 5 == 0) & (k % 20 != 0), F.lit("NAIROBI")).otherwise(F.col("county")))
          .withColumn("plan_code", F.when(k % 10 == 0, F.lit("HOUSEHOLD")).otherwise(F.col("plan_code")))
          .withColumn("employer_id", F.when(k % 33 == 0, F.lit("7")).otherwise(F.col("employer_id")))
          .withColumn("snapshot_ts", lit_ts(SNAPSHOT_TS[2])))
    return s1.unionByName(s2).unionByName(s3)


def scd2(snapshots: DataFrame, key: str, tracked: tuple, ts: str = "snapshot_ts") -> DataFrame:
    """Validity rows (valid_from, valid_to, is_current) from full snapshots.

    A new version starts when any tracked column changes (NULL-safe); a key
    missing from a later snapshot is closed at the first snapshot without it.
    One shuffle by key; the snapshot calendar is a tiny distinct list.
    """
    w = Window.partitionBy(key).orderBy(ts)
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.lag(ts).over(w).isNull()
    x = snapshots.withColumn("_chg", first | changed)
    last_seen = F.max(ts).over(Window.partitionBy(key))
    x = x.withColumn("_last_seen", last_seen).filter("_chg")
    cal = snapshots.select(ts).distinct()
    nxt = cal.select(F.col(ts).alias("_last_seen"),
                     F.lead(ts).over(Window.orderBy(ts)).alias("_gone_at"))  # tiny: one row per load
    x = x.join(F.broadcast(nxt), "_last_seen", "left")
    w2 = Window.partitionBy(key).orderBy(ts)
    valid_to = F.coalesce(F.lead(ts).over(w2), F.col("_gone_at"))
    return x.withColumn("valid_to", valid_to).withColumnRenamed(ts, "valid_from") \
        .withColumn("is_current", F.col("valid_to").isNull()).drop("_chg", "_last_seen", "_gone_at")


def dim_members(rel) -> DataFrame:
    """SCD2 member dimension with plan and employer names."""
    v = scd2(member_snapshots(rel), "member_id", TRACKED)
    pl = rel.plans.select("plan_code", "plan_name")            # reference tables
    e = rel.employers.select("employer_id", "employer_name")
    v = v.join(pl, "plan_code", "left").join(e, "employer_id", "left")
    return v.select(
        stable_id("M-", "member_id", "valid_from").alias("member_sk"), "member_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "date_of_birth", "gender", "county",
        "plan_code", "plan_name", "employer_id", "employer_name", "is_active",
        F.col("valid_from").alias("dbt_valid_from"), F.col("valid_to").alias("dbt_valid_to"),
        F.col("is_current").alias("dbt_is_current"), lit_ts(REFRESHED).alias("refreshed_at"))


def _snap_sql() -> str:
    cols = ("member_id first_name last_name date_of_birth gender id_type id_number phone_number county sub_county "
            "enrol_date term_date plan_code employer_id is_active").split()
    k = "CAST(member_id AS BIGINT)"

    def sel(ts, **kw):
        return ", ".join(f"{kw[c]} AS {c}" if c in kw else c for c in cols) + f", TIMESTAMP '{ts}' AS snapshot_ts"
    return (f"snap AS (SELECT {sel('1993-01-01 00:00:00')} FROM members UNION ALL "
            f"SELECT {sel('1995-06-01 00:00:00', county=f'CASE WHEN {k} % 5 = 0 THEN {chr(39)}NAIROBI{chr(39)} ELSE county END', plan_code=f'CASE WHEN {k} % 10 = 0 THEN {chr(39)}HOUSEHOLD{chr(39)} ELSE plan_code END')} "
            f"FROM members WHERE {k} % 97 <> 3 UNION ALL "
            f"SELECT {sel('1998-01-01 00:00:00', county=f'CASE WHEN {k} % 5 = 0 AND {k} % 20 <> 0 THEN {chr(39)}NAIROBI{chr(39)} ELSE county END', plan_code=f'CASE WHEN {k} % 10 = 0 THEN {chr(39)}HOUSEHOLD{chr(39)} ELSE plan_code END', employer_id=f'CASE WHEN {k} % 33 = 0 THEN {chr(39)}7{chr(39)} ELSE employer_id END')} "
            f"FROM members WHERE {k} % 97 <> 3)")


def _scd2_sql() -> str:
    chg = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in TRACKED)
    return (
        "WITH " + _snap_sql() + ", "
        f"x AS (SELECT *, (lag(snapshot_ts) OVER w IS NULL OR {chg}) AS chg, max(snapshot_ts) OVER (PARTITION BY member_id) AS last_seen "
        "FROM snap WINDOW w AS (PARTITION BY member_id ORDER BY snapshot_ts)), "
        "cal AS (SELECT ts, lead(ts) OVER (ORDER BY ts) AS gone_at FROM (SELECT DISTINCT snapshot_ts AS ts FROM snap)), "
        "v AS (SELECT x.*, COALESCE(lead(snapshot_ts) OVER (PARTITION BY member_id ORDER BY snapshot_ts), cal.gone_at) AS valid_to "
        "FROM x LEFT JOIN cal ON cal.ts = x.last_seen WHERE chg) ")


register("mart_m04_dim_members", sql=_scd2_sql() + (
    "SELECT 'M-' || substr(sha256(concat_ws('|', v.member_id, strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S'))), 1, 16) AS member_sk, "
    "v.member_id, concat_ws(' ', v.first_name, v.last_name) AS full_name, v.date_of_birth, v.gender, v.county, v.plan_code, "
    "pl.plan_name, v.employer_id, e.employer_name, v.is_active, snapshot_ts AS dbt_valid_from, valid_to AS dbt_valid_to, "
    f"valid_to IS NULL AS dbt_is_current, {REFRESHED_SQL} AS refreshed_at FROM v LEFT JOIN plans pl ON pl.plan_code = v.plan_code "
    "LEFT JOIN employers e ON e.employer_id = v.employer_id"))(dim_members)


@register("int_i05_member_plan_history", sql=_scd2_sql() + (
    "SELECT member_id, snapshot_ts AS valid_from, valid_to, plan_code, "
    "lag(plan_code) OVER (PARTITION BY member_id ORDER BY snapshot_ts) AS previous_plan_code FROM v "
    "QUALIFY previous_plan_code IS NULL OR previous_plan_code <> plan_code"))
def member_plan_history(rel) -> DataFrame:
    """Plan periods per member (versions whose plan differs from the previous one)."""
    v = scd2(member_snapshots(rel), "member_id", TRACKED)
    w = Window.partitionBy("member_id").orderBy("valid_from")
    x = v.select("member_id", "valid_from", "valid_to", "plan_code", F.lag("plan_code").over(w).alias("previous_plan_code"))
    return x.filter(F.col("previous_plan_code").isNull() | (F.col("previous_plan_code") != F.col("plan_code")))


@register("mart_m13_current_members", sql=_scd2_sql() + (
    f"SELECT member_id, county, plan_code, employer_id, CAST(date_sub('year', date_of_birth, {D}) AS INTEGER) AS age_years, "
    "CASE WHEN employer_id IS NULL THEN 'Retail' ELSE 'Corporate' END AS segment FROM v WHERE valid_to IS NULL"))
def current_members(rel) -> DataFrame:
    """Current SCD2 rows with age and Retail/Corporate segment."""
    v = scd2(member_snapshots(rel), "member_id", TRACKED).filter("is_current")
    return v.select("member_id", "county", "plan_code", "employer_id",
                    F.timestamp_diff("YEAR", F.col("date_of_birth"), lit_date(AS_OF_D)).cast("int").alias("age_years"),
                    F.when(F.col("employer_id").isNull(), "Retail").otherwise("Corporate").alias("segment"))


# ================================================================ marts
def fct_claims(rel, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Claims with the newest prediction of each claim (``max_by``).

    ``dealt`` names columns of both relations that the claim id determines and that their
    rows are dealt by already: then a window finds the prediction, as a join would deal
    them again.
    """
    key, newest = [*dealt, "claim_id"], F.max_by("_p", "_at")
    p = rel.fraud_predictions.select(*key, F.struct("fraud_probability", "risk_tier").alias("_p"),
                                     F.struct("predicted_at", "prediction_id").alias("_at"))
    c = rel.claims.select(*key, "member_id", "provider_id", "date_of_service", "date_submitted", "amount_claimed",
                          "amount_approved", "status")
    if dealt:
        both = c.withColumn("_claim", F.lit(True)).unionByName(p, allowMissingColumns=True)
        scored = both.withColumn("p", newest.over(Window.partitionBy(*key))).where("_claim")
    else:
        scored = c.join(p.groupBy("claim_id").agg(newest.alias("p")), "claim_id", "left")
    return scored.select(
        *c.columns, F.datediff("date_submitted", "date_of_service").alias("days_to_submit"),
        F.col("p.fraud_probability").alias("fraud_probability"), F.col("p.risk_tier").alias("risk_tier"),
        lit_ts(REFRESHED).alias("refreshed_at"))


_FCT_CLAIMS_SQL = (
    "SELECT c.claim_id, c.member_id, c.provider_id, c.date_of_service, c.date_submitted, "
    "CAST(c.amount_claimed AS DOUBLE) AS amount_claimed, CAST(c.amount_approved AS DOUBLE) AS amount_approved, c.status, "
    "CAST(date_diff('day', c.date_of_service, c.date_submitted) AS INTEGER) AS days_to_submit, "
    "CAST(p.fraud_probability AS DOUBLE) AS fraud_probability, p.risk_tier, "
    f"{REFRESHED_SQL} AS refreshed_at FROM claims c LEFT JOIN (SELECT claim_id, "
    "arg_max(fraud_probability, (predicted_at, prediction_id)) AS fraud_probability, "
    "arg_max(risk_tier, (predicted_at, prediction_id)) AS risk_tier FROM fraud_predictions GROUP BY claim_id) p "
    "ON p.claim_id = c.claim_id")
register("mart_m01_fct_claims", sql=_FCT_CLAIMS_SQL)(fct_claims)


@register("mart_m02_fct_fraud_scoring", sql=(
    "WITH o AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS final_label, "
    "arg_max(confirmed_at, (confirmed_at, outcome_id)) AS outcome_confirmed_at FROM fraud_investigation_outcomes GROUP BY claim_id) "
    "SELECT p.prediction_id, p.claim_id, p.model_version, CAST(p.fraud_probability AS DOUBLE) AS fraud_probability, p.risk_tier, "
    "o.final_label, CASE WHEN o.final_label = 'confirmed_fraud' THEN p.fraud_probability >= 0.5 "
    "WHEN o.final_label = 'legitimate' THEN p.fraud_probability < 0.5 END AS was_correct, p.predicted_at, o.outcome_confirmed_at, "
    f"{REFRESHED_SQL} AS refreshed_at FROM fraud_predictions p LEFT JOIN o ON o.claim_id = p.claim_id"))
def fct_fraud_scoring(rel) -> DataFrame:
    s = fraud_scoring(rel.fraud_predictions, rel.fraud_investigation_outcomes)
    return s.select("prediction_id", "claim_id", "model_version", "fraud_probability", "risk_tier", "final_label",
                    "was_correct", "predicted_at", "outcome_confirmed_at", lit_ts(REFRESHED).alias("refreshed_at"))


@register("mart_m03_fct_payments", sql=(
    "SELECT p.payment_id, p.claim_id, c.member_id, c.provider_id, m.employer_id, CAST(p.amount_paid_kes AS DOUBLE) AS amount_paid_kes, "
    f"p.payment_method, p.paid_at, {REFRESHED_SQL} AS refreshed_at FROM payments p LEFT JOIN claims c ON c.claim_id = p.claim_id "
    "LEFT JOIN members m ON m.member_id = c.member_id"))
def fct_payments(rel) -> DataFrame:
    c = rel.claims.select("claim_id", "member_id", "provider_id")
    m = rel.members.select("member_id", "employer_id")
    return rel.payments.select("payment_id", "claim_id", "amount_paid_kes", "payment_method", "paid_at") \
        .join(c, "claim_id", "left").join(m, "member_id", "left") \
        .select("payment_id", "claim_id", "member_id", "provider_id", "employer_id", "amount_paid_kes", "payment_method",
                "paid_at", lit_ts(REFRESHED).alias("refreshed_at"))


@register("mart_m05_dim_providers", sql=(
    f"WITH c AS (SELECT claim_id, provider_id, amount_claimed, date_diff('day', date_of_service, {D}) AS age FROM claims), "
    "a AS (SELECT provider_id, COUNT(*) FILTER (WHERE age BETWEEN 0 AND 29) AS total_claims_30d, "
    "CAST(SUM(amount_claimed) FILTER (WHERE age BETWEEN 0 AND 29) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE age BETWEEN 0 AND 29), 0) AS avg30, "
    "COUNT(*) FILTER (WHERE age BETWEEN 0 AND 89) AS n90 FROM c GROUP BY provider_id), "
    "f AS (SELECT c.provider_id, COUNT(DISTINCT c.claim_id) AS f90 FROM c JOIN fraud_investigation_outcomes o ON o.claim_id = c.claim_id "
    "WHERE o.final_label = 'confirmed_fraud' AND c.age BETWEEN 0 AND 89 GROUP BY 1) "
    "SELECT p.provider_id, p.provider_name, p.facility_type, p.county, p.accreditation_status, CAST(p.risk_score AS DOUBLE) AS risk_score, "
    "CAST(COALESCE(a.total_claims_30d, 0) AS INTEGER) AS total_claims_30d, a.avg30 AS avg_claim_amount_30d, "
    "round(CAST(COALESCE(f.f90, 0) AS DOUBLE) / NULLIF(a.n90, 0), 5) AS fraud_rate_90d, "
    f"{REFRESHED_SQL} AS refreshed_at FROM providers p LEFT JOIN a ON a.provider_id = p.provider_id "
    "LEFT JOIN f ON f.provider_id = p.provider_id"))
def dim_providers(rel, as_of: _dt.date = AS_OF_D) -> DataFrame:
    """Provider dimension with 30-day volume/amount and 90-day confirmed-fraud share."""
    d = lit_date(as_of)
    fraud = rel.fraud_investigation_outcomes.filter(F.col("final_label") == "confirmed_fraud").select("claim_id").distinct() \
        .withColumn("_f", F.lit(1))
    c = rel.claims.select("claim_id", "provider_id", F.col("amount_claimed").alias("a"),
                          F.datediff(d, F.col("date_of_service")).alias("age")).join(fraud, "claim_id", "left")
    in30, in90 = F.col("age").between(0, 29), F.col("age").between(0, 89)
    g = c.groupBy("provider_id").agg(F.count_if(in30).alias("_n30"),
                                     (F.sum(F.when(in30, F.col("a"))).cast("double")
                                      / F.nullif(F.count_if(in30), F.lit(0))).alias("_m30"),
                                     F.count_if(in90).alias("_n90"), F.count_if(in90 & F.col("_f").isNotNull()).alias("_f90"))
    p = rel.providers.select("provider_id", "provider_name", "facility_type", "county", "accreditation_status", "risk_score")
    return p.join(g, "provider_id", "left").select(
        *p.columns, F.coalesce("_n30", F.lit(0)).cast("int").alias("total_claims_30d"),
        F.col("_m30").alias("avg_claim_amount_30d"),
        F.round(F.coalesce("_f90", F.lit(0)) / F.nullif(F.col("_n90"), F.lit(0)), 5).alias("fraud_rate_90d"),
        lit_ts(REFRESHED).alias("refreshed_at"))


@register("mart_m06_claims_performance", sql=(
    "SELECT CAST(date_trunc('month', c.date_of_service) AS DATE) AS summary_month, m.plan_code, m.employer_id, m.county, "
    "COUNT(*) AS total_claims, CAST(SUM(c.amount_claimed) AS DOUBLE) AS total_amount_claimed, "
    "CAST(SUM(c.amount_approved) AS DOUBLE) AS total_amount_approved, "
    "round(CAST(COUNT(*) FILTER (WHERE c.status IN ('approved', 'partially_approved', 'paid')) AS DOUBLE) / COUNT(*), 5) AS approval_rate, "
    "round(AVG(date_diff('day', c.date_of_service, c.date_submitted)), 2) AS avg_days_to_submit, "
    f"COUNT(*) FILTER (WHERE c.status = 'flagged_fraud') AS flagged_fraud_count, {REFRESHED_SQL} AS refreshed_at "
    "FROM claims c JOIN members m ON m.member_id = c.member_id GROUP BY 1, 2, 3, 4"))
def claims_performance(rel) -> DataFrame:
    """Month x plan x employer x county (NULL employer groups together)."""
    c = rel.claims.select("member_id", "date_of_service", "date_submitted", "amount_claimed", "amount_approved", "status")
    m = rel.members.select("member_id", "plan_code", "employer_id", "county")
    j = c.join(m, "member_id")
    return j.groupBy(F.trunc("date_of_service", "month").alias("summary_month"), "plan_code", "employer_id", "county").agg(
        F.count(F.lit(1)).alias("total_claims"), F.sum("amount_claimed").alias("total_amount_claimed"),
        F.sum("amount_approved").alias("total_amount_approved"),
        F.round(F.count_if(F.col("status").isin(*K.APPROVED_LIKE)) / F.count(F.lit(1)), 5).alias("approval_rate"),
        F.round(F.avg(F.datediff("date_submitted", "date_of_service")), 2).alias("avg_days_to_submit"),
        F.count_if(F.col("status") == "flagged_fraud").alias("flagged_fraud_count"),
        F.max(lit_ts(REFRESHED)).alias("refreshed_at"))


def provider_analytics(rel) -> DataFrame:
    """M07 per (provider, day with claims): 1/7/30-day counts, 7-day mean
    amount, 30-day amount z-score of the day's mean, high-score share.

    Claims are pre-aggregated to (provider, day) partials (n, sum, sum of
    squares, high predictions); RANGE frames over those partials give every
    trailing statistic with one sort per provider.
    """
    hi = rel.fraud_predictions.groupBy("claim_id").agg(F.max("fraud_probability").alias("pmax"))
    # amounts as integer cents: sums are exact BIGINTs, sums of squares exact
    # DOUBLEs (integers below 2**53), so the result does not depend on the
    # order in which partial sums meet, and the frames avoid DECIMAL(38) math
    cents = (F.col("amount_claimed") * 100).cast("bigint")
    c = rel.claims.select("claim_id", "provider_id", "date_of_service", cents.alias("a")) \
        .join(hi, "claim_id", "left")
    day = c.groupBy("provider_id", F.unix_date("date_of_service").alias("dn")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("s"), F.sum(F.col("a").cast("double") * F.col("a")).alias("ss"),
        F.count_if(F.col("pmax") >= 0.8).alias("h"))
    w = Window.partitionBy("provider_id").orderBy("dn")
    w7, w30 = w.rangeBetween(-6, 0), w.rangeBetween(-29, 0)
    n30 = F.sum("n").over(w30)
    s30, ss30 = F.sum("s").over(w30).cast("double"), F.sum("ss").over(w30)
    mean30 = s30 / n30
    var30 = (ss30 - s30 * s30 / n30) / F.nullif(n30 - 1, F.lit(0))
    sd30 = F.sqrt(F.greatest(var30, F.lit(0.0)))
    day_mean = F.col("s").cast("double") / F.col("n")
    x = day.select("provider_id", "dn", F.col("n").alias("claim_count_1d"), F.sum("n").over(w7).alias("claim_count_7d"),
                   n30.alias("claim_count_30d"), (F.sum("s").over(w7).cast("double") / F.sum("n").over(w7) / 100).alias("avg7"),
                   ((day_mean - mean30) / F.nullif(sd30, F.lit(0.0))).alias("z"),
                   (F.sum("h").over(w30) / n30).alias("rate"))
    return x.select("provider_id", F.date_from_unix_date("dn").alias("analytics_date"), "claim_count_1d", "claim_count_7d",
                    "claim_count_30d", F.col("avg7").alias("avg_amount_7d"), F.round("z", 6).alias("amount_zscore_30d"),
                    F.col("rate").alias("fraud_prediction_rate"), lit_ts(REFRESHED).alias("refreshed_at"))


register("mart_m07_provider_analytics", sql=(
    "WITH hi AS (SELECT claim_id, MAX(fraud_probability) AS pmax FROM fraud_predictions GROUP BY claim_id), "
    "day AS (SELECT c.provider_id, c.date_of_service AS d, COUNT(*) AS n, SUM(CAST(c.amount_claimed * 100 AS BIGINT)) AS s, "
    "SUM(CAST(CAST(c.amount_claimed * 100 AS BIGINT) AS DOUBLE) * CAST(c.amount_claimed * 100 AS BIGINT)) AS ss, "
    "COUNT(*) FILTER (WHERE hi.pmax >= 0.8) AS h FROM claims c LEFT JOIN hi ON hi.claim_id = c.claim_id GROUP BY 1, 2), "
    "x AS (SELECT provider_id, d, n, "
    "SUM(n) OVER w7 AS n7, CAST(SUM(s) OVER w7 AS DOUBLE) AS s7, SUM(n) OVER w30 AS n30, CAST(SUM(s) OVER w30 AS DOUBLE) AS s30, "
    "SUM(ss) OVER w30 AS ss30, SUM(h) OVER w30 AS h30, CAST(s AS DOUBLE) / n AS dm FROM day "
    "WINDOW w7 AS (PARTITION BY provider_id ORDER BY d RANGE BETWEEN INTERVAL 6 DAY "
    "PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY provider_id ORDER BY d RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)) "
    "SELECT provider_id, d AS analytics_date, n AS claim_count_1d, n7 AS claim_count_7d, n30 AS claim_count_30d, "
    "s7 / n7 / 100 AS avg_amount_7d, round((dm - s30 / n30) / NULLIF(sqrt(greatest((ss30 - s30 * s30 / n30) "
    "/ NULLIF(n30 - 1, 0), 0.0)), 0), 6) AS amount_zscore_30d, CAST(h30 AS DOUBLE) / n30 AS fraud_prediction_rate, "
    f"{REFRESHED_SQL} AS refreshed_at FROM x"))(provider_analytics)


def member_utilisation(rel) -> DataFrame:
    """M08 per (member, month): claimed, approved, plan limit, year-to-date
    approved share of the limit (running sum per member and year), count,
    distinct providers."""
    c = rel.claims.select("member_id", "provider_id", "date_of_service", "amount_claimed", "amount_approved", "status")
    m = rel.members.select("member_id", "plan_code").join(rel.plans.select("plan_code", "annual_limit_kes"), "plan_code")
    g = c.groupBy("member_id", F.trunc("date_of_service", "month").alias("utilisation_month")).agg(
        F.sum("amount_claimed").alias("total_claimed_kes"), F.sum("amount_approved").alias("total_approved_kes"),
        F.count(F.lit(1)).alias("claim_count"), F.count_distinct("provider_id").alias("distinct_providers"))
    w = Window.partitionBy("member_id", F.year("utilisation_month")).orderBy("utilisation_month") \
        .rowsBetween(Window.unboundedPreceding, 0)
    ytd = F.sum(F.coalesce(F.col("total_approved_kes"), F.lit(0))).over(w)
    return g.join(m.select("member_id", "annual_limit_kes"), "member_id", "left").select(
        "member_id", "utilisation_month", "total_claimed_kes", "total_approved_kes", "annual_limit_kes",
        (ytd.cast("double") / F.col("annual_limit_kes").cast("double")).alias("ytd_utilisation_pct"),
        "claim_count", "distinct_providers", lit_ts(REFRESHED).alias("refreshed_at"))


_UTIL_SQL = (
    "WITH g AS (SELECT member_id, CAST(date_trunc('month', date_of_service) AS DATE) AS utilisation_month, "
    "SUM(amount_claimed) AS total_claimed_kes, SUM(amount_approved) AS total_approved_kes, COUNT(*) AS claim_count, "
    "COUNT(DISTINCT provider_id) AS distinct_providers FROM claims GROUP BY 1, 2), "
    "lim AS (SELECT m.member_id, p.annual_limit_kes FROM members m JOIN plans p ON p.plan_code = m.plan_code) "
    "SELECT g.member_id, utilisation_month, CAST(total_claimed_kes AS DOUBLE) AS total_claimed_kes, "
    "CAST(total_approved_kes AS DOUBLE) AS total_approved_kes, CAST(lim.annual_limit_kes AS DOUBLE) AS annual_limit_kes, "
    "CAST(SUM(COALESCE(total_approved_kes, 0)) OVER (PARTITION BY g.member_id, year(utilisation_month) ORDER BY "
    "utilisation_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(lim.annual_limit_kes AS DOUBLE) "
    f"AS ytd_utilisation_pct, claim_count, distinct_providers, {REFRESHED_SQL} AS refreshed_at FROM g "
    "LEFT JOIN lim ON lim.member_id = g.member_id")
register("mart_m08_member_utilisation", sql=_UTIL_SQL)(member_utilisation)


def supply_chain_summary(rel) -> DataFrame:
    """Below-reorder flag and stock-out days in the trailing 30 days."""
    s = rel.stock_levels.select("facility_id", "drug_code", "reported_date", "quantity_on_hand", "reorder_level",
                                F.unix_date("reported_date").alias("dn"))
    w = Window.partitionBy("facility_id", "drug_code").orderBy("dn").rangeBetween(-29, 0)
    return s.select("facility_id", "drug_code", "reported_date", "quantity_on_hand", "reorder_level",
                    (F.col("quantity_on_hand") < F.col("reorder_level")).alias("is_below_reorder"),
                    F.count_if(F.col("quantity_on_hand") == 0).over(w).cast("int").alias("stockout_days_30d"),
                    F.count_if(F.col("quantity_on_hand") < F.col("reorder_level")).over(w).cast("int").alias("below_reorder_days_30d"),
                    lit_ts(REFRESHED).alias("refreshed_at"))


register("mart_m09_supply_chain", sql=(
    "SELECT facility_id, drug_code, reported_date, quantity_on_hand, reorder_level, quantity_on_hand < reorder_level AS is_below_reorder, "
    "CAST(COUNT(*) FILTER (WHERE quantity_on_hand = 0) OVER w AS INTEGER) AS stockout_days_30d, "
    "CAST(COUNT(*) FILTER (WHERE quantity_on_hand < reorder_level) OVER w AS INTEGER) AS below_reorder_days_30d, "
    f"{REFRESHED_SQL} AS refreshed_at FROM stock_levels WINDOW w AS (PARTITION BY facility_id, drug_code ORDER BY reported_date "
    "RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)"))(supply_chain_summary)


@register("mart_m10_fraud_analytics", sql=(
    "WITH f AS (SELECT claim_id, bool_or(final_label = 'confirmed_fraud') AS cf, "
    "SUM(CASE WHEN final_label = 'confirmed_fraud' THEN estimated_loss_kes END) AS loss FROM fraud_investigation_outcomes GROUP BY 1), "
    "e AS (" + _ENRICHED_SQL + ") "
    "SELECT CAST(date_trunc('month', e.date_of_service) AS DATE) AS month, e.plan_tier, e.provider_county AS region, "
    "COUNT(*) AS claims, COUNT(*) FILTER (WHERE e.status = 'flagged_fraud') AS flagged_claims, COUNT(*) FILTER (WHERE f.cf) "
    "AS confirmed_fraud_claims, CAST(SUM(e.amount_claimed) AS DOUBLE) AS amount_claimed, CAST(COALESCE(SUM(f.loss), 0) AS DOUBLE) "
    "AS confirmed_loss FROM e LEFT JOIN f ON f.claim_id = e.claim_id GROUP BY 1, 2, 3"))
def fraud_analytics(rel) -> DataFrame:
    """Fraud KPIs by month, plan tier and region (provider county)."""
    o = rel.fraud_investigation_outcomes
    f = o.groupBy("claim_id").agg(F.max((F.col("final_label") == "confirmed_fraud").cast("int")).alias("cf"),
                                  F.sum(F.when(F.col("final_label") == "confirmed_fraud", F.col("estimated_loss_kes"))).alias("loss"))
    e = claims_enriched(rel).join(f, "claim_id", "left")
    return e.groupBy(F.trunc("date_of_service", "month").alias("month"), "plan_tier",
                     F.col("provider_county").alias("region")).agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(F.col("status") == "flagged_fraud").alias("flagged_claims"),
        F.count_if(F.col("cf") == 1).alias("confirmed_fraud_claims"), F.sum("amount_claimed").alias("amount_claimed"),
        F.coalesce(F.sum("loss"), F.lit(0)).cast("decimal(25,2)").alias("confirmed_loss"))


# *decision*: affordability cut points on the monthly premium (parameters)
AFFORDABILITY_CUTS = (1000, 2000)


@register("mart_m11_dim_plans", sql=(
    "SELECT plan_code, plan_name, plan_tier, CAST(premium_monthly_kes AS DOUBLE) AS premium_monthly_kes, "
    "CAST(annual_limit_kes AS DOUBLE) AS annual_limit_kes, CASE WHEN premium_monthly_kes < 1000 THEN 'budget' "
    "WHEN premium_monthly_kes < 2000 THEN 'mid' ELSE 'high' END AS affordability_tier FROM plans"))
def dim_plans(rel, cuts=AFFORDABILITY_CUTS) -> DataFrame:
    p = F.col("premium_monthly_kes")
    return rel.plans.select("plan_code", "plan_name", "plan_tier", "premium_monthly_kes", "annual_limit_kes",
                            F.when(p < cuts[0], "budget").when(p < cuts[1], "mid").otherwise("high").alias("affordability_tier"))


# Public holidays of the calendar, as month-day and name.
HOLIDAYS = {"01-01": "New Year's Day", "05-01": "Labour Day", "06-01": "Madaraka Day", "10-20": "Mashujaa Day",
            "12-12": "Jamhuri Day", "12-25": "Christmas Day", "12-26": "Boxing Day"}
#: the calendar covers these years and every service date beyond them
CALENDAR = (_dt.date(2020, 1, 1), _dt.date(2028, 12, 31))


def dim_date(start: DataFrame, holidays: dict[str, str] | None = None) -> DataFrame:
    """One row per day between the ``lo`` and ``hi`` of ``start`` (a one-row
    range), weekday, holiday and business-day flags; ``holidays`` maps month-day
    to a name."""
    days = start.select(F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("date_day"))
    names = F.create_map(*[F.lit(x) for kv in (HOLIDAYS if holidays is None else holidays).items() for x in kv])
    out = days.select("date_day", F.year("date_day").alias("year"), F.month("date_day").alias("month"),
                      F.dayofweek("date_day").alias("day_of_week"),
                      F.weekofyear("date_day").alias("iso_week"), F.quarter("date_day").alias("quarter"),
                      F.try_element_at(names, F.date_format("date_day", "MM-dd")).alias("holiday_name"))
    return out.withColumn("is_holiday", F.col("holiday_name").isNotNull()) \
        .withColumn("is_business_day", ~F.col("day_of_week").isin(1, 7) & ~F.col("is_holiday"))


_HOLIDAY_SQL = "CASE strftime(d, '%m-%d') " + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in HOLIDAYS.items()) + " END"


@register("mart_m12_dim_date", sql=(
    "SELECT CAST(d AS DATE) AS date_day, year(d) AS year, month(d) AS month, dayofweek(d) + 1 AS day_of_week, "
    f"weekofyear(d) AS iso_week, quarter(d) AS quarter, {_HOLIDAY_SQL} AS holiday_name, {_HOLIDAY_SQL} IS NOT NULL AS is_holiday, "
    f"dayofweek(d) NOT IN (0, 6) AND {_HOLIDAY_SQL} IS NULL AS is_business_day FROM (SELECT unnest(generate_series("
    f"CAST(least(MIN(date_of_service), DATE '{CALENDAR[0]}') AS TIMESTAMP), CAST(greatest(MAX(date_of_service), DATE '{CALENDAR[1]}') "
    "AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM claims)"))
def dim_date_from_claims(rel) -> DataFrame:
    rng = rel.claims.agg(F.least(F.min("date_of_service"), lit_date(CALENDAR[0])).alias("lo"),
                         F.greatest(F.max("date_of_service"), lit_date(CALENDAR[1])).alias("hi"))
    return dim_date(rng)


@register("mart_m14_model_tests", sql=(
    "WITH f AS (" + _FCT_CLAIMS_SQL + ") "
    "SELECT 'unique_claim_id' AS test, COUNT(*) AS failures FROM (SELECT claim_id FROM f GROUP BY 1 HAVING COUNT(*) > 1) UNION ALL "
    "SELECT 'not_null_member_id', COUNT(*) FROM f WHERE member_id IS NULL UNION ALL "
    "SELECT 'accepted_status', COUNT(*) FROM f WHERE status NOT IN (" + K.sql_list(K.CLAIM_STATUSES) + ") UNION ALL "
    "SELECT 'approved_le_claimed', COUNT(*) FROM f WHERE amount_approved > amount_claimed UNION ALL "
    f"SELECT 'no_future_service', COUNT(*) FROM f WHERE date_of_service > {D} UNION ALL "
    "SELECT 'accepted_risk_tier', COUNT(*) FROM f WHERE risk_tier NOT IN (" + K.sql_list(K.RISK_TIERS) + ") UNION ALL "
    "SELECT 'case_timeline', COUNT(*) FROM fraud_investigation_outcomes o JOIN fraud_investigations i "
    "ON i.investigation_id = o.investigation_id WHERE o.confirmed_at < i.opened_at"))
def model_tests(rel) -> DataFrame:
    """Unique / not_null / accepted_values / row rules on the marts, as failure counts.

    The row-local tests share one aggregate over fct_claims.
    """
    f = fct_claims(rel)
    agg = f.agg(F.count_if(F.col("member_id").isNull()).alias("not_null_member_id"),
                F.count_if(~F.col("status").isin(*K.CLAIM_STATUSES)).alias("accepted_status"),
                F.count_if(F.col("amount_approved") > F.col("amount_claimed")).alias("approved_le_claimed"),
                F.count_if(F.col("date_of_service") > lit_date(AS_OF_D)).alias("no_future_service"),
                F.count_if(~F.col("risk_tier").isin(*K.RISK_TIERS)).alias("accepted_risk_tier"))
    names = ["not_null_member_id", "accepted_status", "approved_le_claimed", "no_future_service", "accepted_risk_tier"]
    rows = agg.select(F.explode(F.array(*[F.struct(F.lit(n).alias("test"), F.col(n).alias("failures")) for n in names])).alias("t")) \
        .select("t.*")
    uniq = f.groupBy("claim_id").count().filter("count > 1").agg(F.count(F.lit(1)).alias("failures")) \
        .select(F.lit("unique_claim_id").alias("test"), "failures")
    tl = rel.fraud_investigation_outcomes.select("investigation_id", "confirmed_at") \
        .join(rel.fraud_investigations.select("investigation_id", "opened_at"), "investigation_id") \
        .filter(F.col("confirmed_at") < F.col("opened_at")).agg(F.count(F.lit(1)).alias("failures")) \
        .select(F.lit("case_timeline").alias("test"), "failures")
    return rows.unionByName(uniq).unionByName(tl)


class _With:
    """A relation set with some relations replaced."""

    def __init__(self, rel, **replaced):
        self._rel, self._replaced = rel, replaced

    def __getattr__(self, name):
        return self._replaced[name] if name in self._replaced else getattr(self._rel, name)


def merge_fct_claims(stored: DataFrame, rel, touched: DataFrame, version: int, dealt: tuple[str, ...] = ()) -> DataFrame:
    """The next version of the mart - claims in ``touched`` are recomputed
    (only they are read and scored again), all others keep their stored row.
    ``built_in`` is the version that computed a row.  ``dealt`` as in :func:`fct_claims`."""
    from ..operators.writes import split_by
    key = [*dealt, "claim_id"]
    fresh = fct_claims(_With(rel, claims=split_by(rel.claims, touched, key)[0],
                             fraud_predictions=split_by(rel.fraud_predictions, touched, key)[0]), dealt).drop(*dealt)
    return split_by(stored, touched.select("claim_id"), ["claim_id"])[1].unionByName(fresh.withColumn("built_in", F.lit(version)))


@register("upsert_u09_fct_claims_merge", sql=(
    "WITH f AS (" + _FCT_CLAIMS_SQL + ") SELECT f.*, CASE WHEN claim_id IN (SELECT claim_id FROM fraud_predictions "
    "WHERE model_version = 'v2.1') THEN 2 ELSE 1 END AS built_in FROM f"))
def fct_claims_merge(rel) -> DataFrame:
    """Version 1 is built and stored before the v2.1 predictions exist; the
    merge recomputes the claims that they touch."""
    from ..operators.writes import VersionedTable
    is_new = F.col("model_version") == "v2.1"
    table = VersionedTable(rel.spark, f"fct_claims-{uuid.uuid4().hex}")
    (claims, predictions), by = dealt(dealt_spine(rel), "claims", "fraud_predictions")
    first = fct_claims(_With(rel, claims=claims, fraud_predictions=predictions.filter(~is_new)), by)
    table.commit(first.drop(*by).withColumn("built_in", F.lit(1)))
    touched = predictions.filter(is_new).select(*by, "claim_id").distinct()
    return merge_fct_claims(table.read(), _With(rel, claims=claims, fraud_predictions=predictions), touched, 2, by)


# ------------------------------------------------------ more intermediates
@register("int_i07_disease_patterns", sql=(
    "SELECT CAST(date_trunc('week', c.date_of_service) AS DATE) AS week, p.county AS region, c.provider_id, "
    "COALESCE(dx.clinical_category, 'Other') AS clinical_category, COUNT(*) AS claims FROM claims c "
    "JOIN providers p ON p.provider_id = c.provider_id LEFT JOIN icd10_codes dx ON dx.icd10_code = c.diagnosis_code "
    "GROUP BY 1, 2, 3, 4"))
def disease_patterns(rel) -> DataFrame:
    """Claims by week, region, provider and clinical category."""
    dx = rel.icd10_codes.select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category")
    c = rel.claims.select("provider_id", "diagnosis_code", "date_of_service") \
        .join(rel.providers.select("provider_id", F.col("county").alias("region")), "provider_id") \
        .join(dx, "diagnosis_code", "left")
    return c.groupBy(F.to_date(F.date_trunc("week", "date_of_service")).alias("week"), "region", "provider_id",
                     F.coalesce("clinical_category", F.lit("Other")).alias("clinical_category")) \
        .agg(F.count(F.lit(1)).alias("claims"))


@register("int_i08_status_history", sql=(
    "SELECT event_id, claim_id, new_status AS status, event_at AS entered_at, "
    "lead(event_at) OVER (PARTITION BY claim_id ORDER BY event_at, event_id) AS left_at, "
    "date_sub('second', event_at, lead(event_at) OVER (PARTITION BY claim_id ORDER BY event_at, event_id)) AS seconds_in_status "
    "FROM claim_events"))
def status_history(rel) -> DataFrame:
    """Status intervals from the event log and the time spent in each
    (next event of the claim - see :func:`next_time_in_key`)."""
    from ..operators.windows import next_time_in_key
    e = rel.claim_events.select("event_id", "claim_id", "new_status", "event_at").where("event_id is not null")
    # an event id that repeats has every end of its rows on each of them
    ends = F.collect_list(F.struct("left_at")).over(Window.partitionBy("claim_id", "event_id"))
    return next_time_in_key(e, "claim_id", "event_at", "event_id", "left_at").withColumn("ends", ends).drop("left_at") \
        .select("*", F.inline("ends")).select(
        "event_id", "claim_id", F.col("new_status").alias("status"), F.col("event_at").alias("entered_at"), "left_at",
        F.timestamp_diff("SECOND", F.col("event_at"), F.col("left_at")).alias("seconds_in_status"))


@register("int_i08_time_in_status", sql=(
    "SELECT status, COUNT(*) AS intervals, AVG(s) AS avg_seconds, MAX(s) AS max_seconds FROM ("
    "SELECT new_status AS status, date_sub('second', event_at, lead(event_at) OVER (PARTITION BY claim_id "
    "ORDER BY event_at, event_id)) AS s FROM claim_events) WHERE s IS NOT NULL GROUP BY status"))
def time_in_status(rel) -> DataFrame:
    h = status_history(rel).filter(F.col("seconds_in_status").isNotNull())
    return h.groupBy("status").agg(F.count(F.lit(1)).alias("intervals"), F.avg("seconds_in_status").alias("avg_seconds"),
                                   F.max("seconds_in_status").alias("max_seconds"))


def claims_with_member_version(claims: DataFrame, versions: DataFrame) -> DataFrame:
    """Each claim joined to the member version valid on its service date
    (equi-join on member_id + validity range; a member has few versions, so
    the range predicate filters a bounded set per claim)."""
    v = versions.select("member_id", "member_sk", "plan_code", "county", "dbt_valid_from", "dbt_valid_to")
    c = claims.select("claim_id", "member_id", "date_of_service",
                      F.col("date_of_service").cast("timestamp_ntz").alias("_t"))
    cond = ((c.member_id == v.member_id) & (c._t >= v.dbt_valid_from)
            & (c._t < F.coalesce(v.dbt_valid_to, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))))
    return c.join(v, cond, "left").select(c.claim_id, c.member_id, c.date_of_service, "member_sk",
                                          F.col("plan_code").alias("plan_code_at_service"),
                                          F.col("county").alias("county_at_service"))


register("int_j11_claim_member_version", sql=_scd2_sql() + (
    ", d AS (SELECT 'M-' || substr(sha256(concat_ws('|', member_id, strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S'))), 1, 16) "
    "AS member_sk, member_id, plan_code, county, snapshot_ts AS vf, valid_to AS vt FROM v) "
    "SELECT c.claim_id, c.member_id, c.date_of_service, d.member_sk, d.plan_code AS plan_code_at_service, "
    "d.county AS county_at_service FROM claims c LEFT JOIN d ON d.member_id = c.member_id "
    "AND CAST(c.date_of_service AS TIMESTAMP) >= d.vf AND CAST(c.date_of_service AS TIMESTAMP) < "
    "COALESCE(d.vt, TIMESTAMP '9999-12-31 00:00:00')"))(lambda rel: claims_with_member_version(rel.claims, dim_members(rel)))
