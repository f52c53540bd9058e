"""Operational reports Q01-Q34 as DataFrame functions.

Each report is one declarative plan over the claim relations; dimensions are
joined by key, facts are aggregated before they meet other facts, and top-k
reports use ``orderBy().limit()`` (Spark plans a TakeOrderedAndProject, i.e.
per-partition top-k then a merge - never a full global sort).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.exprs import lit_date
from ..registry import register
from .features import member_velocity
from .models import claims_enriched, current_members, member_utilisation, _ENRICHED_SQL, _UTIL_SQL, _scd2_sql

D = K.AS_OF_DATE_SQL
AS_OF_D = K.AS_OF_DATE


def _month(c):
    return F.trunc(c, "month")


# ---------------------------------------------------------------- claims
@register("report_q01_monthly_status", sql=(
    "SELECT CAST(date_trunc('month', date_of_service) AS DATE) AS month, status, COUNT(*) AS claims FROM claims GROUP BY 1, 2"))
def q01_monthly_status(rel) -> DataFrame:
    return rel.claims.groupBy(_month("date_of_service").alias("month"), "status").agg(F.count(F.lit(1)).alias("claims"))


@register("report_q02_approval_trend", sql=(
    "WITH e AS (" + _ENRICHED_SQL + ") SELECT CAST(date_trunc('month', date_of_service) AS DATE) AS month, "
    "CASE WHEN GROUPING(plan_tier) = 0 THEN 'plan_tier' WHEN GROUPING(employer_id) = 0 THEN 'employer' "
    "WHEN GROUPING(provider_id) = 0 THEN 'provider' ELSE 'diagnosis_category' END AS dimension, "
    "COALESCE(plan_tier, employer_id, provider_id, clinical_category) AS dimension_value, COUNT(*) AS claims, "
    "round(CAST(COUNT(*) FILTER (WHERE status IN ('approved', 'partially_approved', 'paid')) AS DOUBLE) / COUNT(*), 6) "
    "AS approval_rate FROM e GROUP BY GROUPING SETS ((1, plan_tier), (1, employer_id), (1, provider_id), (1, clinical_category))"))
def q02_approval_trend(rel) -> DataFrame:
    """Approval rate per month along four dimensions in one pass (GROUPING SETS)."""
    e = claims_enriched(rel).withColumn("month", _month("date_of_service"))
    g = e.groupingSets([["month", "plan_tier"], ["month", "employer_id"], ["month", "provider_id"],
                        ["month", "clinical_category"]], "month", "plan_tier", "employer_id", "provider_id",
                       "clinical_category").agg(
        F.count(F.lit(1)).alias("claims"),
        F.round(F.count_if(F.col("status").isin(*K.APPROVED_LIKE)) / F.count(F.lit(1)), 6).alias("approval_rate"),
        F.grouping("plan_tier").alias("_gp"), F.grouping("employer_id").alias("_ge"), F.grouping("provider_id").alias("_gv"))
    dim = (F.when(F.col("_gp") == 0, "plan_tier").when(F.col("_ge") == 0, "employer")
           .when(F.col("_gv") == 0, "provider").otherwise("diagnosis_category"))
    return g.select("month", dim.alias("dimension"),
                    F.coalesce("plan_tier", "employer_id", "provider_id", "clinical_category").alias("dimension_value"),
                    "claims", "approval_rate")


@register("report_q03_processing_days", sql=(
    "WITH d AS (SELECT e.claim_id, MIN(e.event_at) AS decided_at FROM claim_events e WHERE e.event_type IN "
    "('approved', 'rejected', 'flagged', 'status_changed') GROUP BY 1), "
    "x AS (SELECT c.status, date_diff('day', CAST(c.submitted_at AS DATE), CAST(d.decided_at AS DATE)) AS days "
    "FROM claims c JOIN d ON d.claim_id = c.claim_id) "
    "SELECT status, COUNT(*) AS claims, quantile_cont(days, 0.5) AS median_days, quantile_cont(days, 0.9) AS p90_days "
    "FROM x GROUP BY status"))
def q03_processing_days(rel) -> DataFrame:
    """Days from submission to the first decision event; exact median / p90
    (whole days, so the percentile buffer is bounded by the day range)."""
    d = rel.claim_events.filter(F.col("event_type").isin("approved", "rejected", "flagged", "status_changed")) \
        .groupBy("claim_id").agg(F.min("event_at").alias("decided_at"))
    x = rel.claims.select("claim_id", "status", "submitted_at").join(d, "claim_id") \
        .select("status", F.datediff(F.to_date("decided_at"), F.to_date("submitted_at")).alias("days"))
    return x.groupBy("status").agg(F.count(F.lit(1)).alias("claims"), F.percentile("days", 0.5).alias("median_days"),
                                   F.percentile("days", 0.9).alias("p90_days"))


@register("report_q04_claimed_vs_approved", sql=(
    "SELECT CAST(date_trunc('month', c.date_of_service) AS DATE) AS month, m.employer_id, CAST(SUM(c.amount_claimed) AS DOUBLE) "
    "AS claimed, CAST(SUM(c.amount_approved) AS DOUBLE) AS approved, COUNT(*) AS claims FROM claims c "
    "JOIN members m ON m.member_id = c.member_id GROUP BY 1, 2"))
def q04_claimed_vs_approved(rel) -> DataFrame:
    c = rel.claims.select("member_id", "date_of_service", "amount_claimed", "amount_approved") \
        .join(rel.members.select("member_id", "employer_id"), "member_id")
    return c.groupBy(_month("date_of_service").alias("month"), "employer_id").agg(
        F.sum("amount_claimed").alias("claimed"), F.sum("amount_approved").alias("approved"), F.count(F.lit(1)).alias("claims"))


@register("report_q05_pending_age", sql=(
    f"SELECT CASE WHEN date_diff('day', date_submitted, {D}) < 7 THEN '<7' WHEN date_diff('day', date_submitted, {D}) <= 14 "
    "THEN '7-14' ELSE '>14' END AS age_bucket, status, COUNT(*) AS claims FROM claims "
    "WHERE status IN ('submitted', 'pending_review') GROUP BY 1, 2"))
def q05_pending_age(rel, as_of: _dt.date = AS_OF_D) -> DataFrame:
    age = F.datediff(lit_date(as_of), F.col("date_submitted"))
    b = F.when(age < 7, "<7").when(age <= 14, "7-14").otherwise(">14")
    return rel.claims.filter(F.col("status").isin("submitted", "pending_review")) \
        .groupBy(b.alias("age_bucket"), "status").agg(F.count(F.lit(1)).alias("claims"))


# ------------------------------------------------------------- providers
@register("report_q06_provider_leaderboard", sql=(
    "SELECT provider_id, COUNT(*) AS claims, CAST(SUM(amount_claimed) AS DOUBLE) AS total_claimed FROM claims "
    "GROUP BY provider_id ORDER BY total_claimed DESC, provider_id LIMIT 10"))
def q06_leaderboard(rel, k: int = 10) -> DataFrame:
    """Top-k providers by claimed amount (the limit is the report)."""
    g = rel.claims.groupBy("provider_id").agg(F.count(F.lit(1)).alias("claims"), F.sum("amount_claimed").alias("total_claimed"))
    return g.orderBy(F.desc("total_claimed"), "provider_id").limit(k)


@register("report_q07_provider_frequency_change", sql=(
    "WITH w AS (SELECT provider_id, CAST(date_trunc('week', date_of_service) AS DATE) AS week, COUNT(*) AS claims "
    "FROM claims GROUP BY 1, 2) SELECT provider_id, week, claims, lag(claims) OVER (PARTITION BY provider_id ORDER BY week) "
    "AS prev_week_claims, claims - lag(claims) OVER (PARTITION BY provider_id ORDER BY week) AS week_change FROM w"))
def q07_frequency_change(rel) -> DataFrame:
    """Week-over-week change of provider volume (W09); per-provider windows over weekly rows."""
    w = rel.claims.groupBy("provider_id", F.to_date(F.date_trunc("week", "date_of_service")).alias("week")) \
        .agg(F.count(F.lit(1)).alias("claims"))
    lag = F.lag("claims").over(Window.partitionBy("provider_id").orderBy("week"))
    return w.select("provider_id", "week", "claims", lag.alias("prev_week_claims"), (F.col("claims") - lag).alias("week_change"))


@register("report_q07_provider_month_change", sql=(
    "WITH w AS (SELECT provider_id, CAST(date_trunc('month', date_of_service) AS DATE) AS month, COUNT(*) AS claims "
    "FROM claims GROUP BY 1, 2) SELECT provider_id, month, claims, claims - lag(claims) OVER (PARTITION BY provider_id "
    "ORDER BY month) AS month_change FROM w"))
def q07_month_change(rel) -> DataFrame:
    w = rel.claims.groupBy("provider_id", _month("date_of_service").alias("month")).agg(F.count(F.lit(1)).alias("claims"))
    lag = F.lag("claims").over(Window.partitionBy("provider_id").orderBy("month"))
    return w.select("provider_id", "month", "claims", (F.col("claims") - lag).alias("month_change"))


@register("report_q08_provider_vs_peers", sql=(
    "WITH pm AS (SELECT c.provider_id, p.county, c.diagnosis_code, COUNT(*) AS claims, "
    "CAST(SUM(c.amount_claimed) AS DOUBLE) / COUNT(*) AS provider_mean FROM claims c JOIN providers p ON p.provider_id = c.provider_id "
    "GROUP BY 1, 2, 3), peer AS (SELECT county, diagnosis_code, CAST(SUM(c.amount_claimed) AS DOUBLE) / COUNT(*) AS peer_mean "
    "FROM claims c JOIN providers p ON p.provider_id = c.provider_id GROUP BY 1, 2) "
    "SELECT pm.provider_id, pm.county, pm.diagnosis_code, pm.claims, pm.provider_mean, peer.peer_mean, "
    "pm.provider_mean / peer.peer_mean AS ratio_to_peers FROM pm JOIN peer ON peer.county = pm.county "
    "AND peer.diagnosis_code = pm.diagnosis_code"))
def q08_vs_peers(rel) -> DataFrame:
    """Provider mean claim per diagnosis against all claims of the county for that diagnosis."""
    c = rel.claims.select("provider_id", "diagnosis_code", "amount_claimed") \
        .join(rel.providers.select("provider_id", "county"), "provider_id")
    pm = c.groupBy("provider_id", "county", "diagnosis_code").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("amount_claimed").alias("_s"))
    peer = pm.groupBy("county", "diagnosis_code").agg(
        (F.sum("_s").cast("double") / F.sum("claims")).alias("peer_mean"))
    # one row per (county, diagnosis): bounded by the two dimensions
    return pm.join(peer, ["county", "diagnosis_code"]).select(
        "provider_id", "county", "diagnosis_code", "claims", (F.col("_s").cast("double") / F.col("claims")).alias("provider_mean"),
        "peer_mean", ((F.col("_s").cast("double") / F.col("claims")) / F.col("peer_mean")).alias("ratio_to_peers"))


@register("report_q09_above_average_volume", sql=(
    "WITH p AS (SELECT provider_id, COUNT(*) AS claims FROM claims GROUP BY 1), a AS (SELECT CAST(SUM(claims) AS DOUBLE) / COUNT(*) "
    "AS mean_claims FROM p) SELECT p.provider_id, p.claims, a.mean_claims FROM p CROSS JOIN a WHERE p.claims > a.mean_claims"))
def q09_above_average(rel) -> DataFrame:
    p = rel.claims.groupBy("provider_id").agg(F.count(F.lit(1)).alias("claims"))
    a = p.agg((F.sum("claims").cast("double") / F.count(F.lit(1))).alias("mean_claims"))
    return p.crossJoin(F.broadcast(a)).filter(F.col("claims") > F.col("mean_claims"))


@register("report_q10_non_accredited", sql=(
    "SELECT p.accreditation_status, c.status, COUNT(*) AS claims, CAST(SUM(c.amount_claimed) AS DOUBLE) AS amount_claimed "
    "FROM claims c JOIN providers p ON p.provider_id = c.provider_id WHERE p.accreditation_status <> 'Active' GROUP BY 1, 2"))
def q10_non_accredited(rel) -> DataFrame:
    p = rel.providers.filter(F.col("accreditation_status") != "Active").select("provider_id", "accreditation_status")
    return rel.claims.select("provider_id", "status", "amount_claimed").join(p, "provider_id") \
        .groupBy("accreditation_status", "status").agg(F.count(F.lit(1)).alias("claims"),
                                                       F.sum("amount_claimed").alias("amount_claimed"))


# --------------------------------------------------------------- members
@register("report_q11_high_utilisation", sql=(
    "WITH u AS (" + _UTIL_SQL + ") SELECT member_id, year(utilisation_month) AS year, MAX(ytd_utilisation_pct) AS ytd_utilisation_pct "
    "FROM u GROUP BY 1, 2 HAVING MAX(ytd_utilisation_pct) > 0.8"))
def q11_high_utilisation(rel, cut: float = 0.8) -> DataFrame:
    u = member_utilisation(rel)
    return u.groupBy("member_id", F.year("utilisation_month").alias("year")) \
        .agg(F.max("ytd_utilisation_pct").alias("ytd_utilisation_pct")).filter(F.col("ytd_utilisation_pct") > cut)


@register("report_q12_age_gender", sql=(
    f"WITH m AS (SELECT member_id, gender, date_sub('year', date_of_birth, {D}) AS age FROM members) "
    "SELECT CASE WHEN age < 18 THEN '0-17' WHEN age < 35 THEN '18-34' WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64' "
    "ELSE '65+' END AS age_segment, m.gender, COUNT(*) AS claims, CAST(SUM(c.amount_claimed) AS DOUBLE) AS amount_claimed "
    "FROM claims c JOIN m ON m.member_id = c.member_id GROUP BY 1, 2"))
def q12_age_gender(rel, as_of: _dt.date = AS_OF_D) -> DataFrame:
    age = F.timestamp_diff("YEAR", F.col("date_of_birth"), lit_date(as_of))
    seg = (F.when(age < 18, "0-17").when(age < 35, "18-34").when(age < 50, "35-49").when(age < 65, "50-64").otherwise("65+"))
    m = rel.members.select("member_id", "gender", seg.alias("age_segment"))
    return rel.claims.select("member_id", "amount_claimed").join(m, "member_id") \
        .groupBy("age_segment", "gender").agg(F.count(F.lit(1)).alias("claims"), F.sum("amount_claimed").alias("amount_claimed"))


@register("report_q13_fast_claimers", sql=(
    "WITH v AS (SELECT member_id, COUNT(*) AS claims, AVG(gap) AS mean_gap FROM (SELECT member_id, date_diff('day', "
    "lag(date_of_service) OVER (PARTITION BY member_id ORDER BY date_of_service, claim_id), date_of_service) AS gap FROM claims) "
    "GROUP BY 1), f AS (SELECT member_id, claims, CAST(floor(mean_gap) AS BIGINT) AS gap_days FROM v WHERE mean_gap IS NOT NULL), "
    "cut AS (SELECT quantile_cont(gap_days, 0.1) AS p10 FROM f) SELECT f.member_id, f.claims, f.gap_days, cut.p10 AS p10_gap_days "
    "FROM f CROSS JOIN cut WHERE f.gap_days < cut.p10"))
def q13_fast_claimers(rel) -> DataFrame:
    """Members whose mean gap between claims (whole days) is below the 10th percentile."""
    v = member_velocity(rel).filter(F.col("mean_days_between_claims").isNotNull()) \
        .select("member_id", "claims", F.floor("mean_days_between_claims").cast("bigint").alias("gap_days"))
    cut = v.agg(F.percentile("gap_days", 0.1).alias("p10_gap_days"))
    return v.crossJoin(F.broadcast(cut)).filter(F.col("gap_days") < F.col("p10_gap_days"))


@register("report_q14_retail_vs_corporate", sql=_scd2_sql() + (
    ", seg AS (SELECT member_id, CASE WHEN employer_id IS NULL THEN 'Retail' ELSE 'Corporate' END AS segment FROM v "
    "WHERE valid_to IS NULL) SELECT seg.segment, COUNT(*) AS claims, CAST(SUM(c.amount_claimed) AS DOUBLE) AS amount_claimed, "
    "COUNT(DISTINCT c.member_id) AS members FROM claims c JOIN seg ON seg.member_id = c.member_id GROUP BY seg.segment"))
def q14_segments(rel) -> DataFrame:
    """Claims and amounts of current members by Retail / Corporate segment."""
    m = current_members(rel).select("member_id", "segment")
    return rel.claims.select("member_id", "amount_claimed").join(m, "member_id") \
        .groupBy("segment").agg(F.count(F.lit(1)).alias("claims"), F.sum("amount_claimed").alias("amount_claimed"),
                                F.count_distinct("member_id").alias("members"))


# -------------------------------------------------------------- payments
@register("report_q15_payments_month_method", sql=(
    "SELECT CAST(date_trunc('month', paid_at) AS DATE) AS month, payment_method, COUNT(*) AS payments, "
    "CAST(SUM(amount_paid_kes) AS DOUBLE) AS amount_paid FROM payments GROUP BY 1, 2"))
def q15_payments(rel) -> DataFrame:
    return rel.payments.groupBy(F.to_date(_month("paid_at")).alias("month"), "payment_method").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount_paid_kes").alias("amount_paid"))


@register("report_q16_payments_provider_employer", sql=(
    "SELECT c.provider_id, m.employer_id, COUNT(*) AS payments, CAST(SUM(p.amount_paid_kes) AS DOUBLE) AS amount_paid "
    "FROM payments p JOIN claims c ON c.claim_id = p.claim_id JOIN members m ON m.member_id = c.member_id GROUP BY 1, 2"))
def q16_payments_by_party(rel) -> DataFrame:
    c = rel.claims.select("claim_id", "provider_id", "member_id")
    m = rel.members.select("member_id", "employer_id")
    return rel.payments.select("claim_id", "amount_paid_kes").join(c, "claim_id").join(m, "member_id") \
        .groupBy("provider_id", "employer_id").agg(F.count(F.lit(1)).alias("payments"), F.sum("amount_paid_kes").alias("amount_paid"))


@register("report_q17_approval_to_payment", sql=(
    "WITH a AS (SELECT claim_id, MIN(event_at) AS approved_at FROM claim_events WHERE event_type = 'approved' GROUP BY 1), "
    "p AS (SELECT claim_id, payment_method, MIN(paid_at) AS paid_at FROM payments GROUP BY 1, 2) "
    "SELECT p.payment_method, COUNT(*) AS payments, AVG(date_diff('day', CAST(a.approved_at AS DATE), CAST(p.paid_at AS DATE))) "
    "AS avg_days, quantile_cont(date_diff('day', CAST(a.approved_at AS DATE), CAST(p.paid_at AS DATE)), 0.5) AS median_days "
    "FROM p JOIN a ON a.claim_id = p.claim_id GROUP BY 1"))
def q17_approval_to_payment(rel) -> DataFrame:
    a = rel.claim_events.filter(F.col("event_type") == "approved").groupBy("claim_id").agg(F.min("event_at").alias("approved_at"))
    p = rel.payments.groupBy("claim_id", "payment_method").agg(F.min("paid_at").alias("paid_at"))
    d = F.datediff(F.to_date("paid_at"), F.to_date("approved_at"))
    return p.join(a, "claim_id").select("payment_method", d.alias("d")).groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("payments"), F.avg("d").alias("avg_days"), F.percentile("d", 0.5).alias("median_days"))


@register("report_q18_approved_unpaid", sql=(
    "SELECT c.claim_id, c.status, CAST(c.amount_approved AS DOUBLE) AS amount_approved, c.updated_at FROM claims c "
    "WHERE c.status IN ('approved', 'paid') AND NOT EXISTS (SELECT 1 FROM payments p WHERE p.claim_id = c.claim_id)"))
def q18_approved_unpaid(rel) -> DataFrame:
    return rel.claims.filter(F.col("status").isin("approved", "paid")) \
        .select("claim_id", "status", "amount_approved", "updated_at").join(rel.payments.select("claim_id"), "claim_id", "left_anti")


# ------------------------------------------------------------------ stock
def latest_stock(stock: DataFrame) -> DataFrame:
    return stock.groupBy("facility_id", "drug_code").agg(
        F.max_by(F.struct("reported_date", "quantity_on_hand", "reorder_level"), "reported_date").alias("s")) \
        .select("facility_id", "drug_code", "s.*")


@register("report_q19_stock_vs_reorder", sql=(
    "WITH l AS (SELECT facility_id, drug_code, arg_max(quantity_on_hand, reported_date) AS q, "
    "arg_max(reorder_level, reported_date) AS r FROM stock_levels GROUP BY 1, 2) "
    "SELECT l.facility_id, COALESCE(f.drug_class, 'unknown') AS drug_class, COUNT(*) AS drugs, "
    "COUNT(*) FILTER (WHERE q < r) AS below_reorder FROM l LEFT JOIN drug_formulary f ON f.drug_code = l.drug_code GROUP BY 1, 2"))
def q19_stock_vs_reorder(rel) -> DataFrame:
    l = latest_stock(rel.stock_levels).join(rel.drug_formulary.select("drug_code", "drug_class"), "drug_code", "left")
    return l.groupBy("facility_id", F.coalesce("drug_class", F.lit("unknown")).alias("drug_class")).agg(
        F.count(F.lit(1)).alias("drugs"), F.count_if(F.col("quantity_on_hand") < F.col("reorder_level")).alias("below_reorder"))


def stock_episodes(stock: DataFrame) -> DataFrame:
    """Islands of consecutive snapshots below the reorder level per
    (facility, drug): start, end, snapshots (gaps-and-islands: running sum of
    change flags, then one aggregate per island)."""
    w = Window.partitionBy("facility_id", "drug_code").orderBy("reported_date")
    low = F.col("quantity_on_hand") < F.col("reorder_level")
    x = stock.select("facility_id", "drug_code", "reported_date", low.alias("low"))
    x = x.withColumn("_chg", (F.col("low") != F.coalesce(F.lag("low").over(w), ~F.col("low"))).cast("int"))
    x = x.withColumn("island", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.filter("low").groupBy("facility_id", "drug_code", "island").agg(
        F.min("reported_date").alias("start_date"), F.max("reported_date").alias("end_date"),
        F.count(F.lit(1)).alias("snapshots")).drop("island")


_EPISODES_SQL = (
    "x AS (SELECT facility_id, drug_code, reported_date, quantity_on_hand < reorder_level AS low FROM stock_levels), "
    "y AS (SELECT *, CAST(low <> COALESCE(lag(low) OVER w, NOT low) AS INTEGER) AS chg FROM x "
    "WINDOW w AS (PARTITION BY facility_id, drug_code ORDER BY reported_date)), "
    "z AS (SELECT *, SUM(chg) OVER (PARTITION BY facility_id, drug_code ORDER BY reported_date ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS island FROM y), ep AS (SELECT facility_id, drug_code, MIN(reported_date) AS start_date, "
    "MAX(reported_date) AS end_date, COUNT(*) AS snapshots FROM z WHERE low GROUP BY facility_id, drug_code, island) ")
register("int_i06_stock_episodes", sql="WITH " + _EPISODES_SQL + "SELECT * FROM ep")(lambda rel: stock_episodes(rel.stock_levels))


@register("report_q20_stockout_impact", sql=(
    "WITH " + _EPISODES_SQL + ", rx AS (SELECT c.provider_id AS facility_id, p.drug_code, CAST(p.prescribed_at AS DATE) AS d, "
    "COUNT(*) AS n FROM prescriptions p JOIN claims c ON c.claim_id = p.claim_id GROUP BY 1, 2, 3) "
    "SELECT ep.facility_id, COUNT(*) AS episodes, SUM(date_diff('day', ep.start_date, ep.end_date) + 1) AS episode_days, "
    "SUM(COALESCE((SELECT SUM(n) FROM rx WHERE rx.facility_id = ep.facility_id AND rx.drug_code = ep.drug_code "
    "AND rx.d BETWEEN ep.start_date AND ep.end_date), 0)) AS affected_prescriptions FROM ep GROUP BY 1"))
def q20_stockout_impact(rel) -> DataFrame:
    """Low-stock episodes per facility: count, days covered, prescriptions of
    the drug at the facility during an episode (equi-join on facility and drug
    plus a date band over daily prescription counts)."""
    ep = stock_episodes(rel.stock_levels)
    key = ["facility_id", "drug_code", "start_date"]           # an episode's identity
    rx = rel.prescriptions.select("claim_id", "drug_code", F.to_date("prescribed_at").alias("d")) \
        .join(rel.claims.select("claim_id", F.col("provider_id").alias("facility_id")), "claim_id") \
        .groupBy("facility_id", "drug_code", "d").agg(F.count(F.lit(1)).alias("n"))
    # by month: a long-lived drug's days are split, and only days of an episode's months meet it
    months = ep.withColumn("m", F.explode(F.sequence(F.trunc("start_date", "month"), F.trunc("end_date", "month"), F.expr("INTERVAL 1 MONTH"))))
    hit = months.join(rx.withColumn("m", F.trunc("d", "month")), ["facility_id", "drug_code", "m"]) \
        .filter(F.col("d").between(F.col("start_date"), F.col("end_date"))).groupBy(*key).agg(F.sum("n").alias("affected"))
    e = ep.join(hit, key, "left")
    return e.groupBy("facility_id").agg(
        F.count(F.lit(1)).alias("episodes"),
        F.sum(F.datediff("end_date", "start_date") + 1).alias("episode_days"),
        F.sum(F.coalesce("affected", F.lit(0))).alias("affected_prescriptions"))


@register("report_q21_essential_availability", sql=(
    "WITH l AS (SELECT facility_id, drug_code, arg_max(quantity_on_hand, reported_date) AS q FROM stock_levels GROUP BY 1, 2) "
    "SELECT p.facility_type, COUNT(*) AS essential_drugs, round(AVG(CASE WHEN l.q > 0 THEN 1.0 ELSE 0.0 END), 6) AS availability "
    "FROM l JOIN drug_formulary f ON f.drug_code = l.drug_code JOIN providers p ON p.provider_id = l.facility_id "
    "WHERE f.is_essential_medicine GROUP BY 1"))
def q21_essential(rel) -> DataFrame:
    l = latest_stock(rel.stock_levels).join(rel.drug_formulary.filter("is_essential_medicine").select("drug_code"), "drug_code") \
        .join(rel.providers.select(F.col("provider_id").alias("facility_id"), "facility_type"), "facility_id")
    return l.groupBy("facility_type").agg(F.count(F.lit(1)).alias("essential_drugs"),
                                          F.round(F.avg(F.when(F.col("quantity_on_hand") > 0, 1.0).otherwise(0.0)), 6)
                                          .alias("availability"))


@register("report_q22_dispensed_on_site", sql=(
    "SELECT dispensed_on_site, COUNT(*) AS prescriptions, round(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share "
    "FROM prescriptions GROUP BY 1"))
def q22_on_site(rel) -> DataFrame:
    g = rel.prescriptions.groupBy("dispensed_on_site").agg(F.count(F.lit(1)).alias("prescriptions"))
    tot = g.agg(F.sum("prescriptions").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select("dispensed_on_site", "prescriptions",
                                                F.round(F.col("prescriptions") / F.col("_t"), 6).alias("share"))


# -------------------------------------------------------------- diseases
@register("report_q23_top_diagnoses", sql=(
    "WITH g AS (SELECT p.county AS region, CAST(date_trunc('week', c.date_of_service) AS DATE) AS week, "
    "COALESCE(x.clinical_category, 'Other') AS clinical_category, COUNT(*) AS claims FROM claims c JOIN providers p "
    "ON p.provider_id = c.provider_id LEFT JOIN icd10_codes x ON x.icd10_code = c.diagnosis_code GROUP BY 1, 2, 3) "
    "SELECT region, week, clinical_category, claims, rk FROM (SELECT *, row_number() OVER (PARTITION BY region, week "
    "ORDER BY claims DESC, clinical_category) AS rk FROM g) WHERE rk <= 10"))
def q23_top_diagnoses(rel, k: int = 10) -> DataFrame:
    """Top-k diagnosis categories per region and week (windows over aggregated rows)."""
    dx = rel.icd10_codes.select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category")
    g = rel.claims.select("provider_id", "diagnosis_code", "date_of_service") \
        .join(rel.providers.select("provider_id", F.col("county").alias("region")), "provider_id").join(dx, "diagnosis_code", "left") \
        .groupBy("region", F.to_date(F.date_trunc("week", "date_of_service")).alias("week"),
                 F.coalesce("clinical_category", F.lit("Other")).alias("clinical_category")) \
        .agg(F.count(F.lit(1)).alias("claims"))
    rk = F.row_number().over(Window.partitionBy("region", "week").orderBy(F.desc("claims"), "clinical_category"))
    return g.withColumn("rk", rk).filter(F.col("rk") <= k)


@register("report_q24_seasonal", sql=(
    "SELECT month(c.date_of_service) AS month_of_year, dx.clinical_category, COUNT(*) AS claims FROM claims c "
    "JOIN icd10_codes dx ON dx.icd10_code = c.diagnosis_code WHERE dx.clinical_category IN ('Respiratory', 'Gastrointestinal', "
    "'Injury') GROUP BY 1, 2"))
def q24_seasonal(rel) -> DataFrame:
    dx = rel.icd10_codes.filter(F.col("clinical_category").isin("Respiratory", "Gastrointestinal", "Injury")) \
        .select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category")
    return rel.claims.select("diagnosis_code", "date_of_service").join(dx, "diagnosis_code") \
        .groupBy(F.month("date_of_service").alias("month_of_year"), "clinical_category").agg(F.count(F.lit(1)).alias("claims"))


@register("report_q25_diagnosis_spikes", sql=(
    "WITH w AS (SELECT provider_id, diagnosis_code, CAST(date_trunc('week', date_of_service) AS DATE) AS week, COUNT(*) AS n "
    "FROM claims GROUP BY 1, 2, 3), s AS (SELECT *, COUNT(*) OVER p AS k, SUM(n) OVER p AS s1, SUM(n * n) OVER p AS s2 FROM w "
    "WINDOW p AS (PARTITION BY provider_id, diagnosis_code ORDER BY week RANGE BETWEEN INTERVAL 56 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING)) "
    "SELECT provider_id, diagnosis_code, week, n AS claims, round((n - CAST(s1 AS DOUBLE) / k) / sqrt((CAST(s2 AS DOUBLE) - "
    "CAST(s1 AS DOUBLE) * s1 / k) / (k - 1)), 6) AS z_score FROM s WHERE k >= 3 AND (CAST(s2 AS DOUBLE) - CAST(s1 AS DOUBLE) * s1 / k) > 0 "
    "AND (n - CAST(s1 AS DOUBLE) / k) / sqrt((CAST(s2 AS DOUBLE) - CAST(s1 AS DOUBLE) * s1 / k) / (k - 1)) > 2"))
def q25_spikes(rel, z: float = 2.0) -> DataFrame:
    """Weekly count of a (provider, diagnosis) vs its previous 8 weeks (z-score
    from exact integer sums over a RANGE frame of weekly rows)."""
    w = rel.claims.groupBy("provider_id", "diagnosis_code", F.to_date(F.date_trunc("week", "date_of_service")).alias("week")) \
        .agg(F.count(F.lit(1)).alias("n")).withColumn("_d", F.unix_date("week"))
    p = Window.partitionBy("provider_id", "diagnosis_code").orderBy("_d").rangeBetween(-56, -7)
    k, s1, s2 = F.count(F.lit(1)).over(p), F.sum("n").over(p), F.sum(F.col("n") * F.col("n")).over(p)
    x = w.select("provider_id", "diagnosis_code", "week", "n", k.alias("k"), s1.cast("double").alias("s1"),
                 s2.cast("double").alias("s2"))
    var = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("k")) / (F.col("k") - 1)
    zc = (F.col("n") - F.col("s1") / F.col("k")) / F.sqrt(var)
    return x.filter((F.col("k") >= 3) & ((F.col("s2") - F.col("s1") * F.col("s1") / F.col("k")) > 0) & (zc > z)) \
        .select("provider_id", "diagnosis_code", "week", F.col("n").alias("claims"), F.round(zc, 6).alias("z_score"))


# ---------------------------------------------------------- portal views
def claims_page(claims: DataFrame, after: str | None = None, page_size: int = 50, status=None, provider_id=None,
                date_from=None, date_to=None) -> DataFrame:
    """Q26: filtered claims list, keyset pagination on claim_id (a page is the feature)."""
    c = claims
    if status:
        c = c.filter(F.col("status").isin(*([status] if isinstance(status, str) else status)))
    if provider_id:
        c = c.filter(F.col("provider_id") == provider_id)
    if date_from:
        c = c.filter(F.col("date_of_service") >= lit_date(date_from))
    if date_to:
        c = c.filter(F.col("date_of_service") <= lit_date(date_to))
    if after:
        c = c.filter(F.col("claim_id") > after)
    return c.orderBy("claim_id").limit(page_size)


register("report_q26_claims_page", sql=(
    "SELECT claim_id, status, date_of_service, CAST(amount_claimed AS DOUBLE) AS amount_claimed FROM claims "
    "WHERE status = 'pending_review' AND date_of_service >= DATE '2000-01-01' ORDER BY claim_id LIMIT 50"))(
    lambda rel: claims_page(rel.claims, status="pending_review", date_from=_dt.date(2000, 1, 1))
    .select("claim_id", "status", "date_of_service", "amount_claimed"))


@register("report_q27_claim_detail", sql=(
    "WITH p AS (SELECT claim_id, arg_max(fraud_probability, (predicted_at, prediction_id)) AS fraud_probability, "
    "arg_max(risk_tier, (predicted_at, prediction_id)) AS risk_tier FROM fraud_predictions GROUP BY 1), "
    "i AS (SELECT claim_id, arg_max(status, (opened_at, investigation_id)) AS case_status FROM fraud_investigations GROUP BY 1) "
    "SELECT c.claim_id, c.status, CAST(c.amount_claimed AS DOUBLE) AS amount_claimed, CAST(p.fraud_probability AS DOUBLE) "
    "AS fraud_probability, p.risk_tier, i.case_status FROM claims c LEFT JOIN p ON p.claim_id = c.claim_id "
    "LEFT JOIN i ON i.claim_id = c.claim_id"))
def q27_claim_detail(rel, claim_id: str | None = None) -> DataFrame:
    """Claim with newest score and case status; ``claim_id`` narrows it to one (a point lookup)."""
    c = rel.claims if claim_id is None else rel.claims.filter(F.col("claim_id") == claim_id)
    p = rel.fraud_predictions.groupBy("claim_id").agg(
        F.max_by(F.struct("fraud_probability", "risk_tier"), F.struct("predicted_at", "prediction_id")).alias("p"))
    i = rel.fraud_investigations.groupBy("claim_id").agg(
        F.max_by("status", F.struct("opened_at", "investigation_id")).alias("case_status"))
    return c.select("claim_id", "status", "amount_claimed").join(p, "claim_id", "left").join(i, "claim_id", "left") \
        .select("claim_id", "status", "amount_claimed", F.col("p.fraud_probability").alias("fraud_probability"),
                F.col("p.risk_tier").alias("risk_tier"), "case_status")


@register("report_q28_member_claims", sql=(
    "WITH u AS (" + _UTIL_SQL + ") SELECT c.claim_id, c.member_id, c.date_of_service, CAST(c.amount_claimed AS DOUBLE) AS "
    "amount_claimed, u.ytd_utilisation_pct FROM claims c LEFT JOIN u ON u.member_id = c.member_id AND "
    "u.utilisation_month = CAST(date_trunc('month', c.date_of_service) AS DATE)"))
def q28_member_claims(rel, member_id: str | None = None) -> DataFrame:
    c = rel.claims if member_id is None else rel.claims.filter(F.col("member_id") == member_id)
    u = member_utilisation(rel).select("member_id", "utilisation_month", "ytd_utilisation_pct")
    return c.select("claim_id", "member_id", "date_of_service", "amount_claimed") \
        .withColumn("utilisation_month", F.trunc("date_of_service", "month")) \
        .join(u, ["member_id", "utilisation_month"], "left").drop("utilisation_month")


@register("report_q29_fraud_queue", sql=(
    "SELECT i.investigation_id, i.claim_id, i.priority, CAST(p.fraud_probability AS DOUBLE) AS fraud_probability, p.risk_tier, "
    "i.opened_at FROM fraud_investigations i JOIN fraud_predictions p ON p.prediction_id = i.prediction_id "
    "WHERE i.status <> 'closed' ORDER BY fraud_probability DESC, investigation_id"))
def q29_fraud_queue(rel) -> DataFrame:
    i = rel.fraud_investigations.filter(F.col("status") != "closed") \
        .select("investigation_id", "claim_id", "prediction_id", "priority", "opened_at")
    p = rel.fraud_predictions.select("prediction_id", "fraud_probability", "risk_tier")
    return i.join(p, "prediction_id").select("investigation_id", "claim_id", "priority", "fraud_probability", "risk_tier",
                                             "opened_at").orderBy(F.desc("fraud_probability"), "investigation_id")


@register("report_q30_prediction_snapshot", sql=(
    "SELECT prediction_id, claim_id, CAST(fraud_probability AS DOUBLE) AS fraud_probability, "
    "CASE WHEN json_type(feature_snapshot) = 'OBJECT' THEN CAST(json_extract(feature_snapshot, '$.qty') AS INTEGER) END AS qty, "
    "CASE WHEN json_type(feature_snapshot) = 'OBJECT' THEN CAST(json_extract(feature_snapshot, '$.line') AS INTEGER) END AS line "
    "FROM fraud_predictions"))
def q30_snapshot(rel) -> DataFrame:
    """Prediction with values read from its JSON feature snapshot (VARIANT)."""
    v = F.parse_json("feature_snapshot")
    return rel.fraud_predictions.select("prediction_id", "claim_id", "fraud_probability",
                                        F.try_variant_get(v, "$.qty", "int").alias("qty"),
                                        F.try_variant_get(v, "$.line", "int").alias("line"))


@register("report_q31_monthly_summary", sql=(
    "SELECT CAST(date_trunc('month', date_of_service) AS DATE) AS month, COUNT(*) AS claims, "
    "COUNT(*) FILTER (WHERE status IN ('approved', 'partially_approved', 'paid')) AS approved_claims, "
    "round(CAST(COUNT(*) FILTER (WHERE status IN ('approved', 'partially_approved', 'paid')) AS DOUBLE) / COUNT(*), 6) AS approval_rate, "
    "CAST(SUM(amount_claimed) AS DOUBLE) AS claimed, CAST(SUM(amount_approved) AS DOUBLE) AS approved, "
    "COUNT(*) FILTER (WHERE status = 'flagged_fraud') AS flagged FROM claims GROUP BY 1"))
def q31_monthly_summary(rel) -> DataFrame:
    ok = F.col("status").isin(*K.APPROVED_LIKE)
    return rel.claims.groupBy(_month("date_of_service").alias("month")).agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(ok).alias("approved_claims"),
        F.round(F.count_if(ok) / F.count(F.lit(1)), 6).alias("approval_rate"),
        F.sum("amount_claimed").alias("claimed"), F.sum("amount_approved").alias("approved"),
        F.count_if(F.col("status") == "flagged_fraud").alias("flagged"))


@register("report_q32_plan_utilisation", sql=(
    "WITH u AS (" + _UTIL_SQL + "), y AS (SELECT member_id, year(utilisation_month) AS year, MAX(ytd_utilisation_pct) AS ytd "
    "FROM u GROUP BY 1, 2) SELECT p.plan_tier, y.year, COUNT(*) AS members, round(AVG(y.ytd), 6) AS avg_year_utilisation, "
    "COUNT(*) FILTER (WHERE y.ytd > 0.8) AS members_above_80pct FROM y JOIN members m ON m.member_id = y.member_id "
    "JOIN plans p ON p.plan_code = m.plan_code GROUP BY 1, 2"))
def q32_plan_utilisation(rel) -> DataFrame:
    y = member_utilisation(rel).groupBy("member_id", F.year("utilisation_month").alias("year")) \
        .agg(F.max("ytd_utilisation_pct").alias("ytd"))
    t = rel.members.select("member_id", "plan_code").join(rel.plans.select("plan_code", "plan_tier"), "plan_code")
    return y.join(t, "member_id").groupBy("plan_tier", "year").agg(
        F.count(F.lit(1)).alias("members"), F.round(F.avg("ytd"), 6).alias("avg_year_utilisation"),
        F.count_if(F.col("ytd") > 0.8).alias("members_above_80pct"))


@register("report_q33_lookup_index", sql=(
    "SELECT 'member' AS kind, member_id AS id, first_name || ' ' || last_name AS name, county FROM members UNION ALL "
    "SELECT 'provider', provider_id, provider_name, county FROM providers"))
def q33_lookup(rel, kind: str | None = None, key: str | None = None) -> DataFrame:
    """Member and provider lookup rows; filter by ``kind``/``key`` for a point lookup."""
    m = rel.members.select(F.lit("member").alias("kind"), F.col("member_id").alias("id"),
                           F.concat_ws(" ", "first_name", "last_name").alias("name"), "county")
    p = rel.providers.select(F.lit("provider").alias("kind"), F.col("provider_id").alias("id"),
                             F.col("provider_name").alias("name"), "county")
    out = m.unionByName(p)
    if kind:
        out = out.filter(F.col("kind") == kind)
    if key:
        out = out.filter(F.col("id") == key)
    return out


@register("report_q34_employer_exposure", sql=(
    "WITH paid AS (SELECT claim_id, SUM(amount_paid_kes) AS p FROM payments GROUP BY 1), "
    "e AS (SELECT m.employer_id, SUM(CASE WHEN c.status IN ('approved', 'partially_approved') THEN COALESCE(c.amount_approved, 0) "
    "- COALESCE(paid.p, 0) WHEN c.status IN ('submitted', 'pending_review') THEN c.amount_claimed ELSE 0 END) AS liability "
    "FROM claims c JOIN members m ON m.member_id = c.member_id LEFT JOIN paid ON paid.claim_id = c.claim_id "
    "WHERE m.employer_id IS NOT NULL GROUP BY 1), a AS (SELECT SUM(liability) / COUNT(*) AS mean_liability FROM e) "
    "SELECT e.employer_id, CAST(e.liability AS DOUBLE) AS liability, CAST(a.mean_liability AS DOUBLE) AS mean_liability "
    "FROM e CROSS JOIN a WHERE e.liability > a.mean_liability"))
def q34_exposure(rel) -> DataFrame:
    """Open liability per employer (approved not yet paid + pending claimed), above the employer mean."""
    paid = rel.payments.groupBy("claim_id").agg(F.sum("amount_paid_kes").alias("p"))
    c = rel.claims.select("claim_id", "member_id", "status", "amount_claimed", "amount_approved") \
        .join(rel.members.filter(F.col("employer_id").isNotNull()).select("member_id", "employer_id"), "member_id") \
        .join(paid, "claim_id", "left")
    st = F.col("status")
    li = (F.when(st.isin("approved", "partially_approved"),
                 F.coalesce(F.col("amount_approved"), F.lit(0)) - F.coalesce(F.col("p"), F.lit(0)))
          .when(st.isin("submitted", "pending_review"), F.col("amount_claimed")).otherwise(F.lit(0)))
    e = c.groupBy("employer_id").agg(F.sum(li).alias("liability"))
    a = e.agg((F.sum("liability") / F.count(F.lit(1))).alias("mean_liability"))
    return e.crossJoin(F.broadcast(a)).filter(F.col("liability") > F.col("mean_liability")) \
        .select("employer_id", F.col("liability").cast("double").alias("liability"),
                F.col("mean_liability").cast("double").alias("mean_liability"))
