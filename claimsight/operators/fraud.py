"""Fraud patterns F01-F07 as DataFrame operators.

Scale notes: every rule keys its work on claim/member/provider ids; the only
windows partition by member (bounded per-member state after a distinct
pre-aggregation to (member, day, provider)); peer statistics are computed by
``groupBy`` and joined back (one row per county), never by an unpartitioned
window.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.exprs import phase_of, threshold_hit
from ..registry import register
from .quality import dup_sql, near_duplicate_pairs

PHASE_START = _dt.date(1995, 1, 1)   # first service date of the test data
PHASE_START_SQL = "DATE '1995-01-01'"


# ------------------------------------------------------------ F01 phantom
def phantom_claims(claims: DataFrame, vitals: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Consultation claims with neither vitals nor a prescription (two anti joins)."""
    c = claims.filter(F.col("procedure_code").startswith("CONS")) \
        .select("claim_id", "provider_id", "member_id", "date_of_service", "status")
    return (c.join(vitals.select("claim_id"), "claim_id", "left_anti")
            .join(prescriptions.select("claim_id"), "claim_id", "left_anti"))


@register("fraud_f01_claims", sql=(
    "SELECT c.claim_id, c.provider_id, c.member_id, c.date_of_service, c.status FROM claims c "
    "WHERE c.procedure_code LIKE 'CONS%' AND NOT EXISTS (SELECT 1 FROM vitals v WHERE v.claim_id = c.claim_id) "
    "AND NOT EXISTS (SELECT 1 FROM prescriptions p WHERE p.claim_id = c.claim_id)"))
def f01_claims(rel) -> DataFrame:
    return phantom_claims(rel.claims, rel.vitals, rel.prescriptions)


def phantom_provider_rates(claims, vitals, prescriptions, providers, min_ratio: float = 2.0) -> DataFrame:
    """Provider phantom rate vs the mean rate of providers in the same county.

    Per-provider counts come from one aggregate over claims with a flag column
    (the anti joins become a left join to the distinct claim ids that have
    evidence), the county means from a second aggregate over the provider rows.
    """
    cons = claims.filter(F.col("procedure_code").startswith("CONS")).select("claim_id", "provider_id")
    evid = vitals.select("claim_id").unionByName(prescriptions.select("claim_id")).distinct() \
        .withColumn("has_evidence", F.lit(True))
    flagged = cons.join(evid, "claim_id", "left")
    per = flagged.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("cons_claims"),
        F.count_if(F.col("has_evidence").isNull()).alias("phantom_claims"))
    per = per.join(providers.select("provider_id", "county"), "provider_id") \
        .withColumn("phantom_rate", F.col("phantom_claims") / F.col("cons_claims"))
    county = per.groupBy("county").agg(F.avg("phantom_rate").alias("county_mean_rate"))
    # one row per county (bounded by the region dimension): broadcast
    out = per.join(county, "county").withColumn(
        "rate_vs_peers", F.col("phantom_rate") / F.nullif(F.col("county_mean_rate"), F.lit(0.0)))
    return out.filter(F.col("rate_vs_peers") >= min_ratio).select(
        "provider_id", "county", "cons_claims", "phantom_claims", F.round("phantom_rate", 6).alias("phantom_rate"),
        F.round("county_mean_rate", 6).alias("county_mean_rate"), F.round("rate_vs_peers", 6).alias("rate_vs_peers"))


@register("fraud_f01_providers", sql=(
    "WITH cons AS (SELECT claim_id, provider_id FROM claims WHERE procedure_code LIKE 'CONS%'), "
    "per AS (SELECT provider_id, COUNT(*) AS cons_claims, COUNT(*) FILTER (WHERE NOT EXISTS ("
    "SELECT 1 FROM vitals v WHERE v.claim_id = cons.claim_id) AND NOT EXISTS (SELECT 1 FROM prescriptions p "
    "WHERE p.claim_id = cons.claim_id)) AS phantom_claims FROM cons GROUP BY provider_id), "
    "pr AS (SELECT per.*, pv.county, CAST(phantom_claims AS DOUBLE) / cons_claims AS phantom_rate "
    "FROM per JOIN providers pv ON pv.provider_id = per.provider_id), "
    "cm AS (SELECT county, AVG(phantom_rate) AS county_mean_rate FROM pr GROUP BY county) "
    "SELECT pr.provider_id, pr.county, pr.cons_claims, pr.phantom_claims, round(pr.phantom_rate, 6) AS phantom_rate, "
    "round(cm.county_mean_rate, 6) AS county_mean_rate, round(pr.phantom_rate / NULLIF(cm.county_mean_rate, 0), 6) "
    "AS rate_vs_peers FROM pr JOIN cm ON cm.county = pr.county "
    "WHERE pr.phantom_rate / NULLIF(cm.county_mean_rate, 0) >= 2.0"))
def f01_providers(rel) -> DataFrame:
    return phantom_provider_rates(rel.claims, rel.vitals, rel.prescriptions, rel.providers)


# ---------------------------------------------------------- F02 threshold
def threshold_claims(claims: DataFrame, bounds: str = "half_open") -> DataFrame:
    """Claims just below a payment threshold: [0.92 T, 0.99 T) (or closed)."""
    t = threshold_hit(F.col("amount_claimed"), bounds=bounds)
    return (claims.select("claim_id", "provider_id", "member_id", "amount_claimed", t.alias("threshold_kes"))
            .filter(F.col("threshold_kes").isNotNull()))


def _band_sql(closed: bool) -> str:
    lo, hi = K.THRESHOLD_FACTORS
    op = "<=" if closed else "<"
    cases = " ".join(f"WHEN amount_claimed >= {lo * t} AND amount_claimed {op} {hi * t} THEN {t}" for t in K.THRESHOLDS_KES)
    return (f"SELECT claim_id, provider_id, member_id, CAST(amount_claimed AS DOUBLE) AS amount_claimed, "
            f"threshold_kes FROM (SELECT *, CASE {cases} END AS threshold_kes FROM claims) WHERE threshold_kes IS NOT NULL")


register("fraud_f02_half_open", sql=_band_sql(False))(lambda rel: threshold_claims(rel.claims, "half_open"))
register("fraud_f02_closed", sql=_band_sql(True))(lambda rel: threshold_claims(rel.claims, "closed"))


@register("fraud_f02_providers", sql=(
    "SELECT provider_id, COUNT(*) AS claims, COUNT(threshold_kes) AS near_threshold, "
    "round(CAST(COUNT(threshold_kes) AS DOUBLE) / COUNT(*), 6) AS near_threshold_share FROM ("
    "SELECT provider_id, CASE " + " ".join(
        f"WHEN amount_claimed >= {K.THRESHOLD_FACTORS[0] * t} AND amount_claimed < {K.THRESHOLD_FACTORS[1] * t} THEN {t}"
        for t in K.THRESHOLDS_KES) + " END AS threshold_kes FROM claims) GROUP BY provider_id HAVING COUNT(threshold_kes) > 0"))
def f02_providers(rel) -> DataFrame:
    """Share of each provider's claims that sit just below a threshold (one aggregate)."""
    t = threshold_hit(F.col("amount_claimed"))
    g = rel.claims.groupBy("provider_id").agg(F.count(F.lit(1)).alias("claims"), F.count(t).alias("near_threshold"))
    return g.filter(F.col("near_threshold") > 0).withColumn(
        "near_threshold_share", F.round(F.col("near_threshold") / F.col("claims"), 6))


# ----------------------------------------------------- F03 benefit sharing
def benefit_sharing(claims: DataFrame, min_providers: int = 4, days: int = 7, same_diagnosis: bool = True) -> DataFrame:
    """Members (optionally per diagnosis) seen by >= ``min_providers`` distinct
    providers within ``days`` consecutive days; one row per window start day.

    Pre-aggregates to distinct (member[, diagnosis], day, provider); the
    forward distinct count uses the time-bucketed window layout, so a hot
    member is split into bounded partitions.
    """
    from .windows import rolling_counts
    keys = ["member_id"] + (["diagnosis_code"] if same_diagnosis else [])
    d = claims.select(*keys, "provider_id", F.col("date_of_service").cast("timestamp_ntz").alias("_t")).distinct() \
        .withColumn("_day", F.to_date("_t"))
    x = rolling_counts(d, keys, "_t", {"providers_in_window": (days - 1) * 86400}, "_day",
                       distinct_col="provider_id", forward=True).distinct()
    return (x.filter(F.col("providers_in_window") >= min_providers)
            .select(*keys, F.col("_day").alias("window_start"), "providers_in_window"))


def _sharing_sql(k: int, same_dx: bool) -> str:
    keys = "member_id, diagnosis_code" if same_dx else "member_id"
    dx = "AND c2.diagnosis_code = c1.diagnosis_code " if same_dx else ""
    sel = "c1.member_id, c1.diagnosis_code" if same_dx else "c1.member_id"
    return (f"SELECT {keys}, window_start, providers_in_window FROM ("
            f"SELECT {sel}, c1.date_of_service AS window_start, COUNT(DISTINCT c2.provider_id) AS providers_in_window "
            "FROM claims c1 JOIN claims c2 ON c2.member_id = c1.member_id " + dx +
            "AND c2.date_of_service BETWEEN c1.date_of_service AND c1.date_of_service + INTERVAL 6 DAY "
            f"GROUP BY {sel}, c1.date_of_service) WHERE providers_in_window >= {k}")


register("fraud_f03_same_diagnosis", sql=_sharing_sql(2, True))(
    lambda rel: benefit_sharing(rel.claims, 2, 7, True))
register("fraud_f03_any_diagnosis", sql=_sharing_sql(8, False))(
    lambda rel: benefit_sharing(rel.claims, 8, 7, False))


# -------------------------------------------------------- F04 duplicates
@register("fraud_f04_duplicates", sql=dup_sql(7, 0.5))
def f04_duplicates(rel) -> DataFrame:
    """Duplicate rule with a 7-day band and 50% gap (more pairs to verify the band join)."""
    return near_duplicate_pairs(rel.claims, 7, 0.5)


# ------------------------------------------------------------ F05 phases
def _phase_sql(col: str) -> str:
    n = f"date_diff('day', {PHASE_START_SQL}, {col})"
    return f"CASE WHEN {n} BETWEEN 0 AND 719 THEN CAST(floor({n} / 180) AS INTEGER) + 1 ELSE 4 END"


def phase_summary(claims: DataFrame, outcomes: DataFrame, start: _dt.date = PHASE_START) -> DataFrame:
    """Claims, confirmed-fraud claims and fraud share per phase (4 x 180 days)."""
    fraud = outcomes.filter(F.col("final_label") == "confirmed_fraud").select("claim_id").distinct() \
        .withColumn("is_fraud", F.lit(True))
    c = claims.select("claim_id", phase_of("date_of_service", start).alias("phase")).join(fraud, "claim_id", "left")
    return (c.groupBy("phase").agg(F.count(F.lit(1)).alias("claims"), F.count("is_fraud").alias("fraud_claims"))
            .withColumn("fraud_share", F.round(F.col("fraud_claims") / F.col("claims"), 6)))


@register("fraud_f05_phase_summary", sql=(
    f"SELECT {_phase_sql('c.date_of_service')} AS phase, COUNT(*) AS claims, "
    "COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM fraud_investigation_outcomes o WHERE o.claim_id = c.claim_id "
    "AND o.final_label = 'confirmed_fraud')) AS fraud_claims, "
    "round(CAST(COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM fraud_investigation_outcomes o WHERE o.claim_id = c.claim_id "
    "AND o.final_label = 'confirmed_fraud')) AS DOUBLE) / COUNT(*), 6) AS fraud_share FROM claims c GROUP BY 1"))
def f05_phase_summary(rel) -> DataFrame:
    return phase_summary(rel.claims, rel.fraud_investigation_outcomes)


@register("fraud_f06_phase1_outcomes", sql=(
    "SELECT o.outcome_id, o.claim_id, o.final_label, c.date_of_service FROM fraud_investigation_outcomes o "
    f"JOIN claims c ON c.claim_id = o.claim_id WHERE {_phase_sql('c.date_of_service')} = 1"))
def f06_phase1_outcomes(rel, start: _dt.date = PHASE_START) -> DataFrame:
    """Outcomes recorded for claims of phase 1 (the baseline phase must have none)."""
    c = rel.claims.filter(phase_of("date_of_service", start) == 1).select("claim_id", "date_of_service")
    return rel.fraud_investigation_outcomes.select("outcome_id", "claim_id", "final_label").join(c, "claim_id")


# ------------------------------------------------- F07 label distribution
def label_distribution(claims: DataFrame, investigations: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Claims per label group (confirmed_fraud / legitimate / inconclusive /
    open case / not investigated) with share of all claims and the mean claimed
    amount against the overall mean (selection bias of the labelled set)."""
    last = outcomes.groupBy("claim_id").agg(F.max_by("final_label", F.struct("confirmed_at", "outcome_id")).alias("lbl"))
    inv = investigations.select("claim_id").distinct().withColumn("inv", F.lit(True))
    c = claims.select("claim_id", F.col("amount_claimed").alias("amt")) \
        .join(last, "claim_id", "left").join(inv, "claim_id", "left")
    grp = F.coalesce(F.col("lbl"), F.when(F.col("inv"), "open_case").otherwise("not_investigated"))
    # exact decimal sums, converted once: the result does not depend on summation order
    g = c.groupBy(grp.alias("label_group")).agg(F.count(F.lit(1)).alias("claims"), F.sum("amt").cast("double").alias("s"))
    tot = c.agg(F.count(F.lit(1)).alias("n_all"), (F.sum("amt").cast("double") / F.count(F.lit(1))).alias("mean_all"))
    return g.crossJoin(F.broadcast(tot)).select(
        "label_group", "claims", F.round(F.col("claims") / F.col("n_all"), 6).alias("share_of_claims"),
        F.round(F.col("s") / F.col("claims"), 2).alias("mean_amount"),
        F.round((F.col("s") / F.col("claims")) / F.col("mean_all"), 6).alias("amount_vs_all"))


@register("fraud_f07_labels", sql=(
    "WITH last AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS lbl "
    "FROM fraud_investigation_outcomes GROUP BY claim_id), "
    "inv AS (SELECT DISTINCT claim_id FROM fraud_investigations), "
    "c AS (SELECT c.claim_id, c.amount_claimed AS amt, COALESCE(l.lbl, CASE WHEN i.claim_id IS NOT NULL "
    "THEN 'open_case' ELSE 'not_investigated' END) AS label_group FROM claims c LEFT JOIN last l ON l.claim_id = c.claim_id "
    "LEFT JOIN inv i ON i.claim_id = c.claim_id), tot AS (SELECT COUNT(*) AS n_all, CAST(SUM(amt) AS DOUBLE) / COUNT(*) AS mean_all FROM c) "
    "SELECT label_group, COUNT(*) AS claims, round(CAST(COUNT(*) AS DOUBLE) / MAX(n_all), 6) AS share_of_claims, "
    "round(CAST(SUM(amt) AS DOUBLE) / COUNT(*), 2) AS mean_amount, round((CAST(SUM(amt) AS DOUBLE) / COUNT(*)) / MAX(mean_all), 6) AS amount_vs_all "
    "FROM c CROSS JOIN tot GROUP BY label_group"))
def f07_labels(rel) -> DataFrame:
    return label_distribution(rel.claims, rel.fraud_investigations, rel.fraud_investigation_outcomes)
