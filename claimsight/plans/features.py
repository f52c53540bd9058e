"""Claim-level fraud features (X01-X13, X15), point-in-time: each value is known
when the claim is submitted (X02 over earlier days, X04 evidence recorded by
then, X08 and X10 verdicts and approvals before it).

Counts of a provider's claims over time (:func:`with_slot_counts`) are
differences of running sums over seconds within blocks of time, so a provider
holding a third of all claims is split into partitions of bounded size.  A member's
claims are dealt once and streamed through its windows in one task.  The as-of fraud history
of a provider (:func:`asof_rate`) prefix-sums day totals and scans only the current day row
by row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.exprs import lit_date
from ..registry import register
from ..session import checkpoint_dir
from ..sources.mapping import dealt, dealt_spine

HOUR = 3600
DAY = 86400


from ..operators.windows import (asof_rate, days_since_previous, with_days_since_previous, with_distinct_in_days,  # noqa: E402
                                 with_prior_sum, with_slot_counts)


# --------------------------------------------------------------- features
def claim_features(rel, verdict: bool = False) -> DataFrame:
    """X01-X11 for every claim, one row per claim; with ``verdict`` also ``label``, for the claims that :func:`label_set` keeps.

    The claims' rows are dealt twice, by provider and time and by member, and take each feature along where they
    are; evidence and verdicts meet them in the buckets of one stored claim spine.
    """
    rel = dealt_spine(rel)
    relations = ["claims", "vitals", "prescriptions"] + ["fraud_investigation_outcomes"] * verdict
    (claims, vitals, prescriptions, *outcomes), by = dealt(rel, *relations)
    key = [*by, "claim_id"]
    dx = F.broadcast(rel.icd10_codes.select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category"))   # reference table
    # Evidence recorded by the time of submission (first record per claim)
    c = claims.select(*key, "member_id", "provider_id", "diagnosis_code", "date_of_service", "date_submitted", "amount_claimed",
                      "amount_approved", "submitted_at", "updated_at")
    beside = [vitals.select(*key, F.col("_loaded_at").alias("_v")), prescriptions.select(*key, F.col("_loaded_at").alias("_rx"))]
    beside += [verdicts(o, by) for o in outcomes]
    every = c.withColumn("_claim", F.lit(True))
    for other in beside:
        every = every.unionByName(other, allowMissingColumns=True)
    of_claim = Window.partitionBy(*key)
    found = {"_v": F.min("_v").over(of_claim), "_rx": F.min("_rx").over(of_claim)} | ({"label": F.max("label").over(of_claim)} if verdict else {})
    c = every.withColumns(found).where("_claim").select(
        *c.drop(*by).columns, F.coalesce(F.col("_v") <= F.col("submitted_at"), F.lit(False)).alias("has_matching_vitals"),
        F.coalesce(F.col("_rx") <= F.col("submitted_at"), F.lit(False)).alias("has_matching_prescription"), *["label"] * verdict)
    # Provider rolling counts on submitted_at
    c = with_slot_counts(c, "provider_id", "submitted_at",
                         {"provider_claims_1h": HOUR, "provider_claims_6h": 6 * HOUR, "provider_claims_24h": DAY,
                          "provider_claims_7d": 7 * DAY, "provider_claims_30d": 30 * DAY})
    parts = int(c.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = c.where(F.col("member_id").isNotNull() & F.col("date_of_service").isNotNull()).repartition(parts, "member_id")
    # X11: days since the member's previous claim (velocity = its mean per member, see member_velocity)
    c = with_days_since_previous(c, "member_id", "date_of_service", "claim_id", "_gap")
    # Distinct providers of the member in the 7 days up to the claim
    c = with_distinct_in_days(c, "member_id", "date_of_service", "provider_id", 7, "_providers")
    # Amounts of the member's service year whose approval came before this claim was submitted (its own
    # approval never counts), over the plan's annual limit
    c = with_prior_sum(c.withColumn("_year", F.year("date_of_service")), ["member_id", "_year"], "updated_at", "submitted_at", "amount_approved", "_ytd")
    # a claim id that repeats has the member's features of each of its rows on each of them
    same = Window.partitionBy("member_id", "claim_id")
    c = c.withColumns({"_times": F.count(F.lit(1)).over(same)} | {x: F.collect_list(F.struct(x)).over(same) for x in ("_gap", "_ytd", "_providers")})
    n = F.col("_times")
    c = c.select("*", F.explode(F.sequence(F.lit(0), (n * n * n - 1).cast("int"))).alias("_i"))
    at = {"_gap": F.col("_i") % n, "_ytd": F.floor(F.col("_i") / n) % n, "_providers": F.floor(F.col("_i") / (n * n))}
    c = c.withColumns({x: F.get(x, i.cast("int"))[x] for x, i in at.items()})
    # the member's plan limit: rows stay where they are
    lim = rel.members.select("member_id", "plan_code").join(F.broadcast(rel.plans.select("plan_code", "annual_limit_kes")), "plan_code")
    c = c.join(lim.select("member_id", "annual_limit_kes"), "member_id", "left")
    # Z-score of the submission lag within the clinical category, over the claims submitted on
    # earlier days: day totals (categories x calendar days, which bound the broadcast) prefix-summed, then one equi-join back;
    # exact integer sums, then one fixed double formula (same bits on any partitioning)
    lag, category = F.datediff("date_submitted", "date_of_service"), F.coalesce("clinical_category", F.lit("Other"))
    day = rel.claims.select("diagnosis_code", "date_submitted", lag.alias("_lag")).join(dx, "diagnosis_code", "left") \
        .groupBy(category.alias("clinical_category"), "date_submitted").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_lag").alias("s"), F.sum(F.col("_lag") * F.col("_lag")).alias("s2"))
    past = Window.partitionBy("clinical_category").orderBy("date_submitted").rowsBetween(Window.unboundedPreceding, -1)
    st = day.select("clinical_category", "date_submitted", *[F.sum(x).over(past).alias("_" + x) for x in ("n", "s", "s2")]).select(
        "clinical_category", "date_submitted", (F.col("_s") / F.col("_n")).alias("_mu"),
        F.sqrt((F.col("_s2") - F.col("_s") * F.col("_s") / F.col("_n")) / F.nullif(F.col("_n") - 1, F.lit(0))).alias("_sd"))
    c = c.join(dx, "diagnosis_code", "left").withColumns({"clinical_category": category, "days_to_submit": lag}) \
        .join(F.broadcast(st), ["clinical_category", "date_submitted"], "left")
    # Amount / nearest threshold at or above it
    a = F.col("amount_claimed")
    prox = None
    for t in sorted(K.THRESHOLDS_KES, reverse=True):
        prox = F.when(a <= t, a.cast("double") / t) if prox is None else F.when(a <= t, a.cast("double") / t).otherwise(prox)
    own = F.when(F.col("updated_at") < F.col("submitted_at"), F.coalesce("amount_approved", F.lit(0))).otherwise(F.lit(0))
    counts = [f"provider_claims_{w}" for w in ("1h", "6h", "24h", "7d", "30d")]
    out = c.select(
        "provider_id", "claim_id", "member_id", "clinical_category", "days_to_submit",
        (F.col("days_to_submit") == 0).alias("is_same_day_submission"),
        F.round((F.col("days_to_submit") - F.col("_mu")) / F.nullif(F.col("_sd"), F.lit(0.0)), 6).alias("days_to_submit_zscore"),
        prox.alias("amount_vs_threshold_proximity"), "has_matching_vitals", "has_matching_prescription",
        ((F.col("_ytd") - own).cast("double") / F.col("annual_limit_kes").cast("double")).alias("member_ytd_utilisation_pct"),
        F.col("_gap").alias("days_since_prev_claim"), F.col("_providers").alias("member_provider_count_7d"), *counts,
        # Last 24 h against the provider's mean daily volume over 30 days
        (F.col("provider_claims_24h") / (F.col("provider_claims_30d") / F.lit(30.0))).alias("provider_24h_vs_30d_mean"), *["label"] * verdict)
    return out.where("label is not null") if verdict else out


FEATURE_COLUMNS = ["days_to_submit", "is_same_day_submission", "days_to_submit_zscore", "amount_vs_threshold_proximity",
                   "has_matching_vitals", "has_matching_prescription", "member_ytd_utilisation_pct", "days_since_prev_claim",
                   "provider_claims_1h", "provider_claims_6h", "provider_claims_24h", "provider_claims_7d",
                   "provider_claims_30d", "member_provider_count_7d", "provider_24h_vs_30d_mean"]


def _thr_sql() -> str:
    ts = sorted(K.THRESHOLDS_KES)
    return "CASE " + " ".join(f"WHEN amount_claimed <= {t} THEN CAST(amount_claimed AS DOUBLE) / {t}" for t in ts) + " END"


_FEAT_SQL = (
    "WITH c0 AS (SELECT c.*, COALESCE(dx.clinical_category, 'Other') AS clinical_category, "
    "CAST(date_diff('day', c.date_of_service, c.date_submitted) AS INTEGER) AS days_to_submit, "
    "epoch(c.submitted_at) AS t FROM claims c LEFT JOIN icd10_codes dx ON dx.icd10_code = c.diagnosis_code), "
    "st0 AS (SELECT DISTINCT clinical_category, date_submitted, COUNT(*) OVER past AS n, SUM(days_to_submit) OVER past AS s, "
    "SUM(days_to_submit * days_to_submit) OVER past AS s2 FROM c0 WINDOW past AS (PARTITION BY clinical_category ORDER BY date_submitted "
    "RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)), "
    "st AS (SELECT clinical_category, date_submitted, CAST(s AS DOUBLE) / n AS mu, "
    "sqrt((CAST(s2 AS DOUBLE) - CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n) / NULLIF(n - 1, 0)) AS sd FROM st0), "
    "lim AS (SELECT m.member_id, p.annual_limit_kes FROM members m JOIN plans p ON p.plan_code = m.plan_code) "
    "SELECT c0.claim_id, c0.member_id, c0.provider_id, c0.clinical_category, c0.days_to_submit, "
    "c0.days_to_submit = 0 AS is_same_day_submission, round((c0.days_to_submit - st.mu) / NULLIF(st.sd, 0), 6) AS days_to_submit_zscore, "
    f"{_thr_sql()} AS amount_vs_threshold_proximity, "
    "EXISTS (SELECT 1 FROM vitals v WHERE v.claim_id = c0.claim_id AND v._loaded_at <= c0.submitted_at) AS has_matching_vitals, "
    "EXISTS (SELECT 1 FROM prescriptions p WHERE p.claim_id = c0.claim_id AND p._loaded_at <= c0.submitted_at) AS has_matching_prescription, "
    "CAST(COALESCE(y.paid, 0) AS DOUBLE) / "
    "CAST(lim.annual_limit_kes AS DOUBLE) AS member_ytd_utilisation_pct, "
    "CAST(date_diff('day', lag(c0.date_of_service) OVER (PARTITION BY c0.member_id ORDER BY c0.date_of_service, c0.claim_id), "
    "c0.date_of_service) AS INTEGER) AS days_since_prev_claim, "
    + ", ".join(f"COUNT(*) OVER (PARTITION BY c0.provider_id ORDER BY c0.t RANGE BETWEEN {sec} PRECEDING AND CURRENT ROW) AS {n}"
                for n, sec in (("provider_claims_1h", HOUR), ("provider_claims_6h", 6 * HOUR), ("provider_claims_24h", DAY),
                               ("provider_claims_7d", 7 * DAY), ("provider_claims_30d", 30 * DAY))) + ", "
    "(SELECT COUNT(DISTINCT c2.provider_id) FROM claims c2 WHERE c2.member_id = c0.member_id AND c2.date_of_service "
    "BETWEEN c0.date_of_service - INTERVAL 6 DAY AND c0.date_of_service) AS member_provider_count_7d "
    "FROM c0 JOIN st ON st.clinical_category = c0.clinical_category AND st.date_submitted = c0.date_submitted "
    "LEFT JOIN (SELECT a.claim_id, SUM(b.amount_approved) AS paid FROM claims a JOIN claims b ON b.member_id = a.member_id "
    "AND year(b.date_of_service) = year(a.date_of_service) AND b.updated_at < a.submitted_at AND b.claim_id <> a.claim_id "
    "GROUP BY a.claim_id) y ON y.claim_id = c0.claim_id LEFT JOIN lim ON lim.member_id = c0.member_id")

register("feat_x01_x11_claim_features", sql=(
    "SELECT *, provider_claims_24h / (provider_claims_30d / 30.0) AS provider_24h_vs_30d_mean FROM (" + _FEAT_SQL + ")"))(
    claim_features)


@register("feat_x07_provider_peer_zscore", sql=(
    f"WITH c AS (SELECT c.provider_id, p.county, COALESCE(dx.clinical_category, 'Other') AS clinical_category, c.amount_claimed "
    "FROM claims c JOIN providers p ON p.provider_id = c.provider_id LEFT JOIN icd10_codes dx ON dx.icd10_code = c.diagnosis_code "
    f"WHERE c.date_of_service BETWEEN {K.AS_OF_DATE_SQL} - INTERVAL 29 DAY AND {K.AS_OF_DATE_SQL}), "
    "pm AS (SELECT provider_id, county, clinical_category, CAST(SUM(amount_claimed) AS DOUBLE) / COUNT(*) AS provider_mean "
    "FROM c GROUP BY 1, 2, 3), peer AS (SELECT county, clinical_category, AVG(provider_mean) AS peer_mean, "
    "STDDEV_SAMP(provider_mean) AS peer_sd FROM pm GROUP BY 1, 2) "
    "SELECT pm.provider_id, pm.county, pm.clinical_category, pm.provider_mean, round(peer.peer_mean, 6) AS peer_mean, "
    "round(peer.peer_sd, 6) AS peer_sd, round((pm.provider_mean - peer.peer_mean) / NULLIF(peer.peer_sd, 0), 6) "
    "AS provider_amount_zscore_30d FROM pm JOIN peer "
    "ON peer.county = pm.county AND peer.clinical_category = pm.clinical_category"))
def provider_peer_zscore(rel, as_of=K.AS_OF_DATE) -> DataFrame:
    """Provider 30-day mean claim vs providers of the same county and category."""
    d = lit_date(as_of)
    dx = rel.icd10_codes.select(F.col("icd10_code").alias("diagnosis_code"), "clinical_category")
    c = (rel.claims.filter(F.col("date_of_service").between(F.date_sub(d, 29), d))
         .select("provider_id", "diagnosis_code", "amount_claimed")
         .join(rel.providers.select("provider_id", "county"), "provider_id")
         .join(dx, "diagnosis_code", "left").withColumn("clinical_category", F.coalesce("clinical_category", F.lit("Other"))))
    pm = c.groupBy("provider_id", "county", "clinical_category").agg(
        (F.sum("amount_claimed").cast("double") / F.count(F.lit(1))).alias("provider_mean"))
    peer = pm.groupBy("county", "clinical_category").agg(F.avg("provider_mean").alias("peer_mean"),
                                                         F.stddev_samp("provider_mean").alias("peer_sd"))
    # peer statistics: one row per (county, category) - bounded by the dimensions
    return pm.join(peer, ["county", "clinical_category"]).select(
        "provider_id", "county", "clinical_category", "provider_mean", F.round("peer_mean", 6).alias("peer_mean"),
        F.round("peer_sd", 6).alias("peer_sd"),
        F.round((F.col("provider_mean") - F.col("peer_mean")) / F.nullif(F.col("peer_sd"), F.lit(0.0)), 6)
        .alias("provider_amount_zscore_30d"))


@register("feat_x08_provider_fraud_history", sql=(
    "WITH o AS (SELECT c.provider_id, x.confirmed_at, x.final_label = 'confirmed_fraud' AS f FROM fraud_investigation_outcomes x "
    "JOIN claims c ON c.claim_id = x.claim_id) "
    "SELECT c.claim_id, (SELECT COUNT(*) FROM o WHERE o.provider_id = c.provider_id AND o.confirmed_at < c.submitted_at) AS prior_events, "
    "(SELECT COUNT(*) FILTER (WHERE f) FROM o WHERE o.provider_id = c.provider_id AND o.confirmed_at < c.submitted_at) AS prior_flagged "
    "FROM claims c"))
def provider_fraud_history(rel) -> DataFrame:
    """Outcomes and confirmed frauds of the claim's provider confirmed
    strictly before the claim was submitted (as-of, no leakage)."""
    o = rel.fraud_investigation_outcomes.select("claim_id", "confirmed_at",
                                                (F.col("final_label") == "confirmed_fraud").alias("f")) \
        .join(rel.claims.select("claim_id", "provider_id"), "claim_id").drop("claim_id")
    return asof_rate(o, rel.claims.select("claim_id", "provider_id", "submitted_at"), "provider_id", "confirmed_at",
                     "submitted_at", "f", "claim_id")


@register("feat_x11_member_velocity", sql=(
    "SELECT member_id, COUNT(*) AS claims, AVG(gap) AS mean_days_between_claims FROM (SELECT member_id, "
    "date_diff('day', lag(date_of_service) OVER (PARTITION BY member_id ORDER BY date_of_service, claim_id), date_of_service) AS gap "
    "FROM claims) GROUP BY member_id"))
def member_velocity(rel) -> DataFrame:
    """Mean gap in days between consecutive claims of a member."""
    g = days_since_previous(rel.claims.select("member_id", "date_of_service", "claim_id"), "member_id",
                            "date_of_service", "claim_id")
    return g.groupBy("member_id").agg(F.count(F.lit(1)).alias("claims"), F.avg("gap").alias("mean_days_between_claims"))


def feature_snapshot(features: DataFrame, cols=None) -> DataFrame:
    """Feature vector of a claim as a JSON object (for predictions.feature_snapshot)."""
    cols = cols or ["days_to_submit", "amount_vs_threshold_proximity", "has_matching_vitals", "provider_claims_24h",
                    "member_provider_count_7d"]
    return features.select("claim_id", F.to_json(F.struct(*cols)).alias("feature_snapshot"))


register("feat_x12_snapshot", sql=None)(lambda rel: feature_snapshot(claim_features(rel)))


def verdicts(outcomes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``claim_id`` and ``label`` (confirmed 1 / legitimate 0) of the claims whose last verdict is one of the two; ``by`` as in :func:`dealt`."""
    last = outcomes.groupBy(*by, "claim_id").agg(F.max_by("final_label", F.struct("confirmed_at", "outcome_id")).alias("lbl"))
    return last.filter(F.col("lbl").isin("confirmed_fraud", "legitimate")) \
        .select(*by, "claim_id", (F.col("lbl") == "confirmed_fraud").cast("int").alias("label"))


def label_set(features: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Features with a verdict label (confirmed 1 / legitimate 0); unlabelled and inconclusive dropped."""
    return features.join(verdicts(outcomes), "claim_id")


def training_rows(rel) -> DataFrame:
    """Labelled features, written once: training and oversampling read them several times."""
    rows = claim_features(rel, verdict=True).select("claim_id", "label", *FEATURE_COLUMNS)
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark)}/labelled-{uuid.uuid4().hex}"
    rows.sort("claim_id").write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@register("feat_x13_labels", sql=(
    "SELECT claim_id, CAST(lbl = 'confirmed_fraud' AS INTEGER) AS label FROM (SELECT claim_id, "
    "arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes GROUP BY claim_id) "
    "WHERE lbl IN ('confirmed_fraud', 'legitimate') AND claim_id IN (SELECT claim_id FROM claims)"))
def labels(rel) -> DataFrame:
    return label_set(rel.claims.select("claim_id"), rel.fraud_investigation_outcomes)


def split_column(key: str = "claim_id", train: float = 0.70, valid: float = 0.15):
    """Repeatable 70/15/15 split from a hash of the key (independent of the
    label, hence stratified in expectation; no global sort or ranking)."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 10000
    return (F.when(h < train * 10000, "train").when(h < (train + valid) * 10000, "valid").otherwise("test")).alias("split")


@register("feat_x15_split", sql=(
    "WITH l AS (SELECT claim_id, CAST(lbl = 'confirmed_fraud' AS INTEGER) AS label FROM (SELECT claim_id, "
    "arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes GROUP BY claim_id) "
    "WHERE lbl IN ('confirmed_fraud', 'legitimate') AND claim_id IN (SELECT claim_id FROM claims)) "
    "SELECT label, CASE WHEN h < 7000 THEN 'train' WHEN h < 8500 THEN 'valid' ELSE 'test' END AS split, COUNT(*) AS n "
    "FROM (SELECT label, CAST(('0x' || substr(md5(claim_id), 1, 8)) AS BIGINT) % 10000 AS h FROM l) GROUP BY 1, 2"))
def split_counts(rel) -> DataFrame:
    return labels(rel).select("label", split_column()).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))
