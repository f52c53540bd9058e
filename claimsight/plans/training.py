"""Model training, evaluation, promotion and drift.

Evaluation never sorts all scores in one task: scores are first reduced to a
histogram over score values rounded to ``digits`` decimals (at most
10**digits + 1 rows however many claims are scored), and AUC, top-decile
precision and the precision-recall curve are cumulative sums over that
bounded histogram.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..registry import register
from .features import FEATURE_COLUMNS, label_set, split_column, training_rows


# ------------------------------------------------------------- training
def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """X14 (class-weight form): weight = N / (2 * n_class) per row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"))
    w = counts.crossJoin(F.broadcast(tot)).select(label, (F.col("_n") / (2.0 * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), label)   # two rows: bounded broadcast


def train_gbt(train: DataFrame, features=FEATURE_COLUMNS, label: str = "label", seed: int = 42, max_iter: int = 20):
    """Class-weighted gradient-boosted trees (``pyspark.ml``)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    cast = [F.col(c).cast("double").alias(c) for c in features]
    data = class_weights(train.select(label, *cast).fillna(0.0), label)
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", maxIter=max_iter, seed=seed)
    return Pipeline(stages=[asm, gbt]).fit(data)


def score(model, df: DataFrame, features=FEATURE_COLUMNS) -> DataFrame:
    """Probability of the positive class as ``score`` (vector element 1)."""
    from pyspark.ml.functions import vector_to_array
    cast = [F.col(c).cast("double").alias(c) for c in features]
    keep = [c for c in df.columns if c not in features]
    out = model.transform(df.select(*keep, *cast).fillna(0.0, subset=list(features)))
    return out.select(*keep, vector_to_array("probability")[1].alias("score"))


def feature_importances(model, columns=tuple(FEATURE_COLUMNS)) -> DataFrame:
    """One row per feature with its importance in the fitted tree ensemble (bounded by the feature list)."""
    from pyspark.sql import SparkSession
    stage = model.stages[-1] if hasattr(model, "stages") else model
    rows = sorted(zip(columns, (float(x) for x in stage.featureImportances.toArray()), strict=True), key=lambda r: (-r[1], r[0]))
    return SparkSession.active().createDataFrame([(f, w, i + 1) for i, (f, w) in enumerate(rows)], "feature string, importance double, rank int")


@register("train_x16_gbt_test_scores")
def gbt_test_scores(rel) -> DataFrame:
    """Train on the 70% split, score the 15% test split (rows-only check)."""
    lab = training_rows(rel).withColumn("split", split_column())
    model = train_gbt(lab.filter(F.col("split") == "train"))
    return score(model, lab.filter(F.col("split") == "test").select("claim_id", "label", *FEATURE_COLUMNS)) \
        .select("claim_id", "label", "score")


# ------------------------------------------------------------- evaluation
def score_histogram(scored: DataFrame, score_col: str = "score", label: str = "label", digits: int = 5) -> DataFrame:
    return scored.groupBy(F.round(F.col(score_col).cast("double"), digits).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def evaluate(scored: DataFrame, score_col: str = "score", label: str = "label", threshold: float = 0.5,
             digits: int = 5) -> DataFrame:
    """One row - AUC (rank-sum with ties), precision in the top 10% by
    score, precision / recall / F1 and confusion counts at ``threshold``.

    Scores are compared exactly: one row per distinct score, ranked inside its
    rounded value (``digits``), with sums over the rounded values before it (at
    most 10**digits + 1 rows).  A group of equal scores that crosses the top-10%
    cut counts in proportion.
    """
    exact = scored.groupBy(F.col(score_col).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).withColumn("b", F.round("s", digits))
    blocks = exact.groupBy("b").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    below, above = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("b", F.coalesce(F.sum("bn").over(below), F.lit(0)).alias("nb"),
                           F.coalesce(F.sum(F.col("bp") + F.col("bn")).over(above), F.lit(0)).alias("na"))
    up = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("b").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    h = exact.select("b", "s", "pos", "neg", F.coalesce(F.sum("neg").over(up), F.lit(0)).alias("ib"),
                     F.coalesce(F.sum(F.col("pos") + F.col("neg")).over(down), F.lit(0)).alias("ia")).join(blocks, "b")
    h = h.select("s", "pos", "neg", (F.col("nb") + F.col("ib")).alias("neg_below"), (F.col("na") + F.col("ia")).alias("n_above"))
    tot = h.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    h = h.crossJoin(F.broadcast(tot))
    cut = F.ceil((F.col("P") + F.col("N")) * 0.10)
    share = F.greatest(F.least(cut - F.col("n_above"), F.col("pos") + F.col("neg")), F.lit(0)) / (F.col("pos") + F.col("neg"))
    pred = F.col("s") >= threshold
    m = h.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))) / (F.first("P") * F.first("N"))).alias("auc_roc"),
        (F.sum(F.col("pos") * share) / F.first(cut)).alias("precision_at_10pct"),
        F.sum(F.when(pred, F.col("pos"))).alias("tp"), F.sum(F.when(pred, F.col("neg"))).alias("fp"),
        F.sum(F.when(~pred, F.col("pos"))).alias("fn"), F.sum(F.when(~pred, F.col("neg"))).alias("tn"))
    m = m.fillna(0, subset=["tp", "fp", "fn", "tn"])
    prec = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return m.select(F.round("auc_roc", 5).alias("auc_roc"), F.round("precision_at_10pct", 5).alias("precision_at_10pct"),
                    F.round(prec, 5).alias("precision"), F.round(rec, 5).alias("recall"),
                    F.round(2 * prec * rec / F.nullif(prec + rec, F.lit(0.0)), 5).alias("f1_score"),
                    "tp", "fp", "fn", "tn")


def labelled_prediction_scores(rel, version: str = "v1.0") -> DataFrame:
    """Scores of one model version against verdict labels (for evaluation)."""
    lab = label_set(rel.claims.select("claim_id"), rel.fraud_investigation_outcomes)
    p = rel.fraud_predictions.filter(F.col("model_version") == version).select("claim_id", F.col("fraud_probability").alias("score"))
    return p.join(lab, "claim_id")


_LAB_SQL = (
    "lab AS (SELECT claim_id, CAST(lbl = 'confirmed_fraud' AS INTEGER) AS label FROM (SELECT claim_id, "
    "arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes GROUP BY claim_id) "
    "WHERE lbl IN ('confirmed_fraud', 'legitimate') AND claim_id IN (SELECT claim_id FROM claims)), "
    "sc AS (SELECT p.claim_id, CAST(p.fraud_probability AS DOUBLE) AS score, lab.label FROM fraud_predictions p "
    "JOIN lab ON lab.claim_id = p.claim_id WHERE p.model_version = 'v1.0'), "
    "h AS (SELECT round(score, 5) AS s, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg "
    "FROM sc GROUP BY 1), "
    "h2 AS (SELECT s, pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    "AS neg_below, COALESCE(SUM(pos + neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_above FROM h), "
    "tot AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM h) ")

_EVAL_SQL = (
    "WITH " + _LAB_SQL + ", m AS (SELECT SUM(pos * (neg_below + 0.5 * neg)) / (MAX(P) * MAX(N)) AS auc_roc, "
    "SUM(pos * CAST(greatest(least(ceil((P + N) * 0.10) - n_above, pos + neg), 0) AS DOUBLE) / (pos + neg)) / MAX(ceil((P + N) * 0.10)) "
    "AS precision_at_10pct, COALESCE(SUM(pos) FILTER (WHERE s >= 0.5), 0) AS tp, "
    "COALESCE(SUM(neg) FILTER (WHERE s >= 0.5), 0) AS fp, COALESCE(SUM(pos) FILTER (WHERE s < 0.5), 0) AS fn, "
    "COALESCE(SUM(neg) FILTER (WHERE s < 0.5), 0) AS tn FROM h2 CROSS JOIN tot) "
    "SELECT round(auc_roc, 5) AS auc_roc, round(precision_at_10pct, 5) AS precision_at_10pct, "
    "round(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 5) AS precision, round(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 5) AS recall, "
    "round(2 * (CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0)) * (CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0)) / NULLIF("
    "CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) + CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0), 5) AS f1_score, "
    "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM m")
register("train_x17_metrics", sql=_EVAL_SQL)(lambda rel: evaluate(labelled_prediction_scores(rel)))


@register("train_x19_pr_curve", sql=(
    "WITH " + _LAB_SQL + " SELECT s AS threshold, "
    "SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, round(CAST(SUM(pos) OVER w AS DOUBLE) / SUM(pos + neg) OVER w, 6) AS precision, "
    "round(CAST(SUM(pos) OVER w AS DOUBLE) / (SELECT P FROM tot), 6) AS recall FROM h "
    "WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
def pr_curve(rel) -> DataFrame:
    """Precision and recall at every score threshold (score-descending cumulative sums)."""
    h = score_histogram(labelled_prediction_scores(rel))
    tot = h.agg(F.sum("pos").alias("P"))
    w = Window.orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    x = h.select(F.col("s").alias("threshold"), F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    return x.crossJoin(F.broadcast(tot)).select(
        "threshold", "tp", "fp", F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 6).alias("precision"),
        F.round(F.col("tp") / F.col("P"), 6).alias("recall"))


def performance_log_row(metrics: DataFrame, model_version: str, evaluation_date: _dt.date, train_count: DataFrame,
                        promoted: DataFrame) -> DataFrame:
    """Metrics as a model_performance_log row (the caller appends it)."""
    return metrics.crossJoin(train_count).crossJoin(promoted).select(
        F.concat(F.lit(model_version), F.lit("-"), F.lit(evaluation_date.isoformat())).alias("log_id"),
        F.lit(model_version).alias("model_version"), F.lit(evaluation_date.isoformat()).cast("date").alias("evaluation_date"),
        "training_claim_count", "training_fraud_count", "auc_roc", "precision_at_10pct", "recall", "f1_score", "promoted")


def promotion_decision(log: DataFrame, candidate: DataFrame, gain: float = K.AUC_PROMOTION_GAIN,
                       floor: float = K.AUC_FLOOR) -> DataFrame:
    """Promote when AUC > champion AUC + gain and AUC >= floor; the
    champion is the newest promoted row of the log (``max_by``)."""
    champ = log.filter(F.col("promoted")).agg(
        F.max_by(F.struct("model_version", "auc_roc"), F.struct("evaluation_date", "log_id")).alias("c")) \
        .select(F.col("c.model_version").alias("champion_version"), F.col("c.auc_roc").cast("double").alias("champion_auc"))
    a = F.col("auc_roc").cast("double")
    return candidate.select("auc_roc").crossJoin(champ).select(
        F.col("auc_roc").cast("double").alias("candidate_auc"), "champion_version", "champion_auc",
        ((F.col("champion_auc").isNull() | (a > F.col("champion_auc") + gain)) & (a >= floor)).alias("promote"))


@register("train_x18_promotion", sql=(
    "WITH e AS (" + _EVAL_SQL + "), c AS (SELECT arg_max(model_version, (evaluation_date, log_id)) AS champion_version, "
    "CAST(arg_max(auc_roc, (evaluation_date, log_id)) AS DOUBLE) AS champion_auc FROM model_performance_log WHERE promoted) "
    f"SELECT e.auc_roc AS candidate_auc, c.champion_version, c.champion_auc, (c.champion_auc IS NULL OR e.auc_roc > "
    f"c.champion_auc + {K.AUC_PROMOTION_GAIN}) AND e.auc_roc >= {K.AUC_FLOOR} AS promote FROM e CROSS JOIN c"))
def promotion(rel) -> DataFrame:
    return promotion_decision(rel.model_performance_log, evaluate(labelled_prediction_scores(rel)))


# ------------------------------------------------------------------ drift
@register("train_x20_weekly_accuracy", sql=(
    "WITH o AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes "
    "GROUP BY claim_id), s AS (SELECT CAST(date_trunc('week', p.predicted_at) AS DATE) AS week, "
    "CASE WHEN o.lbl = 'confirmed_fraud' THEN p.fraud_probability >= 0.5 WHEN o.lbl = 'legitimate' THEN p.fraud_probability < 0.5 END AS ok "
    "FROM fraud_predictions p JOIN o ON o.claim_id = p.claim_id WHERE p.model_version = 'v1.0'), "
    "wk AS (SELECT week, COUNT(ok) AS labelled, AVG(CAST(ok AS INTEGER)) AS accuracy FROM s GROUP BY week HAVING COUNT(ok) > 0), "
    "r AS (SELECT week, labelled, accuracy, AVG(accuracy) OVER (ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS acc4, "
    "lag(accuracy, 1) OVER (ORDER BY week) AS a1, lag(accuracy, 2) OVER (ORDER BY week) AS a2, "
    "lag(accuracy, 3) OVER (ORDER BY week) AS a3, lag(accuracy, 4) OVER (ORDER BY week) AS a4 FROM wk) "
    "SELECT week, labelled, round(accuracy, 6) AS accuracy, round(acc4, 6) AS rolling_4w_accuracy, "
    "COALESCE(accuracy < a1 AND a1 < a2 AND a2 < a3 AND a3 < a4, FALSE) AS four_weeks_falling FROM r"))
def weekly_accuracy(rel, version: str = "v1.0") -> DataFrame:
    """Weekly accuracy of labelled predictions, 4-week rolling mean and an
    alert when accuracy fell four weeks in a row (windows over one row per week)."""
    o = rel.fraud_investigation_outcomes.groupBy("claim_id").agg(
        F.max_by("final_label", F.struct("confirmed_at", "outcome_id")).alias("lbl"))
    p = rel.fraud_predictions.filter(F.col("model_version") == version).join(o, "claim_id")
    pos = F.col("fraud_probability") >= 0.5
    okc = F.when(F.col("lbl") == "confirmed_fraud", pos).when(F.col("lbl") == "legitimate", ~pos)
    wk = p.select(F.to_date(F.date_trunc("week", "predicted_at")).alias("week"), okc.alias("ok")) \
        .groupBy("week").agg(F.count("ok").alias("labelled"), F.avg(F.col("ok").cast("int")).alias("accuracy")) \
        .filter(F.col("labelled") > 0)
    w = Window.orderBy("week")   # one row per week: small by construction
    lags = [F.lag("accuracy", i).over(w) for i in range(1, 5)]
    falling = (F.col("accuracy") < lags[0]) & (lags[0] < lags[1]) & (lags[1] < lags[2]) & (lags[2] < lags[3])
    return wk.select("week", "labelled", F.round("accuracy", 6).alias("accuracy"),
                     F.round(F.avg("accuracy").over(w.rowsBetween(-3, 0)), 6).alias("rolling_4w_accuracy"),
                     F.coalesce(falling, F.lit(False)).alias("four_weeks_falling"))


@register("train_x20_auc_drop", sql=(
    "SELECT model_version, evaluation_date, CAST(auc_roc AS DOUBLE) AS auc_roc, CAST(prev_auc AS DOUBLE) AS prev_auc, "
    "prev_auc - auc_roc > 0.05 AS auc_drop_alert FROM (SELECT model_version, evaluation_date, auc_roc, "
    "lag(auc_roc) OVER (PARTITION BY model_version ORDER BY evaluation_date) AS prev_auc FROM model_performance_log)"))
def auc_drop(rel) -> DataFrame:
    """AUC drop of more than 0.05 against the previous evaluation of the same version."""
    w = Window.partitionBy("model_version").orderBy("evaluation_date")
    x = rel.model_performance_log.select("model_version", "evaluation_date", "auc_roc",
                                         F.lag("auc_roc").over(w).alias("prev_auc"))
    return x.withColumn("auc_drop_alert", (F.col("prev_auc") - F.col("auc_roc")) > 0.05)


@register("train_x21_score_vs_confirmed", sql=(
    "WITH o AS (SELECT claim_id, arg_max(final_label, (confirmed_at, outcome_id)) AS lbl FROM fraud_investigation_outcomes "
    "GROUP BY claim_id), wk AS (SELECT CAST(date_trunc('week', p.predicted_at) AS DATE) AS week, COUNT(*) AS predictions, "
    "AVG(CASE WHEN p.fraud_probability > 0.8 THEN 1.0 ELSE 0.0 END) AS high_score_share, "
    "AVG(CASE WHEN o.lbl = 'confirmed_fraud' THEN 1.0 ELSE 0.0 END) AS confirmed_share FROM fraud_predictions p "
    "LEFT JOIN o ON o.claim_id = p.claim_id WHERE p.model_version = 'v1.0' GROUP BY 1) "
    "SELECT week, predictions, round(high_score_share, 6) AS high_score_share, round(confirmed_share, 6) AS confirmed_share, "
    "round(high_score_share - lag(high_score_share) OVER (ORDER BY week), 6) AS high_share_change FROM wk"))
def score_vs_confirmed(rel, version: str = "v1.0") -> DataFrame:
    """Weekly share of scores above 0.8 against the confirmed-fraud share."""
    o = rel.fraud_investigation_outcomes.groupBy("claim_id").agg(
        F.max_by("final_label", F.struct("confirmed_at", "outcome_id")).alias("lbl"))
    p = rel.fraud_predictions.filter(F.col("model_version") == version).join(o, "claim_id", "left")
    wk = p.groupBy(F.to_date(F.date_trunc("week", "predicted_at")).alias("week")).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg(F.when(F.col("fraud_probability") > 0.8, 1.0).otherwise(0.0)).alias("hs"),
        F.avg(F.when(F.col("lbl") == "confirmed_fraud", 1.0).otherwise(0.0)).alias("cs"))
    w = Window.orderBy("week")
    return wk.select("week", "predictions", F.round("hs", 6).alias("high_score_share"),
                     F.round("cs", 6).alias("confirmed_share"),
                     F.round(F.col("hs") - F.lag("hs").over(w), 6).alias("high_share_change"))
