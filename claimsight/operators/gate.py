"""Quality gate, post-load report and monitoring (health, dead letters, profiles).

The gate is 17 counted checks.  Counting is fused where checks share a table:
the row-local claim checks are one ``count_if`` aggregate over one scan; the
join checks are ``left_anti`` / inner joins followed by a global count.  The
one-row results are unioned, so the whole gate is a single Spark job whose
only driver traffic is at most 17 small rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.exprs import lit_date, lit_ts
from ..registry import register
from ..sources.mapping import stored_spine

AS_OF = K.AS_OF
TS = K.AS_OF_SQL
D = K.AS_OF_DATE_SQL
ETS = K.EVENTS_AS_OF_SQL


class QualityGateError(RuntimeError):
    """Raised by :func:`assert_quality_gate` when a critical check fails."""


def _n(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _row(test_id: str, severity: str, table: str, description: str, counts: DataFrame, col: str = "n") -> DataFrame:
    return counts.select(F.lit(test_id).alias("test_id"), F.lit(severity).alias("severity"),
                         F.lit(table).alias("table_name"), F.col(col).cast("bigint").alias("violation_count"),
                         F.lit(description).alias("description"))


def _rows(counts: DataFrame, specs: list[tuple]) -> DataFrame:
    """Several checks counted by one aggregate -> one row each, from a single
    evaluation of that aggregate (an explode, not a union of re-computations)."""
    arr = F.array(*[F.struct(F.lit(t).alias("test_id"), F.lit(sev).alias("severity"), F.lit(tb).alias("table_name"),
                             F.col(c).cast("bigint").alias("violation_count"), F.lit(d).alias("description"))
                    for t, sev, tb, d, c in specs])
    return counts.select(F.explode(arr).alias("r")).select("r.*")


def gate_checks(rel, as_of: _dt.datetime = AS_OF, events_as_of: _dt.datetime = K.EVENTS_AS_OF) -> DataFrame:
    """All 17 gate checks with their counts (including zero counts).

    Fused layout: payments and events are aggregated per claim (partial
    aggregates map-side) and joined to one claim spine on ``claim_id``, so the
    claims are shuffled once for nine checks; investigations and outcomes are
    one left join for two checks.  The remaining checks are single scans or
    anti joins on other keys.  All read one stored claim spine.
    """
    rel = stored_spine(rel)
    c, m, p = rel.claims, rel.members, rel.providers
    spine = c.select("claim_id", "member_id", "provider_id", "status", "amount_claimed", "amount_approved",
                     "date_of_service", "date_submitted", "submitted_at", "_loaded_at")
    pay = (rel.payments.select("claim_id", "amount_paid_kes", "paid_at")
           .join(spine.select("claim_id", "submitted_at"), "claim_id")
           .groupBy("claim_id").agg(F.sum("amount_paid_kes").alias("_paid"), F.count(F.lit(1)).alias("_npay"),
                                    F.count_if(F.col("paid_at") < F.col("submitted_at")).alias("_early")))
    ev = rel.claim_events.groupBy("claim_id").agg(F.count(F.lit(1)).alias("_nev"),
                                                  F.count_if(F.col("event_type") == "paid").alias("_npaid_ev"))
    j = spine.join(pay, "claim_id", "left").join(ev, "claim_id", "left")
    st = F.col("status")
    crow = j.agg(
        F.count_if(F.col("amount_approved").isNotNull() & (F.col("amount_approved") > F.col("amount_claimed"))).alias("fin01"),
        F.count_if(F.col("amount_approved").isNotNull() & (F.col("_paid") > F.col("amount_approved"))).alias("fin02"),
        F.coalesce(F.sum(F.when(st.isin("rejected", "flagged_fraud"), F.col("_npay"))), F.lit(0)).alias("fin03"),
        F.count_if(F.col("_nev").isNull()).alias("evt01"),
        F.count_if((st == "paid") & F.coalesce(F.col("_npaid_ev") == 0, F.lit(True))).alias("evt02"),
        F.count_if(F.col("date_of_service") > lit_date(as_of.date())).alias("tmp01"),
        F.count_if(F.datediff("date_submitted", "date_of_service") > K.SUBMISSION_LAG_DAYS).alias("tmp02"),
        F.coalesce(F.sum("_early"), F.lit(0)).alias("tmp03"),
        F.max("_loaded_at").alias("claims_last"))
    inv, out = rel.fraud_investigations, rel.fraud_investigation_outcomes
    io = (inv.select("investigation_id", F.col("claim_id").alias("ic"), "status")
          .join(out.select("investigation_id", F.col("claim_id").alias("oc")), "investigation_id", "left")
          .agg(F.count_if(F.col("oc").isNotNull() & (F.col("oc") != F.col("ic"))).alias("fk04"),
               F.count_if((F.col("status") == "closed") & F.col("oc").isNull()).alias("frd02")))
    crow = crow.withColumn("frs01", F.when(F.col("claims_last").isNull()
                                           | (F.col("claims_last") < lit_ts(as_of - _dt.timedelta(hours=1))), 1).otherwise(0))
    members_last = m.agg(F.max("_loaded_at").alias("members_last"))
    parts = [
        _row("FK-01", "critical", "claims", "claims without a member",
             _n(c.select("member_id").join(m.select("member_id"), "member_id", "left_anti"))),
        _row("FK-02", "critical", "claims", "claims without a provider",
             _n(c.select("provider_id").join(p.select("provider_id"), "provider_id", "left_anti"))),
        _row("FK-03", "critical", "prescriptions", "prescriptions without a formulary drug",
             _n(rel.prescriptions.select("drug_code").join(rel.drug_formulary.select("drug_code"), "drug_code", "left_anti"))),
        _rows(io, [("FK-04", "critical", "fraud_investigation_outcomes", "outcome claim differs from the case claim", "fk04"),
                   ("FRD-02", "critical", "fraud_investigations", "closed case without outcome", "frd02")]),
        _rows(crow, [("FIN-01", "critical", "claims", "approved amount above claimed amount", "fin01"),
                     ("FIN-02", "critical", "claims", "payments above the approved amount", "fin02"),
                     ("FIN-03", "critical", "payments", "payments on rejected or flagged claims", "fin03"),
                     ("EVT-01", "critical", "claims", "claims without any event", "evt01"),
                     ("EVT-02", "critical", "claims", "paid claims without a paid event", "evt02"),
                     ("TMP-01", "warning", "claims", "service date in the future", "tmp01"),
                     ("TMP-02", "warning", "claims", "submitted more than 90 days after service", "tmp02"),
                     ("TMP-03", "warning", "payments", "payment before claim submission", "tmp03"),
                     ("FRS-01", "warning", "claims", "claims not loaded in the last hour", "frs01")]),
        _row("FRD-01", "critical", "fraud_investigation_outcomes", "confirmed fraud without fraud type",
             _n(out.filter((F.col("final_label") == "confirmed_fraud") & F.col("fraud_type").isNull()))),
        _row("FRS-02", "warning", "members", "members not loaded today",
             members_last.select(F.when(F.col("members_last").isNull()
                                        | (F.to_date("members_last") < lit_date(as_of.date())), 1)
                                 .otherwise(0).alias("n"))),
        _row("DLQ-01", "warning", "dlq_events", "unresolved dead letters older than 7 days",
             _n(rel.dlq_events.filter(~F.col("resolved")
                                      & (F.col("failed_at") < lit_ts(events_as_of - _dt.timedelta(days=7)))))),
    ]
    outdf = parts[0]
    for x in parts[1:]:
        outdf = outdf.unionByName(x)
    return outdf


def run_quality_gate(rel, as_of: _dt.datetime = AS_OF, events_as_of: _dt.datetime = K.EVENTS_AS_OF) -> DataFrame:
    """One row per failing check: (test_id, severity, table_name, violation_count, description)."""
    return gate_checks(rel, as_of, events_as_of).filter(F.col("violation_count") > 0)


def assert_quality_gate(rel, as_of: _dt.datetime = AS_OF) -> list:
    """Raise when a critical check fails; return the warnings otherwise.

    Only the failing checks (at most 17 rows) reach the driver.
    """
    rows = run_quality_gate(rel, as_of).collect()
    crit = [r for r in rows if r.severity == "critical"]
    if crit:
        raise QualityGateError("; ".join(f"{r.test_id}: {r.violation_count} {r.description}" for r in crit))
    return rows


_GATE_SQL = " UNION ALL ".join([
    "SELECT 'FK-01' AS test_id, 'critical' AS severity, 'claims' AS table_name, COUNT(*) AS violation_count, "
    "'claims without a member' AS description FROM claims c WHERE NOT EXISTS (SELECT 1 FROM members m WHERE m.member_id = c.member_id)",
    "SELECT 'FK-02', 'critical', 'claims', COUNT(*), 'claims without a provider' FROM claims c "
    "WHERE NOT EXISTS (SELECT 1 FROM providers p WHERE p.provider_id = c.provider_id)",
    "SELECT 'FK-03', 'critical', 'prescriptions', COUNT(*), 'prescriptions without a formulary drug' FROM prescriptions p "
    "WHERE NOT EXISTS (SELECT 1 FROM drug_formulary d WHERE d.drug_code = p.drug_code)",
    "SELECT 'FK-04', 'critical', 'fraud_investigation_outcomes', COUNT(*), 'outcome claim differs from the case claim' "
    "FROM fraud_investigation_outcomes o JOIN fraud_investigations i ON i.investigation_id = o.investigation_id "
    "WHERE o.claim_id <> i.claim_id",
    "SELECT 'FIN-01', 'critical', 'claims', COUNT(*), 'approved amount above claimed amount' FROM claims "
    "WHERE amount_approved IS NOT NULL AND amount_approved > amount_claimed",
    "SELECT 'FIN-02', 'critical', 'claims', COUNT(*), 'payments above the approved amount' FROM ("
    "SELECT 1 FROM claims JOIN (SELECT claim_id, SUM(amount_paid_kes) AS paid FROM payments GROUP BY claim_id) USING (claim_id) "
    "WHERE amount_approved < paid)",
    "SELECT 'FIN-03', 'critical', 'payments', COUNT(*), 'payments on rejected or flagged claims' FROM payments p "
    "JOIN claims c ON c.claim_id = p.claim_id WHERE c.status IN ('rejected', 'flagged_fraud')",
    "SELECT 'EVT-01', 'critical', 'claims', COUNT(*), 'claims without any event' FROM claims c "
    "WHERE NOT EXISTS (SELECT 1 FROM claim_events e WHERE e.claim_id = c.claim_id)",
    "SELECT 'EVT-02', 'critical', 'claims', COUNT(*), 'paid claims without a paid event' FROM claims c "
    "WHERE c.status = 'paid' AND NOT EXISTS (SELECT 1 FROM claim_events e WHERE e.claim_id = c.claim_id AND e.event_type = 'paid')",
    "SELECT 'FRD-01', 'critical', 'fraud_investigation_outcomes', COUNT(*), 'confirmed fraud without fraud type' "
    "FROM fraud_investigation_outcomes WHERE final_label = 'confirmed_fraud' AND fraud_type IS NULL",
    "SELECT 'FRD-02', 'critical', 'fraud_investigations', COUNT(*), 'closed case without outcome' FROM fraud_investigations i "
    "WHERE i.status = 'closed' AND NOT EXISTS (SELECT 1 FROM fraud_investigation_outcomes o WHERE o.investigation_id = i.investigation_id)",
    f"SELECT 'TMP-01', 'warning', 'claims', COUNT(*), 'service date in the future' FROM claims WHERE date_of_service > {D}",
    "SELECT 'TMP-02', 'warning', 'claims', COUNT(*), 'submitted more than 90 days after service' FROM claims "
    "WHERE date_diff('day', date_of_service, date_submitted) > 90",
    "SELECT 'TMP-03', 'warning', 'payments', COUNT(*), 'payment before claim submission' FROM payments p "
    "JOIN claims c ON c.claim_id = p.claim_id WHERE p.paid_at < c.submitted_at",
    f"SELECT 'FRS-01', 'warning', 'claims', CASE WHEN MAX(_loaded_at) IS NULL OR MAX(_loaded_at) < {TS} - INTERVAL 1 HOUR "
    "THEN 1 ELSE 0 END, 'claims not loaded in the last hour' FROM claims",
    f"SELECT 'FRS-02', 'warning', 'members', CASE WHEN MAX(_loaded_at) IS NULL OR CAST(MAX(_loaded_at) AS DATE) < {D} "
    "THEN 1 ELSE 0 END, 'members not loaded today' FROM members",
    "SELECT 'DLQ-01', 'warning', 'dlq_events', COUNT(*), 'unresolved dead letters older than 7 days' FROM dlq_events "
    f"WHERE resolved = FALSE AND failed_at < {ETS} - INTERVAL 7 DAY",
])

register("gate_checks", sql=f"SELECT test_id, severity, table_name, CAST(violation_count AS BIGINT) AS violation_count, "
         f"description FROM ({_GATE_SQL})")(gate_checks)
register("gate_failures", sql=f"SELECT test_id, severity, table_name, CAST(violation_count AS BIGINT) AS violation_count, "
         f"description FROM ({_GATE_SQL}) WHERE violation_count > 0")(run_quality_gate)


@register("gate_verdict", sql=(
    "SELECT COUNT(*) FILTER (WHERE severity = 'critical') AS critical_failures, "
    "COUNT(*) FILTER (WHERE severity = 'warning') AS warnings, "
    "CASE WHEN COUNT(*) FILTER (WHERE severity = 'critical') > 0 THEN 'BLOCK' "
    "WHEN COUNT(*) > 0 THEN 'WARN' ELSE 'PASS' END AS verdict "
    f"FROM ({_GATE_SQL}) WHERE violation_count > 0"))
def gate_verdict(rel) -> DataFrame:
    """assert_quality_gate as data: BLOCK on any critical failure, WARN on warnings."""
    g = run_quality_gate(rel).agg(F.count_if(F.col("severity") == "critical").alias("critical_failures"),
                                  F.count_if(F.col("severity") == "warning").alias("warnings"))
    return g.withColumn("verdict", F.when(F.col("critical_failures") > 0, "BLOCK")
                        .when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


# ---------------------------------------------------------------- post-load
#: names of two counts in the summary
_COUNT_NAMES = {"fraud_investigations": "investigations", "fraud_investigation_outcomes": "outcomes"}
_COUNTED = ("plans", "employers", "members", "providers", "claims", "claim_events", "vitals", "prescriptions",
            "payments", "fraud_investigations", "fraud_investigation_outcomes")


#: every table that a load fills
LOADED = (*_COUNTED, "icd10_codes", "drug_formulary", "stock_levels")


def post_load_summary(rel) -> DataFrame:
    """(check_name, status, value, detail): 11 row counts, 4 integrity checks, gate criticals."""
    rel = stored_spine(rel)
    parts = [rel.__getattribute__(t).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(f"row_count.{_COUNT_NAMES.get(t, t)}").alias("check_name"), F.lit("OK").alias("status"),
                     F.col("n").cast("string").alias("value"), F.lit(t).alias("detail"))
             for t in _COUNTED]

    def verdict(name, counts, bad, unit, detail):
        return counts.select(F.lit(name).alias("check_name"),
                             F.when(F.col("n") == 0, "PASS").otherwise(bad).alias("status"),
                             F.concat(F.col("n").cast("string"), F.lit(f" {unit}")).alias("value"),
                             F.lit(detail).alias("detail"))

    c = rel.claims
    parts.append(verdict("fk.claims_members", _n(c.select("member_id").join(rel.members.select("member_id"),
                                                                           "member_id", "left_anti")),
                         "FAIL", "orphans", "claims.member_id -> members"))
    parts.append(verdict("fk.prescriptions_formulary",
                         _n(rel.prescriptions.select("drug_code").join(rel.drug_formulary.select("drug_code"),
                                                                       "drug_code", "left_anti")),
                         "FAIL", "orphans", "prescriptions.drug_code -> drug_formulary"))
    parts.append(verdict("pk.claims_unique",
                         _n(c.groupBy("claim_id").count().filter(F.col("count") > 1)),
                         "FAIL", "duplicates", "claims primary key"))
    parts.append(verdict("business.paid_claims_have_payments",
                         _n(c.filter(F.col("status") == "paid").select("claim_id")
                            .join(rel.payments.select("claim_id"), "claim_id", "left_anti")),
                         "WARN", "unpaid", "paid claims -> payments"))
    parts.append(verdict("quality_gate.critical",
                         _n(run_quality_gate(rel).filter(F.col("severity") == "critical")),
                         "FAIL", "critical checks failing", "run_quality_gate"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _post_load_sql() -> str:
    rows = [f"SELECT 'row_count.{_COUNT_NAMES.get(t, t)}' AS check_name, 'OK' AS status, CAST(COUNT(*) AS VARCHAR) AS value, "
            f"'{t}' AS detail FROM {t}" for t in _COUNTED]

    def verdict(name, count_sql, bad, unit, detail):
        return (f"SELECT '{name}', CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END, CAST(n AS VARCHAR) || ' {unit}', "
                f"'{detail}' FROM (SELECT COUNT(*) AS n FROM ({count_sql}))")
    rows.append(verdict("fk.claims_members", "SELECT 1 FROM claims c WHERE NOT EXISTS (SELECT 1 FROM members m "
                        "WHERE m.member_id = c.member_id)", "FAIL", "orphans", "claims.member_id -> members"))
    rows.append(verdict("fk.prescriptions_formulary", "SELECT 1 FROM prescriptions p WHERE NOT EXISTS (SELECT 1 FROM "
                        "drug_formulary d WHERE d.drug_code = p.drug_code)", "FAIL", "orphans",
                        "prescriptions.drug_code -> drug_formulary"))
    rows.append(verdict("pk.claims_unique", "SELECT claim_id FROM claims GROUP BY claim_id HAVING COUNT(*) > 1",
                        "FAIL", "duplicates", "claims primary key"))
    rows.append(verdict("business.paid_claims_have_payments", "SELECT 1 FROM claims c WHERE c.status = 'paid' AND "
                        "NOT EXISTS (SELECT 1 FROM payments p WHERE p.claim_id = c.claim_id)", "WARN", "unpaid",
                        "paid claims -> payments"))
    rows.append(verdict("quality_gate.critical", f"SELECT 1 FROM ({_GATE_SQL}) WHERE violation_count > 0 AND "
                        "severity = 'critical'", "FAIL", "critical checks failing", "run_quality_gate"))
    return " UNION ALL ".join(rows)


register("post_load_summary", sql=_post_load_sql())(post_load_summary)
register("load_row_counts", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in sorted(LOADED)))(
    lambda rel: _row_counts(rel))


def _row_counts(rel) -> DataFrame:
    """Row count per loaded table, sorted by name (one global count per table)."""
    out = None
    for t in sorted(LOADED):
        d = getattr(rel, t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        out = d if out is None else out.unionByName(d)
    return out.orderBy("table_name")


# ------------------------------------------------------------------ health
_HEALTH = ("claims", "members", "providers", "plans", "drug_formulary", "fraud_predictions", "fraud_investigations")


def pipeline_health(rel, as_of: _dt.datetime = AS_OF) -> DataFrame:
    """(source, last_loaded, lag_minutes, row_count, status) for the seven load sources."""
    out = None
    for t in _HEALTH:
        d = getattr(rel, t).agg(F.max("_loaded_at").alias("last_loaded"), F.count(F.lit(1)).alias("row_count")) \
            .select(F.lit(t).alias("source"), "last_loaded", "row_count")
        out = d if out is None else out.unionByName(d)
    last, src = F.col("last_loaded"), F.col("source")
    status = (F.when(last.isNull(), "NEVER LOADED")
              .when((src == "claims") & (last < lit_ts(as_of - _dt.timedelta(hours=1))), "STALE")
              .when(src.isin("members", "providers", "plans") & (F.to_date(last) < lit_date(as_of.date())), "STALE")
              .when((src == "fraud_predictions") & (last < lit_ts(as_of - _dt.timedelta(hours=2))), "STALE")
              .otherwise("OK"))
    lag = F.round(F.timestamp_diff("SECOND", last, lit_ts(as_of)) / 60.0, 1)
    return out.select("source", "last_loaded", lag.alias("lag_minutes"), "row_count", status.alias("status"))


register("pipeline_health", sql=(
    "SELECT source, last_loaded, round(date_sub('second', last_loaded, " + TS + ") / 60.0, 1) AS lag_minutes, row_count, "
    "CASE WHEN last_loaded IS NULL THEN 'NEVER LOADED' "
    f"WHEN source = 'claims' AND last_loaded < {TS} - INTERVAL 1 HOUR THEN 'STALE' "
    f"WHEN source IN ('members', 'providers', 'plans') AND CAST(last_loaded AS DATE) < {D} THEN 'STALE' "
    f"WHEN source = 'fraud_predictions' AND last_loaded < {TS} - INTERVAL 2 HOUR THEN 'STALE' ELSE 'OK' END AS status "
    "FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS source, MAX(_loaded_at) AS last_loaded, COUNT(*) AS row_count FROM {t}"
                                  for t in _HEALTH) + ")"))(pipeline_health)


# ----------------------------------------------------------- dead letters
def dlq_summary(rel, as_of: _dt.datetime = K.EVENTS_AS_OF) -> DataFrame:
    """Unresolved dead letters per topic, deepest first (topic breaks ties)."""
    d = rel.dlq_events.filter(~F.col("resolved"))
    g = d.groupBy("source_topic").agg(F.count(F.lit(1)).alias("unresolved"), F.min("failed_at").alias("oldest_failure"),
                                      F.max("retry_count").alias("max_retries"))
    return (g.withColumn("breach_sla", F.col("oldest_failure") < lit_ts(as_of - _dt.timedelta(days=7)))
            .orderBy(F.desc("unresolved"), "source_topic"))


_DLQ_SQL = ("SELECT source_topic, COUNT(*) AS unresolved, MIN(failed_at) AS oldest_failure, MAX(retry_count) AS max_retries, "
            f"MIN(failed_at) < {ETS} - INTERVAL 7 DAY AS breach_sla FROM dlq_events WHERE resolved = FALSE "
            "GROUP BY source_topic")
register("dlq_summary", sql=_DLQ_SQL + " ORDER BY unresolved DESC, source_topic")(dlq_summary)


@register("dlq_alerts", sql=f"SELECT * FROM ({_DLQ_SQL}) WHERE unresolved > 10")
def dlq_alerts(rel, limit: int = 10) -> DataFrame:
    """Topics with more than ``limit`` unresolved dead letters."""
    return dlq_summary(rel).filter(F.col("unresolved") > limit)


# ------------------------------------------------------------ profiles
def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count, null_rate) from one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    g = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                                for c in df.columns])).alias("s")
    return g.select(F.col("__n").alias("row_count"), stack).select(
        F.lit(table_name).alias("table_name"), "s.column_name", "row_count", "s.null_count",
        F.round(F.col("s.null_count") / F.nullif(F.col("row_count"), F.lit(0)), 5).alias("null_rate"))


_CLAIM_COLS = ("claim_id member_id provider_id date_of_service date_submitted procedure_code diagnosis_code quantity "
               "amount_claimed amount_approved status submission_channel is_emergency prior_auth_number submitted_at "
               "updated_at _loaded_at").split()
register("null_profile_claims", sql=" UNION ALL ".join(
    f"SELECT 'claims' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count, "
    f"round(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / NULLIF(COUNT(*), 0), 5) AS null_rate FROM claims"
    for c in _CLAIM_COLS))(lambda rel: null_profile(rel.claims, "claims"))


def prediction_latency(rel) -> DataFrame:
    """Submission -> prediction latency per model version (minutes): mean, median, p90, max.

    ``percentile`` keeps a count per distinct value, and latencies are whole
    minutes, so the aggregate buffer is bounded by the latency range, not by
    the number of predictions.
    """
    j = rel.fraud_predictions.select("claim_id", "model_version", "predicted_at") \
        .join(rel.claims.select("claim_id", "submitted_at"), "claim_id")
    lat = F.floor(F.timestamp_diff("SECOND", F.col("submitted_at"), F.col("predicted_at")) / 60).alias("m")
    return (j.select("model_version", lat).groupBy("model_version")
            .agg(F.count(F.lit(1)).alias("predictions"), F.round(F.avg("m"), 3).alias("avg_minutes"),
                 F.percentile("m", 0.5).alias("median_minutes"), F.percentile("m", 0.9).alias("p90_minutes"),
                 F.max("m").alias("max_minutes"), F.count_if(F.col("m") > K.PREDICTION_SLA_MINUTES).alias("late")))


register("prediction_latency", sql=(
    "SELECT model_version, COUNT(*) AS predictions, round(AVG(m), 3) AS avg_minutes, "
    "quantile_cont(m, 0.5) AS median_minutes, quantile_cont(m, 0.9) AS p90_minutes, MAX(m) AS max_minutes, "
    f"COUNT(*) FILTER (WHERE m > {K.PREDICTION_SLA_MINUTES}) AS late FROM ("
    "SELECT fp.model_version, CAST(floor(date_sub('second', c.submitted_at, fp.predicted_at) / 60) AS BIGINT) AS m "
    "FROM fraud_predictions fp JOIN claims c ON c.claim_id = fp.claim_id) GROUP BY model_version"))(prediction_latency)
