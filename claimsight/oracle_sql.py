"""DuckDB statement of the test-data mapping (the oracle side).

The driver's oracle sees only the benchmark tables, so each oracle query is
``WITH <mapping> <body>``.  Every relation here is stated independently of
the DataFrame code in :mod:`claimsight.sources.mapping`; the two must agree
row for row, which the correctness run checks.
"""

from __future__ import annotations

import re

_MAPPING = r"""
m_claim_base AS (
  SELECT
    l.l_orderkey AS k_order, l.l_partkey AS k_part, l.l_suppkey AS k_supp,
    l.l_linenumber AS k_line, l.l_quantity AS k_qty, o.o_custkey AS k_cust,
    concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
              CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
              strftime(l.l_shipdate, '%Y%m%d')) AS claim_id,
    CAST(o.o_custkey AS VARCHAR) AS member_id,
    CAST(l.l_suppkey AS VARCHAR) AS provider_id,
    CAST(o.o_orderdate AS DATE) AS date_of_service,
    CAST(o.o_orderdate AS DATE) + CAST(l.l_linenumber * 15 AS INTEGER) AS date_submitted,
    CASE WHEN l.l_partkey % 50 < 20 THEN 'CONS-' WHEN l.l_partkey % 50 < 35 THEN 'LAB-' ELSE 'PROC-' END
      || lpad(CAST(l.l_partkey % 50 AS VARCHAR), 2, '0') AS procedure_code,
    'DX' || lpad(CAST(l.l_partkey % 25 AS VARCHAR), 2, '0') AS diagnosis_code,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(l.l_extendedprice AS DECIMAL(15,2)) AS amount_claimed,
    CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' OR l.l_returnflag = 'A' AND l.l_linestatus = 'F'
           THEN CAST(round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(15,2))
         WHEN l.l_orderkey % 89 = 0
           THEN CAST(round(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 + CAST(l.l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(15,2))
    END AS amount_approved,
    CASE l.l_returnflag || l.l_linestatus
      WHEN 'NO' THEN 'submitted' WHEN 'NF' THEN 'approved' WHEN 'AF' THEN 'paid'
      WHEN 'AO' THEN 'pending_review' WHEN 'RF' THEN 'rejected' ELSE 'flagged_fraud' END AS status,
    CASE l.l_linenumber % 4 WHEN 0 THEN 'portal' WHEN 1 THEN 'mobile' WHEN 2 THEN 'api' ELSE 'paper' END AS submission_channel,
    o.o_orderpriority = '1-URGENT' AS is_emergency,
    CASE WHEN l.l_extendedprice > 50000 AND l.l_orderkey % 3 <> 0 THEN 'PA-' || CAST(l.l_orderkey AS VARCHAR) END AS prior_auth_number
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
),
m_claim_ts AS (
  SELECT *,
    CAST(date_submitted AS TIMESTAMP) + to_hours(CAST(k_order % 24 AS BIGINT)) + to_minutes(CAST(k_part % 60 AS BIGINT)) AS submitted_at
  FROM m_claim_base
),
m_claim_full AS (
  SELECT *,
    CASE WHEN k_order % 83 = 0 THEN submitted_at - to_hours(1)
         WHEN status = 'submitted' THEN submitted_at
         ELSE submitted_at + to_days(CAST(2 * k_line AS INTEGER)) END AS updated_at
  FROM m_claim_ts
),
claims AS (
  SELECT claim_id, member_id, provider_id, date_of_service, date_submitted, procedure_code,
         diagnosis_code, quantity, amount_claimed, amount_approved, status, submission_channel,
         is_emergency, prior_auth_number, submitted_at, updated_at,
         updated_at + to_hours(1) AS _loaded_at
  FROM m_claim_full
),
plans AS (
  SELECT plan_code, plan_name, plan_tier,
         CAST(100000 * (r + 1) AS DECIMAL(15,2)) AS annual_limit_kes,
         CAST(60000 * (r + 1) AS DECIMAL(15,2)) AS inpatient_limit_kes,
         CAST(CASE WHEN plan_tier = 'standard' THEN 50000 ELSE 40000 END * (r + 1) AS DECIMAL(15,2)) AS outpatient_limit_kes,
         CAST(500 * r AS DECIMAL(15,2)) AS premium_monthly_kes,
         plan_tier = 'family' AS is_family_plan,
         TIMESTAMP '2001-08-02 04:00:00' AS _loaded_at
  FROM (
    SELECT c_mktsegment AS plan_code, c_mktsegment || ' cover' AS plan_name,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'basic' WHEN 'BUILDING' THEN 'corporate'
                WHEN 'FURNITURE' THEN 'family' WHEN 'HOUSEHOLD' THEN 'premium' ELSE 'standard' END AS plan_tier,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
                WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS r
    FROM customer GROUP BY c_mktsegment
  ) s
),
employers AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS employer_id, n_name || ' Holdings' AS employer_name,
         'sector ' || CAST(n_regionkey AS VARCHAR) AS industry, n_name AS county,
         CAST(n_nationkey * 10 AS INTEGER) AS member_count,
         DATE '1994-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS contract_start,
         CASE WHEN n_nationkey % 6 = 0 THEN DATE '1994-01-01' + CAST(n_nationkey * 30 - 1 AS INTEGER)
              WHEN n_nationkey % 4 = 1 THEN DATE '2003-12-31' END AS contract_end,
         n_nationkey % 8 <> 0 AS is_active,
         TIMESTAMP '2001-08-02 03:00:00' AS _loaded_at
  FROM nation
),
m_member_base AS (
  SELECT c.c_custkey AS k_cust, DATE '1994-01-01' + CAST(c.c_custkey % 900 AS INTEGER) AS enrol_date,
         c.*, n.n_name
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
),
members AS (
  SELECT CAST(c_custkey AS VARCHAR) AS member_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 250 = 0 THEN DATE '1870-05-05'
              ELSE DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) END AS date_of_birth,
         CASE WHEN c_custkey % 97 = 0 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_custkey % 113 = 0 THEN 'Staff Card'
              ELSE CASE c_custkey % 4 WHEN 0 THEN 'National ID' WHEN 1 THEN 'Passport' WHEN 2 THEN 'Alien ID' ELSE 'Military ID' END END AS id_type,
         CASE WHEN c_custkey % 151 = 0 THEN '00000000' WHEN c_custkey % 157 = 0 THEN 'TEST'
              ELSE lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') END AS id_number,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '+2547' || lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') END AS phone_number,
         n_name AS county,
         CAST(NULL AS VARCHAR) AS sub_county,
         enrol_date,
         CASE WHEN c_custkey % 350 = 0 THEN enrol_date
              WHEN c_custkey % 7 = 0 THEN enrol_date + 1500 END AS term_date,
         c_mktsegment AS plan_code,
         CASE WHEN c_custkey % 211 = 0 THEN '99'
              WHEN c_custkey % 10 < 3 THEN CAST(c_nationkey AS VARCHAR) END AS employer_id,
         NOT (c_custkey % 7 = 0) AS is_active,
         TIMESTAMP '2001-08-02 05:00:00' AS _loaded_at
  FROM m_member_base
),
providers AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS provider_id, s.s_name AS provider_name,
         'Level ' || CAST(1 + s.s_suppkey % 6 AS VARCHAR) AS facility_type,
         n.n_name AS county, CAST(NULL AS VARCHAR) AS sub_county,
         'LIC-' || CAST(s.s_suppkey AS VARCHAR) AS license_number,
         CASE s.s_suppkey % 20 WHEN 0 THEN 'Suspended' WHEN 1 THEN 'Terminated' WHEN 2 THEN 'Probation' ELSE 'Active' END AS accreditation_status,
         CAST(100 + s.s_suppkey % 400 AS INTEGER) AS panel_capacity,
         CASE WHEN s.s_suppkey % 47 = 0 THEN DATE '2002-01-01'
              ELSE DATE '1994-01-01' + CAST(s.s_suppkey % 365 AS INTEGER) END AS contract_start_date,
         CASE WHEN s.s_suppkey % 9 = 0 THEN DATE '1994-01-01' + CAST(s.s_suppkey % 365 AS INTEGER) END AS contract_end_date,
         CAST((s.s_suppkey * 13 % 1100) / 1000.0 AS DECIMAL(4,3)) AS risk_score,
         TIMESTAMP '2001-08-01 23:00:00' AS _loaded_at
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
),
drug_formulary AS (
  SELECT CAST(p_partkey AS VARCHAR) AS drug_code, p_name AS drug_name, p_type AS drug_class,
         p_size % 2 = 0 AS is_essential_medicine, p_size = 1 AS is_controlled_substance,
         CASE WHEN p_partkey % 199 = 0 THEN -CAST(p_retailprice AS DECIMAL(10,2))
              ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS unit_cost_kes,
         TIMESTAMP '2001-07-20 00:00:00' AS _loaded_at
  FROM part
),
icd10_codes AS (
  SELECT 'DX' || lpad(CAST(g AS VARCHAR), 2, '0') AS icd10_code,
         'Diagnosis group ' || CAST(g AS VARCHAR) AS description,
         CASE g % 5 WHEN 0 THEN 'Respiratory' WHEN 1 THEN 'Gastrointestinal' WHEN 2 THEN 'Injury'
              WHEN 3 THEN 'Cardiovascular' ELSE 'Other' END AS clinical_category,
         TIMESTAMP '2001-08-02 01:00:00' AS _loaded_at
  FROM (SELECT DISTINCT p_partkey % 25 AS g FROM part WHERE p_partkey % 25 <> 24) d
),
m_vitals_full AS (
  SELECT 'V-' || claim_id AS vitals_id, claim_id,
         CASE WHEN k_order % 101 = 0 THEN CAST(k_cust + 1 AS VARCHAR) ELSE member_id END AS member_id,
         date_of_service + CASE WHEN k_order % 19 = 0 THEN 3 ELSE 0 END AS date_taken,
         CAST(100 + k_qty AS SMALLINT) AS systolic_bp,
         CAST(55 + 2 * k_qty AS SMALLINT) AS diastolic_bp,
         CAST(CASE WHEN k_order % 97 = 0 THEN 310 ELSE 50 + 2 * k_qty END AS SMALLINT) AS heart_rate,
         CAST(CASE WHEN k_order % 31 = 0 THEN 98.6 ELSE (360 + k_part % 20) / 10.0 END AS DECIMAL(4,1)) AS temperature_c,
         CAST(40 + k_qty AS DECIMAL(5,1)) AS weight_kg,
         CAST(150 + k_part % 40 AS DECIMAL(5,1)) AS height_cm,
         CAST((CAST(40 + k_qty AS BIGINT) * 1000000 // ((150 + k_part % 40) * (150 + k_part % 40))
               + CASE WHEN k_order % 23 = 0 THEN 500 ELSE 0 END) / 100.0 AS DECIMAL(5,2)) AS bmi,
         CAST(100 - CAST(k_qty AS INTEGER) % 15 AS SMALLINT) AS spo2_pct,
         CAST(NULL AS VARCHAR) AS notes
  FROM m_claim_full
  WHERE procedure_code LIKE 'CONS%' AND (k_order + k_part) % 10 <> 0
),
vitals AS (
  SELECT *, CAST(date_taken AS TIMESTAMP) + to_hours(12) AS _loaded_at FROM m_vitals_full
),
m_rx AS (
  SELECT 'RX-' || claim_id AS prescription_id, claim_id,
         CASE WHEN k_order % 103 = 0 THEN CAST(k_cust + 1 AS VARCHAR) ELSE member_id END AS member_id,
         CASE WHEN k_order % 37 = 0 THEN 'X' || CAST(k_part AS VARCHAR) ELSE CAST(k_part AS VARCHAR) END AS drug_code,
         '1 tablet' AS dosage,
         CASE k_line % 3 WHEN 0 THEN 'once daily' WHEN 1 THEN 'twice daily' ELSE 'three times daily' END AS frequency,
         CAST(3 + k_part % 40 AS INTEGER) AS duration_days,
         CAST(k_qty AS INTEGER) AS quantity_dispensed,
         k_line % 2 = 1 AS dispensed_on_site,
         CASE WHEN k_order % 41 = 0 THEN CAST(date_of_service AS TIMESTAMP) - to_days(2)
              ELSE CAST(date_of_service AS TIMESTAMP) + to_hours(10) END AS prescribed_at
  FROM m_claim_full
  WHERE procedure_code NOT LIKE 'LAB%' AND (k_order + k_supp) % 7 <> 0
),
prescriptions AS (
  SELECT *, prescribed_at + to_hours(1) AS _loaded_at FROM m_rx
),
m_pay AS (
  SELECT 'PAY-' || claim_id AS payment_id, claim_id,
         CAST(coalesce(amount_approved, amount_claimed) * CASE WHEN k_order % 97 = 0 THEN 2 ELSE 1 END AS DECIMAL(15,2)) AS amount_paid_kes,
         CASE k_part % 4 WHEN 0 THEN 'EFT' WHEN 1 THEN 'MPESA' WHEN 2 THEN 'Cheque' ELSE 'Cash' END AS payment_method,
         'REF-' || CAST(k_order AS VARCHAR) || '-' || CAST(k_line AS VARCHAR) AS reference_number,
         CASE WHEN k_order % 43 = 0 THEN submitted_at - to_days(1) ELSE updated_at + to_days(1) END AS paid_at
  FROM m_claim_full
  WHERE (status IN ('approved', 'paid') AND k_order % 11 <> 0) OR (status = 'rejected' AND k_order % 47 = 0)
),
payments AS (
  SELECT *, paid_at AS _loaded_at FROM m_pay
),
stock_levels AS (
  SELECT 'ST-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey % 50 AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m%d') AS stock_id,
         CAST(l_suppkey AS VARCHAR) AS facility_id,
         CAST(l_partkey % 50 AS VARCHAR) AS drug_code,
         CAST(l_shipdate AS DATE) AS reported_date,
         CAST(sum(l_quantity) AS INTEGER) AS quantity_on_hand,
         20 AS reorder_level,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_hours(18) AS _loaded_at
  FROM lineitem
  GROUP BY l_suppkey, l_partkey % 50, l_shipdate
),
m_pred AS (
  SELECT k_order, k_part, k_supp, k_line, claim_id, submitted_at, amount_claimed, k_qty,
         model_version,
         CASE WHEN model_version = 'v1.0' THEN (k_order * 31 + k_part * 17 + k_supp * 7) % 1000
              ELSE (k_order * 13 + k_part * 7 + k_supp * 3) % 1000 END AS k_prob
  FROM (SELECT *, 'v1.0' AS model_version FROM m_claim_full
        UNION ALL
        SELECT *, 'v2.1' AS model_version FROM m_claim_full WHERE k_line = 1) v
),
m_pred_full AS (
  SELECT 'P-' || model_version || '-' || claim_id AS prediction_id, claim_id, model_version,
         CAST(k_prob / 1000.0 AS DECIMAL(6,5)) AS fraud_probability,
         CASE WHEN k_part % 50 = 0 THEN 'low'
              WHEN k_prob >= 800 THEN 'critical' WHEN k_prob >= 600 THEN 'high'
              WHEN k_prob >= 300 THEN 'medium' ELSE 'low' END AS risk_tier,
         CASE WHEN k_order % 59 = 0 THEN '[' || CAST(k_line AS VARCHAR) || ']'
              ELSE '{"qty": ' || CAST(CAST(k_qty AS INTEGER) AS VARCHAR) || ', "line": ' || CAST(k_line AS VARCHAR) || '}' END AS feature_snapshot,
         CASE WHEN k_order % 61 = 0 THEN submitted_at - to_hours(1)
              ELSE submitted_at + to_minutes(CAST(k_part % 90 AS BIGINT)) END AS predicted_at,
         k_order, k_part, k_supp, k_prob, amount_claimed
  FROM m_pred
),
fraud_predictions AS (
  SELECT prediction_id, claim_id, model_version, fraud_probability, risk_tier, feature_snapshot,
         predicted_at, predicted_at AS _loaded_at
  FROM m_pred_full
),
m_inv AS (
  SELECT 'INV-' || prediction_id AS investigation_id, claim_id,
         CASE WHEN k_order % 67 = 0 THEN prediction_id || '-x' ELSE prediction_id END AS prediction_id,
         'investigator_' || CAST(k_supp % 5 AS VARCHAR) AS assigned_to,
         predicted_at + to_days(1) AS opened_at,
         CASE WHEN k_order % 2 = 0 THEN 'closed'
              ELSE CASE k_part % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'in_progress' ELSE 'escalated' END END AS status,
         CASE WHEN k_prob >= 950 THEN 'critical' WHEN k_prob >= 900 THEN 'high' ELSE 'medium' END AS priority,
         CAST(NULL AS VARCHAR) AS notes,
         k_order, k_part, k_supp, amount_claimed
  FROM m_pred_full
  WHERE k_prob > 800
),
m_inv_full AS (
  SELECT *,
         CASE WHEN status <> 'closed' THEN NULL
              WHEN k_order % 71 = 0 THEN opened_at - to_hours(1)
              ELSE opened_at + to_days(CAST(5 + k_part % 30 AS INTEGER)) END AS closed_at
  FROM m_inv
),
fraud_investigations AS (
  SELECT investigation_id, claim_id, prediction_id, assigned_to, opened_at, closed_at, status,
         priority, notes, coalesce(closed_at, opened_at) AS _loaded_at
  FROM m_inv_full
),
m_out AS (
  SELECT 'OUT-' || investigation_id AS outcome_id,
         CASE WHEN k_order % 73 = 0 THEN claim_id || '-x' ELSE claim_id END AS claim_id,
         investigation_id,
         CASE k_part % 3 WHEN 0 THEN 'confirmed_fraud' WHEN 1 THEN 'legitimate' ELSE 'inconclusive' END AS final_label,
         k_order, k_part, k_supp, amount_claimed, opened_at, closed_at
  FROM m_inv_full
  WHERE (status = 'closed' AND k_order % 10 <> 4) OR (status <> 'closed' AND k_order % 9 = 0)
),
fraud_investigation_outcomes AS (
  SELECT outcome_id, claim_id, investigation_id, final_label,
         CASE WHEN final_label = 'confirmed_fraud' AND k_supp % 7 = 0 THEN NULL
              WHEN final_label = 'confirmed_fraud' THEN
                CASE k_supp % 5 WHEN 0 THEN 'phantom_billing' WHEN 1 THEN 'threshold_manip' WHEN 2 THEN 'benefit_sharing'
                     WHEN 3 THEN 'duplicate_claim' ELSE 'other' END
              WHEN final_label = 'legitimate' AND k_supp % 11 = 0 THEN 'other' END AS fraud_type,
         'investigator_' || CAST(k_supp % 5 AS VARCHAR) AS confirmed_by,
         coalesce(closed_at, opened_at + to_days(3)) AS confirmed_at,
         CASE WHEN final_label = 'confirmed_fraud' THEN amount_claimed END AS estimated_loss_kes,
         CASE WHEN final_label <> 'confirmed_fraud' THEN NULL
              WHEN k_order % 79 = 0 THEN CAST(amount_claimed + 100 AS DECIMAL(15,2))
              ELSE CAST(round(amount_claimed * 0.5, 2) AS DECIMAL(15,2)) END AS amount_recovered_kes,
         CAST(NULL AS VARCHAR) AS notes,
         coalesce(closed_at, opened_at + to_days(3)) AS _loaded_at
  FROM m_out
),
m_log AS (
  SELECT model_version, year(predicted_at) AS y,
         count(*) AS n, count_if(risk_tier IN ('high', 'critical')) AS n_hi,
         sum(CAST(round(fraud_probability * 1000) AS BIGINT)) AS s_prob,
         count_if(risk_tier = 'critical') AS n_crit
  FROM m_pred_full GROUP BY model_version, year(predicted_at)
),
model_performance_log AS (
  SELECT model_version || '-' || CAST(y AS VARCHAR) AS log_id, model_version,
         make_date(CAST(y AS INTEGER), 12, 31) AS evaluation_date,
         CAST(n AS INTEGER) AS training_claim_count,
         CAST(n_hi AS INTEGER) AS training_fraud_count,
         CAST((s_prob // n) / 1000.0 AS DECIMAL(6,5)) AS auc_roc,
         CAST((n_crit * 1000 // n) / 1000.0 AS DECIMAL(6,5)) AS precision_at_10pct,
         CAST((n_hi * 1000 // n) / 1000.0 AS DECIMAL(6,5)) AS recall,
         CAST(NULL AS DECIMAL(6,5)) AS f1_score,
         y % 2 = 0 AS promoted,
         CASE WHEN y % 2 = 0 AND y % 4 <> 0 THEN 'auc gain over champion' END AS promotion_reason,
         CASE WHEN y % 2 = 0 THEN 'models/' || model_version || '/' || CAST(y AS VARCHAR) END AS s3_artefact_path,
         make_timestamp(CAST(y AS BIGINT), 12, 31, 6, 0, 0.0) AS logged_at
  FROM m_log
),
dlq_events AS (
  SELECT 'DLQ-' || CAST(event_id AS VARCHAR) AS dlq_id,
         CASE user_id % 5 WHEN 0 THEN 'claims' WHEN 1 THEN 'claim_events' WHEN 2 THEN 'vitals'
              WHEN 3 THEN 'prescriptions' ELSE 'payments' END AS source_topic,
         ts AS failed_at,
         'E' || CAST(user_id % 3 AS VARCHAR) AS error_code,
         'schema mismatch' AS error_message,
         props AS raw_payload,
         CAST(event_id % 4 AS SMALLINT) AS retry_count,
         event_id % 2 = 0 AS resolved,
         CASE WHEN event_id % 2 = 0 AND event_id % 10 <> 0 THEN ts + to_hours(1)
              WHEN event_id % 2 = 1 AND event_id % 15 = 1 THEN ts + to_hours(2) END AS resolved_at,
         ts AS _loaded_at
  FROM events WHERE event_type = 'error'
),
m_ev AS (
  SELECT claim_id || '-e1' AS event_id, claim_id, 'submitted' AS event_type, CAST(NULL AS VARCHAR) AS previous_status,
         'submitted' AS new_status, submitted_at AS event_at,
         CASE WHEN submission_channel = 'api' THEN 'api' ELSE 'system' END AS triggered_by
  FROM m_claim_full WHERE k_order % 101 <> 0
  UNION ALL
  SELECT claim_id || '-e2', claim_id,
         CASE status WHEN 'approved' THEN 'approved' WHEN 'paid' THEN 'approved' WHEN 'pending_review' THEN 'status_changed'
              WHEN 'rejected' THEN 'rejected' ELSE 'flagged' END,
         'submitted', CASE WHEN status = 'paid' THEN 'approved' ELSE status END,
         updated_at - CASE WHEN status = 'paid' THEN to_days(1) ELSE to_days(0) END,
         CASE WHEN status IN ('approved', 'paid') THEN 'auto_approve' WHEN status = 'pending_review' THEN 'airflow' ELSE 'investigator' END
  FROM m_claim_full WHERE k_order % 101 <> 0 AND status <> 'submitted' AND NOT (status = 'flagged_fraud' AND k_order % 17 = 0)
  UNION ALL
  SELECT claim_id || '-e3', claim_id, 'paid', 'approved', 'paid', updated_at, 'system'
  FROM m_claim_full WHERE k_order % 101 <> 0 AND status = 'paid' AND k_order % 13 <> 0
  UNION ALL
  SELECT claim_id || '-e4', claim_id, 'paid', 'approved', 'paid', updated_at, 'system'
  FROM m_claim_full WHERE k_order % 101 <> 0 AND status = 'paid' AND k_order % 13 <> 0 AND k_order % 29 = 0
  UNION ALL
  SELECT claim_id || '-e5', claim_id, 'closed', 'rejected', 'closed', updated_at + to_days(1), 'system'
  FROM m_claim_full WHERE k_order % 101 <> 0 AND status = 'rejected'
  UNION ALL
  SELECT claim_id || '-e6', claim_id, 'appealed', 'closed', 'closed', updated_at + to_days(2), 'api'
  FROM m_claim_full WHERE k_order % 101 <> 0 AND status = 'rejected' AND k_order % 7 = 0
),
claim_events AS (
  SELECT event_id, claim_id, event_type, previous_status, new_status, event_at, triggered_by,
         '{"source": "' || triggered_by || '"}' AS metadata,
         event_at + to_minutes(5) AS _loaded_at
  FROM m_ev
)
"""


def _relations() -> dict[str, str]:
    """name -> statement of each relation of the mapping, in order."""
    parts = re.split(r"^(\w+) AS \($", _MAPPING.strip(), flags=re.MULTILINE)
    return {n: t.strip().removesuffix(",").rstrip().removesuffix(")") for n, t in zip(parts[1::2], parts[2::2], strict=True)}


RELATIONS = _relations()


def _named(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql)) & set(RELATIONS)


def with_mapping(body: str) -> str:
    """Prefix an oracle query with the mapping relations that it uses, directly or not.

    A relation that more than one place reads is materialised, so the planner
    sees its real size and computes it once.
    """
    need, todo = set(), _named(body)
    while todo:
        need |= todo
        todo = set().union(*(_named(RELATIONS[n]) for n in todo)) - need
    places = body + " ".join(RELATIONS[n] for n in need)
    shared = {n for n in need if len(re.findall(rf"\b{n}\b", places)) > 1}
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in shared else ''}({RELATIONS[n]})" for n in RELATIONS if n in need)
    b = body.strip()
    if not ctes:
        return b
    # DuckDB takes RECURSIVE after WITH for the whole list
    if b[:5].upper() == "WITH ":
        rest = b[5:].lstrip()
        if rest[:10].upper() == "RECURSIVE ":
            return "WITH RECURSIVE " + ctes + ",\n" + rest[10:]
        return "WITH " + ctes + ",\n" + rest
    return "WITH " + ctes + "\n" + b
