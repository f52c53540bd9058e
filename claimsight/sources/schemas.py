"""Declared schemas of the 17 raw tables (no inference on load)."""

from __future__ import annotations

import re

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, ShortType, StringType, StructField,
                               StructType, TimestampNTZType)

_DDL = {
    "plans": "plan_code string!, plan_name string!, plan_tier string!, annual_limit_kes decimal(15,2)!, "
             "inpatient_limit_kes decimal(15,2)!, outpatient_limit_kes decimal(15,2)!, premium_monthly_kes decimal(15,2)!, "
             "is_family_plan boolean!, _loaded_at timestamp!",
    "employers": "employer_id string!, employer_name string!, industry string, county string, member_count int, "
                 "contract_start date!, contract_end date, is_active boolean!, _loaded_at timestamp!",
    "members": "member_id string!, first_name string!, last_name string!, date_of_birth date!, gender string!, "
               "id_type string!, id_number string!, phone_number string, county string!, sub_county string, enrol_date date!, "
               "term_date date, plan_code string!, employer_id string, is_active boolean!, _loaded_at timestamp!",
    "providers": "provider_id string!, provider_name string!, facility_type string!, county string!, sub_county string, "
                 "license_number string!, accreditation_status string!, panel_capacity int, contract_start_date date!, "
                 "contract_end_date date, risk_score decimal(4,3), _loaded_at timestamp!",
    "drug_formulary": "drug_code string!, drug_name string!, drug_class string!, is_essential_medicine boolean!, "
                      "is_controlled_substance boolean!, unit_cost_kes decimal(10,2), _loaded_at timestamp!",
    "icd10_codes": "icd10_code string!, description string!, clinical_category string!, _loaded_at timestamp!",
    "claims": "claim_id string!, member_id string!, provider_id string!, date_of_service date!, date_submitted date!, "
              "procedure_code string!, diagnosis_code string!, quantity int!, amount_claimed decimal(15,2)!, "
              "amount_approved decimal(15,2), status string!, submission_channel string!, is_emergency boolean!, "
              "prior_auth_number string, submitted_at timestamp!, updated_at timestamp!, _loaded_at timestamp!",
    "claim_events": "event_id string!, claim_id string!, event_type string!, previous_status string, new_status string!, "
                    "event_at timestamp!, triggered_by string!, metadata string, _loaded_at timestamp!",
    "vitals": "vitals_id string!, claim_id string!, member_id string!, date_taken date!, systolic_bp smallint, "
              "diastolic_bp smallint, heart_rate smallint, temperature_c decimal(4,1), weight_kg decimal(5,1), "
              "height_cm decimal(5,1), bmi decimal(5,2), spo2_pct smallint, notes string, _loaded_at timestamp!",
    "prescriptions": "prescription_id string!, claim_id string!, member_id string!, drug_code string!, dosage string!, "
                     "frequency string!, duration_days int!, quantity_dispensed int, dispensed_on_site boolean!, "
                     "prescribed_at timestamp!, _loaded_at timestamp!",
    "payments": "payment_id string!, claim_id string!, amount_paid_kes decimal(15,2)!, payment_method string!, "
                "reference_number string, paid_at timestamp!, _loaded_at timestamp!",
    "stock_levels": "stock_id string!, facility_id string!, drug_code string!, quantity_on_hand int!, reorder_level int!, "
                    "reported_date date!, _loaded_at timestamp!",
    "fraud_predictions": "prediction_id string!, claim_id string!, model_version string!, fraud_probability decimal(6,5)!, "
                         "risk_tier string!, feature_snapshot string!, predicted_at timestamp!, _loaded_at timestamp!",
    "fraud_investigations": "investigation_id string!, claim_id string!, prediction_id string, assigned_to string!, "
                            "opened_at timestamp!, closed_at timestamp, status string!, priority string!, notes string, "
                            "_loaded_at timestamp!",
    "fraud_investigation_outcomes": "outcome_id string!, claim_id string!, investigation_id string!, final_label string!, "
                                    "fraud_type string, confirmed_by string!, confirmed_at timestamp!, "
                                    "estimated_loss_kes decimal(15,2), amount_recovered_kes decimal(15,2), notes string, "
                                    "_loaded_at timestamp!",
    "model_performance_log": "log_id string!, model_version string!, evaluation_date date!, training_claim_count int!, "
                             "training_fraud_count int!, auc_roc decimal(6,5)!, precision_at_10pct decimal(6,5), "
                             "recall decimal(6,5), f1_score decimal(6,5), promoted boolean!, promotion_reason string, "
                             "s3_artefact_path string, logged_at timestamp!",
    "dlq_events": "dlq_id string!, source_topic string!, failed_at timestamp!, error_code string, error_message string, "
                  "raw_payload string!, retry_count smallint!, resolved boolean!, resolved_at timestamp, _loaded_at timestamp!",
}

_SIMPLE = {"string": StringType(), "date": DateType(), "timestamp": TimestampNTZType(), "boolean": BooleanType(),
           "int": IntegerType(), "smallint": ShortType()}


def _field(spec: str) -> StructField:
    name, typ = spec.strip().split(" ", 1)
    required = typ.endswith("!")
    typ = typ.rstrip("!")
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", typ)
    dt = DecimalType(int(m.group(1)), int(m.group(2))) if m else _SIMPLE[typ]
    return StructField(name, dt, nullable=not required)


def _split(ddl: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in ddl:
        depth += ch == "("
        depth -= ch == ")"
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return out + [cur]


SCHEMAS: dict[str, StructType] = {t: StructType([_field(s) for s in _split(d)]) for t, d in _DDL.items()}
REQUIRED: dict[str, list[str]] = {t: [f.name for f in s.fields if not f.nullable] for t, s in SCHEMAS.items()}
