"""Fixed values that must equal the reference's for right results.

FIXED VALUES - value sets, thresholds and limits of the claims platform, stated
as text in natural order. They are data, not logic.
"""

from __future__ import annotations

import datetime as _dt

# ---- FIXED VALUES: accepted value sets -------------------------------------
PLAN_TIERS = ["basic", "standard", "premium", "family", "corporate"]
GENDERS = ["M", "F"]
ID_TYPES = ["National ID", "Passport", "Alien ID", "Military ID"]
ACCREDITATION = ["Active", "Probation", "Suspended", "Terminated"]
CLAIM_STATUSES = [
    "submitted", "pending_review", "approved", "partially_approved",
    "rejected", "paid", "flagged_fraud", "under_investigation", "closed",
]
CHANNELS = ["portal", "mobile", "api", "paper"]
EVENT_TYPES = [
    "submitted", "status_changed", "approved", "rejected", "paid",
    "flagged", "investigation_opened", "investigation_closed", "appealed", "closed",
]
ACTORS = ["system", "auto_approve", "investigator", "api", "airflow"]
PAYMENT_METHODS = ["EFT", "MPESA", "Cheque", "Cash"]
RISK_TIERS = ["low", "medium", "high", "critical"]
CASE_STATUSES = ["open", "in_progress", "pending_review", "closed", "escalated"]
PRIORITIES = ["low", "medium", "high", "critical"]
FINAL_LABELS = ["confirmed_fraud", "legitimate", "inconclusive"]
FRAUD_TYPES = ["phantom_billing", "threshold_manip", "benefit_sharing", "duplicate_claim", "other"]
PLACEHOLDER_IDS = ["0000000000", "1111111111", "9999999999", "TEST", "DUMMY", "N/A"]

# statuses grouped by meaning
APPROVED_LIKE = ["approved", "partially_approved", "paid"]
OPEN_CASE_STATUSES = ["open", "in_progress", "pending_review", "escalated"]
SAFE_FROM_BAD_PROVIDER = ["flagged_fraud", "under_investigation", "rejected", "closed"]

# ---- FIXED VALUES: thresholds ----------------------------------------------
RISK_CUTS = (0.30, 0.60, 0.80)                 # low < 0.30 <= medium < 0.60 <= high < 0.80 <= critical
PRIORITY_CUTS = (0.90, 0.95)                   # high >= 0.90, critical >= 0.95, else medium
AUTO_OPEN_PROBABILITY = 0.80
THRESHOLDS_KES = (5000, 10000, 25000)
THRESHOLD_FACTORS = (0.92, 0.99)
CLOSED_BANDS = ((4600, 4950, "5,000 KES threshold band"),
                (9200, 9900, "10,000 KES threshold band"),
                (23000, 24750, "25,000 KES threshold band"))
PRIOR_AUTH_KES = 50000
SUBMISSION_LAG_DAYS = 90
MAX_AGE_YEARS = 120
PREDICTION_SLA_MINUTES = 60
AUC_FLOOR = 0.70
AUC_PROMOTION_GAIN = 0.01
STALE_CASE_DAYS = 30
PHASE_DAYS = 180
PHASES = 4

# ---- as-of constants of the test mapping (replace now()/CURRENT_DATE) -------
AS_OF = _dt.datetime(2001, 8, 2, 0, 0, 0)
AS_OF_DATE = _dt.date(2001, 8, 2)
EVENTS_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2001-08-02 00:00:00'"
AS_OF_DATE_SQL = "DATE '2001-08-02'"
EVENTS_AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def sql_list(values) -> str:
    """Render a value list as a SQL IN-list literal."""
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)
