"""Reusable Column expressions (all JVM-side, no Python UDF)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_ts(ts: _dt.datetime) -> Column:
    """A timestamp literal of the same flavour as the data (TIMESTAMP_NTZ)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def lit_date(d: _dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def risk_tier_of(p) -> Column:
    """Expected tier for a probability: low < 0.30 <= medium < 0.60 <= high < 0.80 <= critical."""
    p = col(p)
    lo, mid, hi = K.RISK_CUTS
    return (F.when(p.isNull(), None).when(p < lo, "low").when(p < mid, "medium")
            .when(p < hi, "high").otherwise("critical"))


def priority_of(p) -> Column:
    """Case priority for an auto-opened case: critical >= 0.95, high >= 0.90, else medium."""
    p = col(p)
    hi, crit = K.PRIORITY_CUTS
    return F.when(p >= crit, "critical").when(p >= hi, "high").otherwise("medium")


def closed_band(amount) -> Column:
    """Label of the closed threshold band an amount falls in, else NULL."""
    a = col(amount)
    expr = None
    for lo, hi, label in K.CLOSED_BANDS:
        cond = a.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def threshold_hit(amount, factors=K.THRESHOLD_FACTORS, thresholds=K.THRESHOLDS_KES,
                  bounds: str = "half_open") -> Column:
    """Threshold the amount sits just below ([lo*T, hi*T) or closed), else NULL."""
    a = col(amount)
    lo_f, hi_f = factors
    expr = None
    for t in thresholds:
        lo, hi = lo_f * t, hi_f * t
        cond = (a >= lo) & ((a <= hi) if bounds == "closed" else (a < hi))
        expr = F.when(cond, F.lit(t)) if expr is None else expr.when(cond, F.lit(t))
    return expr


def phase_of(d, start) -> Column:
    """Phase 1..4 of a date: 180-day blocks from ``start``; anything outside is 4."""
    n = F.datediff(col(d), lit_date(start) if isinstance(start, _dt.date) else col(start))
    return (F.when(n.between(0, K.PHASE_DAYS * K.PHASES - 1),
                   F.floor(n / K.PHASE_DAYS).cast("int") + 1)
            .otherwise(F.lit(K.PHASES)))


def days_between(later, earlier) -> Column:
    return F.datediff(col(later), col(earlier))


def minutes_between(later, earlier) -> Column:
    return F.timestamp_diff("SECOND", col(earlier), col(later)) / F.lit(60.0)


def safe_ratio(num, den) -> Column:
    """num / den with NULL for a zero or NULL denominator (ANSI mode safe)."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def stable_id(prefix: str, *cols) -> Column:
    """Deterministic id (replaces random ids so reruns are idempotent)."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *[col(c).cast("string") for c in cols]), 256), 1, 16))
