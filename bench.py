"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dq_07_t14",                    # flagship: star join + member-year aggregate
    "dq_suite_row_rules",           # every row-local rule, fused per table
    "gate_checks",                  # 17 gate counts in one job
    "dq_15_t03",                    # benefit sharing: RANGE frame distinct providers
    "dq_15_t04",                    # duplicate pairs: skew-safe band join
    "fraud_f01_providers",          # phantom billing vs county peers
    "upsert_u03_claims",            # recency-guarded claim upsert (fold rule)
    "upsert_u04_events",            # idempotent event append
    "mart_m04_dim_members",         # SCD2 member dimension
    "mart_m07_provider_analytics",  # rolling provider analytics
    "feat_x01_x11_claim_features",  # point-in-time claim features
    "report_q02_approval_trend",    # grouping sets report
    "stream_r05_provider_bursts",   # sliding-window detector (batch truth)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from claimsight.registry import finalize, load_all
    from claimsight.session import checkpoint_dir, get_session
    from claimsight.sources.mapping import materialize
    spark = get_session(f"local[{cpus}]", int(cpus) * 2)
    reg = load_all()
    names = sys.argv[1:] or HEADLINE
    times = {}
    # load step: derive the 17 raw relations once and store them (shared dir)
    root = f"{checkpoint_dir(spark)}/raw/{os.path.basename(sf_dir.rstrip('/'))}"
    t0 = time.perf_counter()
    rel = materialize(spark, sf_dir, root)
    times["load_raw_layer"] = round(time.perf_counter() - t0, 3)
    finalize(reg["dq_05_t02"].build(rel)).write.format("noop").mode("overwrite").save()   # warm-up
    for n in names:
        t0 = time.perf_counter()
        finalize(reg[n].build(rel)).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
