"""Physical-plan summary of queries over the stored raw layer.

For each query: shuffles (Exchange hashpartitioning/rangepartitioning),
broadcasts, join strategies, window and aggregate operators, and whether
every scan has a pruned ReadSchema.  Usage:
    python tools/plans.py [sf_dir] [names...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    text = df._jdf.queryExecution().toString()
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial_aggs": len(re.findall(r"partial_", plan)),
        "scans": plan.count("FileScan parquet"),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", text)),
    }


def main():
    from bench import HEADLINE
    from claimsight.registry import finalize, load_all
    from claimsight.session import checkpoint_dir, get_session
    from claimsight.sources.mapping import StoredRelations, materialize
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    root = f"{checkpoint_dir(spark)}/raw/{os.path.basename(sf.rstrip('/'))}"
    rel = StoredRelations(spark, root, sf) if os.path.exists(root.replace("file:", "")) else materialize(spark, sf, root)
    reg = load_all()
    for n in args or HEADLINE:
        print(n, summarize(finalize(reg[n].build(rel))))


if __name__ == "__main__":
    main()
