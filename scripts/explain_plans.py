"""Print the formatted physical plan of each headline query (scan pruning, exchanges, joins).

Usage: python scripts/explain_plans.py [sf_dir] [name ...]
"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from credlens.plans import queries as Q  # noqa: E402
from credlens.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or bench.HEADLINE
    spark = build_session("local[8]")
    for name in names:
        df = Q.QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        exchanges = sum("Exchange" in ln and "Broadcast" not in ln for ln in lines)
        print(f"=== {name}: {exchanges} shuffle exchanges, "
              f"{sum('BroadcastExchange' in ln for ln in lines)} broadcasts")
        for ln in lines:
            if any(k in ln for k in ("Scan parquet", "Exchange", "Join", "Window", "Generate", "Aggregate")):
                print("   ", ln.strip()[:160])


if __name__ == "__main__":
    main()
