"""Physical-plan census of the catalogue: what each query scans and shuffles.

    python -m kintsugi.plans.planstats [--sf DIR] [names...]

Runs each query (collecting its small result), then counts in the final
adaptive plan:
file scans, shuffle exchanges, broadcast exchanges, sort-merge and
broadcast-hash joins, window operators, Python evaluation nodes, and
sort/object-hash aggregates (fallbacks from the fixed-width hash aggregate).
"""

from __future__ import annotations

import argparse
import re
import sys
import tempfile

PATTERNS = {
    "scans": r"FileScan|Scan parquet|Scan ExistingRDD|Scan LogicalRDD",
    "shuffles": r"\bExchange (hash|range|round|Single)",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "windows": r"\bWindow\b",
    "python": r"ArrowEvalPython|BatchEvalPython|MapInPandas|PythonMapInArrow|FlatMapGroupsInPandas",
    "sort_agg": r"SortAggregate",
    "object_agg": r"ObjectHashAggregate",
}


def census(df) -> dict[str, int]:
    df.collect()  # runs this DataFrame's own query execution (results are small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # an adaptive plan prints its final plan and then its initial plan:
    # count the final one (subquery plans appear inside it)
    plan = plan.split("== Initial Plan ==")[0]
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from kintsugi.plans import catalog
    from kintsugi.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="kintsugi-")})
    qs = catalog.queries()
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("| --- " * (len(PATTERNS) + 1) + "|")
    for name in a.names or list(qs):
        c = census(qs[name](spark, a.sf))
        print(f"| {name} | " + " | ".join(str(c[k]) for k in PATTERNS) + " |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
