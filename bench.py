"""Benchmark the headline catalogue queries; prints ONE JSON line.

Each query is built and forced with a ``noop`` write (the whole result is
computed, nothing is collected): one warm-up run, then the median of
``BENCH_RUNS`` timed runs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_QUERIES=all python bench.py        # every catalogue query
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "repair_and_profile", "cast_double_coerce", "fill_mean", "fill_median", "fill_ffill",
    "dedup_subset_first", "join_left", "join_null_keys", "join_report", "profile_tables",
    "issues", "compare_keyed", "compare_positional", "rubric_cascade", "scorecard",
    "log_running_cost", "stream_contract_monitor",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    which = os.environ.get("BENCH_QUERIES", "")

    from kintsugi.plans import catalog
    from kintsugi.session import build_session

    spark = build_session(f"local[{cpus}]", app="kintsugi-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", str(int(cpus) * 2))),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kintsugi-bench-")})
    qs = catalog.queries()
    names = list(qs) if which == "all" else (which.split(",") if which else HEADLINE)

    def once(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in names:
        once(name)  # warm-up
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
