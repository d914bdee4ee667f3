"""Benchmark the headline queries and print ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 4), ``BENCH_RUNS`` (default 3).  Each query runs once to warm up,
then ``BENCH_RUNS`` times through the ``noop`` sink (the whole plan executes,
nothing is collected); the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "alpha_portfolio",
    "return_by_category",
    "def_adj_rets",
    "select_alpha_values",
    "cutoff_sweep",
    "describe",
    "box_stats",
    "histogram",
    "cramers_v_py",
    "point_biserial_py",
    "corr_matrix",
    "stratified_split",
    "roc_auc",
    "pr_curve",
    "knn_classify",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from tapewise.plans import QUERIES
    from tapewise.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 4))
    times = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
