"""Times the headline queries and prints one JSON line; what is known so far goes to stderr.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per
query after one warm-up; the median is reported.  The model queries come last and run once.  After
each query a whole report of the queries so far is printed, so that a stop loses no figure.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from loanlens.plans import QUERIES
from loanlens.session import local_session

HEADLINE = (
    "q_default_rate_by_year",
    "q_ever_default",
    "q_clean",
    "q_clean_stats",
    "q_quality_suite",
    "q_missing",
    "q_duplicates",
    "q_first_coded",
    "q_group_sample",
    "q_stratified_split",
    "q_medians",
    "q_apply_transformers",
    "q_score_curve",
    "q_threshold_f1",
    "q_metrics_by_year",
    "q_calibration",
    "q_drift_features",
    "q_score_rows",
    "q_train_logistic_regression",
    "q_train_random_forest",
    "q_search",
)
ONCE = {"q_train_logistic_regression", "q_train_random_forest", "q_search"}


def run(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        build = QUERIES[name].build
        if name in ONCE:
            times[name] = round(run(build, spark, sf_dir), 3)
        else:
            run(build, spark, sf_dir)
            taken = [run(build, spark, sf_dir) for _ in range(runs)]
            times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        report = {
            "metric": "headline_queries_total",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        }
        if name == names[-1]:
            print(json.dumps(report), flush=True)
        else:
            print(json.dumps(report | {"partial": True}), file=sys.stderr, flush=True)


if __name__ == "__main__":
    main()
