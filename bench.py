"""Benchmark the headline queries.

Runs each query over the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed with the ``noop`` sink (every row produced, nothing
collected to the driver). One untimed warm-up query loads the JVM code paths.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_daily_rollup",          # scan + parse + partial aggregation
    "j2_panel_with_holidays",   # gap fill + calendar + nearest-holiday join
    "x1_features",              # 17 lag/rolling features, one window pass
    "e3_forecast_scores",       # flagship: naive walk-forward RMSE by slot
    "e13_compare_models",       # exact AUROC/AP/accuracy/F1 via distributed prefix sums
    "r1_r7_recommend",          # per-brand advice
    "s4_walk_forward_folds",    # fold explode + summary
    "x5_f_classif",             # ANOVA F per feature
    "i8_extract_links",         # HTML block extraction
    "j5_knn_pairs",             # exact k-NN in blocks
    "b1_smote",                 # SMOTE with exact class totals
    "m6_exact_tree",            # tree of depth 2 over every cut
    "m3_m4_bayes_features",     # Gramian + evidence iteration
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from dealcast.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="dealcast-bench", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    from dealcast.registry import QUERIES

    QUERIES["i9_profile_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
