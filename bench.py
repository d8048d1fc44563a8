"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8) the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "d02_sparsity",
    "d07_imbalance_level",
    "d09_task_main_rule",
    "e06_composition",
    "e08_top_features_anova",
    "f02_stratified_holdout",
    "f04_stratified_folds",
    "g13_ridge",
    "g02_ridge_classifier",
    "g05_discriminant_shrinkage",
    "g07_gaussian_bayes",
    "g06_multinomial_bayes",
    "g17_elastic_net_all_features",
    "g04_logistic_regression",
    "g01_linear_svc",
    "g08_tree_classes",
    "g09_forest_classes",
    "c03_nearest_neighbours",
    "i08_roc_auc",
    "i10_class_report",
    "i14_r2",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from tablewright.catalog import all_queries
    from tablewright.session import local_session

    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known, times = all_queries(), {}
    chosen = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    # one small job starts the JVM and the Python workers
    spark.range(8).repartition(8).mapInArrow(lambda it: it, "id long").count()
    for name in chosen:
        start = time.perf_counter()
        known[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
