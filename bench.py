"""Times the headline queries and prints one JSON line.

Each query runs $BENCH_RUNS times (2 by default) and its least time counts: the first run also pays for
class loading and code generation of the local JVM. The times of the first runs are printed as ``first``.
"""

from __future__ import annotations

import json
import os
import time

from tamiz.catalogue.queries import QUERIES
from tamiz.session import local_session

HEADLINE = (
    "fit_statistics_wide",
    "rescale_avgstd",
    "impute_then_rescale",
    "factorize",
    "split_stratified_classes",
    "undersample_not_minority",
    "knn_uniform_l2",
    "knn_distance_l2",
    "knn_partitioned_distance_l2",
    "knn_sweep_report",
    "multiclass_auc_rows",
    "tree_exact_predict",
    "tree_mllib_predict",
    "tree_sweep_report",
    "tree_binned_sweep_report",
    "tree_scored_stored",
    "score_labelled_report",
    "training_job_report",
    "training_job_tree_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # Start-up of the JVM and of the Python workers is not part of any query.
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.range(8).repartition(8).mapInArrow(lambda batches: batches, "id long").collect()
    times, first = {}, {}
    for name in chosen:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            # Every row and column is computed, none is brought to the driver.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name], first[name] = round(min(runs), 3), round(runs[0], 3)
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "first": first, "sf": sf}))


if __name__ == "__main__":
    main()
