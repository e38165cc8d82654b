"""Benchmark the headline queries on Spark.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and fully executes it (``noop`` sink: every row and
column is computed, nothing is collected to the driver).  Prints ONE JSON
line: {"metric", "value", "unit", "queries", "sf", ...}.

``BENCH_QUERIES`` (comma list) overrides the query set; ``BENCH_ALL=1``
runs the whole catalog.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "payments_rollup_to_applicant",   # flagship: R4 + canonical bundle + join to applicant
    "nested_rollup",                  # two-level roll-up (grandchild -> child -> parent)
    "bundle_moments",                 # median / moments bundle
    "category_means_joinback",        # category statistics joined back (broadcast)
    "group_mean_stats",               # five group-statistic blocks joined back
    "entity_merge",                   # applicant ⟕ five child roll-ups
    "onehot_max_levels",              # one-hot encoding of a joined history table
    "nzv_columns",                    # near-zero-variance metrics (melt + value counts)
    "corr_matrix_long",               # pairwise correlations after mean imputation
    "knn_class_distance_sums",        # exact blocked kNN features
    "auc_rank",                       # exact distributed AUC
    "blend_80_20",                    # key-aligned weighted blend of 7 score tables
]


def main() -> None:
    from tabula.plans.catalog import CATALOG, spark_query
    from tabula.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = HEADLINE
    if os.environ.get("BENCH_ALL") == "1":
        names = list(CATALOG)
    if os.environ.get("BENCH_QUERIES"):
        names = [n.strip() for n in os.environ["BENCH_QUERIES"].split(",") if n.strip()]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    # warm-up: JVM start, codegen caches
    spark.range(1000).selectExpr("sum(id)").collect()
    times, rows_ = {}, {}
    for name in names:
        t0 = time.time()
        df = spark_query(name)(spark, sf_dir)
        df.write.mode("overwrite").format("noop").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
