"""Time the headline queries: one warm-up run each, then the median of the timed runs.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs. Prints one JSON line. Jobs that a query runs while it is being built are timed too.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark import __version__
from pyspark.sql import SparkSession

from gridloom.catalog import QUERIES

HEADLINE = [
    "agg1_numeric_stats", "agg2_categorical_stats", "agg5_unique_counts", "agg7_quality_report",
    "agg10_correlation_pairs", "agg12_eda_summary",
    "eda1_histogram", "eda2_box_plot_by_group", "eda3_density", "eda6_grouped_bar", "eda11_skew_facts",
    "cln2_fill_median", "cln7_remove_outliers", "cln8_remove_duplicates", "cln9_one_hot",
    "cln10_label_encode", "cln13_robust_scaler", "pre4_workflow",
    "fe7_quantile_bins", "fe10_word_count", "fe16_replay",
    "spl1_train_test_split", "spl2_stratified_split", "evl10_folds", "mod3_feature_table",
    "evl1_macro_metrics", "evl4_roc_auc_macro", "evl5_roc_curves", "evl8_residual_statistics",
    "mod14_gaussian_bayes", "mod15_linear_regression", "mod11_knn_classifier", "mod12_decision_tree",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "lines": spark.read.parquet(f"{folder}/lineitem.parquet").count(),
                "cpus": int(cpus),
                "spark": __version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
