"""Registered queries and their SQL twins: names, and a few of each kind compared.

All twins are compared by ``check_queries.py``.
"""

import duckdb
import pytest

from check_queries import TABLES, compare
from gridloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "src1_wide_ids", "src1_quoted_text", "lim3_shared_key", "agg1_numeric_stats", "agg4_duplicate_rows",
    "agg7_quality_report", "eda2_box_plot_by_group", "eda10_pairwise_points", "cln8_remove_duplicates",
    "cln10_label_encode", "pre3_many_values", "pre4_workflow", "fe7_quantile_bins", "fe14_correlations",
    "spl2_stratified_split", "evl5_roc_curves", "evl10_cross_validation", "mod6_train_classifier",
    "mod11_neighbours_copies", "mod12_decision_tree", "mod23_knn_registry", "cmp2_compare_classifiers",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, FOLDER).toArrow(), ORACLES[name]) is None
