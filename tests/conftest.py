import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Five rows with holes, a constant column and no duplicates."""
    rows = [
        (20.0, 1.0, "Ann", "X", "ok"), (30.0, 2.0, "Bob", "Y", "ok"), (None, 3.0, "Cid", None, "ok"),
        (40.0, 4.0, "Dan", "X", "ok"), (50.0, 5.0, "Eve", "Z", "ok"),
    ]
    return spark.createDataFrame(rows, "age double, score double, name string, city string, status string")


@pytest.fixture(scope="session")
def messy(spark):
    """Eight rows, two of them identical."""
    rows = [
        (25.0, 80.0, "A", "X", "p"), (30.0, 90.0, "B", "Y", "p"), (25.0, 80.0, "A", "X", "p"),
        (35.0, 70.0, "C", "Z", "f"), (None, 60.0, "D", "X", "f"), (45.0, 85.0, "E", None, "p"),
        (50.0, 95.0, "F", "Y", "f"), (28.0, 75.0, "G", "X", "p"),
    ]
    return spark.createDataFrame(rows, "age double, score double, name string, city string, status string")


def rows_as(df, *names):
    """Rows as a sorted list of tuples of the named columns."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
