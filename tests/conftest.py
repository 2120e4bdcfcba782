from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lithic-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """A DataFrame of text columns (or of the given DDL) from tuples."""

    def build(columns: str, *values: tuple):
        ddl = columns if " " in columns.split(",")[0].strip() else ", ".join(f"{c.strip()} string" for c in columns.split(","))
        return spark.createDataFrame(list(values), ddl)

    return build


def table(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
