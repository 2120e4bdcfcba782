"""Constraints as queries that return the violating rows (V1-V5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithic.functions.changes import any_of
from lithic.operators.dedup import duplicate_report
from lithic.operators.joins import orphans


def foreign_key_violations(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is set but missing from the parent."""
    return orphans(df, key, parent, parent_key)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys with the number of their rows."""
    return duplicate_report(df, keys, F.lit(0)).drop("min_id")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL in a required column, and the names of those columns."""
    names = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)))
    return df.where(any_of(F.col(c).isNull() for c in columns)).withColumn("null_columns", F.array_join(names, ","))


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with text longer than its limit, and the names of those columns."""
    over = {c: F.length(c) > n for c, n in limits.items()}
    names = F.array_compact(F.array(*(F.when(test, F.lit(c)) for c, test in over.items())))
    hit = F.coalesce(any_of(F.coalesce(test, F.lit(False)) for test in over.values()), F.lit(False))
    return df.where(hit).withColumn("long_columns", F.array_join(names, ","))
