"""Shape of an incoming table: names, columns, text types, audit stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``columns`` as text, in that order, then ``keep`` with its own types.

    A column that is not there is an error.
    """
    missing = [c for c in (*columns, *keep) if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    return df.select(*(F.col(c).cast("string").alias(c) for c in columns), *keep)


def batch_time(batch_ts: datetime | str) -> Column:
    return F.lit(batch_ts).cast("timestamp")


def stamp(df: DataFrame, batch_ts: datetime | str, updated: bool = True) -> DataFrame:
    """Add ``created_at`` and, unless switched off, ``updated_at``, both the time of the batch."""
    names = ("created_at", "updated_at") if updated else ("created_at",)
    return df.withColumns({name: batch_time(batch_ts) for name in names})
