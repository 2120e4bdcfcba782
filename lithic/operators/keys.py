"""Dense surrogate keys without a global window (K1)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.sources.shared import stable

# monotonically_increasing_id() is the partition number above this many bits and the row number below.
ROW_BITS = 33


def highest_key(df: DataFrame, key: str) -> int:
    """Largest numeric value of a key column, 0 when there is none above it."""
    top = df.agg(F.max(F.col(key).try_cast("long")).alias("top")).first()["top"]
    return max(top or 0, 0)


def assign_keys(df: DataFrame, name: str, order: Sequence[Column | str], start: int = 0) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in ``order``, which must be unique per row.

    Rows are range-partitioned and sorted by ``order`` and written, each with its place, to a table
    in the shared folder. A lost executor or a second pass reads that table and cannot renumber
    rows. The only thing the driver sees is one row count per partition.
    """
    made = {f"_order{i}": c for i, c in enumerate(order) if not isinstance(c, str)}
    by = [c if isinstance(c, str) else f"_order{i}" for i, c in enumerate(order)]
    ranged = df.withColumns(made).repartitionByRange(*by).sortWithinPartitions(*by).drop(*made)
    located = stable(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumns(
        {"_part": F.shiftright("_at", ROW_BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))}
    )
    sizes = sorted((r["_part"], r["n"]) for r in located.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    befores = accumulate((n for _, n in sizes), initial=start)
    offsets = df.sparkSession.createDataFrame(
        [(part, before) for (part, _), before in zip(sizes, befores)], "_part long, _before long"
    )
    return (
        located.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_at", "_part", "_row", "_before")
    )
