"""Duplicate removal and duplicate reports.

Every step reduces on the map side first: each task sends at most one row per key to the shuffle, so
a key that holds a third of the table does not land in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithic.functions.changes import any_of
from lithic.functions.text import as_column
from lithic.operators.joins import BROADCAST_BYTES, EXACT, HASH, hash_of, hashes_tell, parted, sized


def distinct_rows(df: DataFrame, columns: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct rows over computed ``columns`` (or over the rows as they are)."""
    return (df.select(*(c.alias(n) for n, c in columns.items())) if columns else df).distinct()


def numeric_order(col: Column | str) -> list[Column | str]:
    """Order of an id held as text: by number where it is one, then by text."""
    return [as_column(col).try_cast("decimal(38,0)"), col]


def first_per_key(
    df: DataFrame,
    keys: Mapping[str, Column | str] | Sequence[str],
    order: Sequence[Column | str],
    count: str | None = None,
    sums: Mapping[str, Column] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of each key by ``order``; NULL is a key value like any other.

    ``keys`` may be computed; only the columns of ``df`` come back, or of them ``columns``. Ties in ``order`` are broken by
    the remaining ones of these, so the result does not depend on the physical order of rows. ``count``
    adds the number of rows of the key, ``sums`` totals over them. Keys and order given by name are not
    copied, so a row is sorted and shuffled with each of its values once.
    """
    by = {f"_key{i}": k for i, k in enumerate(keys.values() if isinstance(keys, Mapping) else keys)}
    grouping = [k if isinstance(k, str) else n for n, k in by.items()]
    keyed = df.withColumns({n: k for n, k in by.items() if not isinstance(k, str)})
    same = {c for c, type_name in df.dtypes if c in grouping and type_name in EXACT}
    columns = list(columns or df.columns)
    ranked = {o: i for i, o in enumerate(order) if isinstance(o, str) and o in columns}
    rest = [c for c in columns if c not in same and c not in ranked]
    if not (count or sums):
        # Spark limits each group to its first row per task before the shuffle (WindowGroupLimit).
        ranking = [as_column(o) for o in order] + [F.col(c) for c in rest] or [F.col(c) for c in grouping]
        rank = F.row_number().over(Window.partitionBy(*grouping).orderBy(*ranking))
        return keyed.withColumn("_rank", rank).where("_rank = 1").select(*columns)
    totals, first = _totals(count, sums), F.col("_first")
    values = [as_column(o).alias(f"_order{i}") for i, o in enumerate(order)] + [F.col(c) for c in rest]
    found = {c: F.col(c) if c in same else first.getField(f"_order{ranked[c]}" if c in ranked else c) for c in columns}
    return (
        keyed.groupBy(*grouping)
        .agg(
            F.min(F.struct(*(values or [F.lit(0).alias("_order")]))).alias("_first"),
            *(total.alias(n) for n, total in totals.items()),
        )
        .select(*(c.alias(n) for n, c in found.items()), *totals)
    )


def first_per_key_of_table(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    count: str | None = None,
    sums: Mapping[str, Column] | None = None,
    columns: Sequence[str] | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``first_per_key`` for a written table in which few keys are repeated, which then is neither sorted nor shuffled.

    Hashes of the keys are counted first. A key whose hash no other row has is not repeated, so its row is the first;
    the rows of all other hashes are compared by their keys. If these are too many, all rows are.
    """
    if not hashes_tell(df, keys):
        return first_per_key(df, keys, order, count, sums, columns)
    hashes = df.select(hash_of(keys)).groupBy(HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(HASH)
    repeated, small = sized(hashes, max_bytes)
    if not small:
        return first_per_key(df, keys, order, count, sums, columns)
    single, others = parted(df, keys, repeated)
    totals = {count: F.lit(1).cast("long")} if count else {}
    totals.update({n: c.cast("long") for n, c in (sums or {}).items()})
    alone = single.select(*(columns or df.columns), *(c.alias(n) for n, c in totals.items()))
    return alone.unionByName(first_per_key(others, keys, order, count, sums, columns))


def _totals(count: str | None, sums: Mapping[str, Column] | None) -> dict[str, Column]:
    totals = {count: F.count(F.lit(1))} if count else {}
    totals.update({n: F.sum(c.cast("long")) for n, c in (sums or {}).items()})
    return totals


def drop_duplicates(
    df: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    order: Sequence[Column | str],
    required: Sequence[str] | None = None,
    count: str | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Keep the first row of each key; rows with NULL in a required column all stay.

    SQL equality never matches NULL, so such rows are nobody's duplicate: each gets a tag that makes it a key of its own,
    and one pass serves both kinds. ``required`` names the columns to test (default: the key columns when they are plain
    names); pass ``()`` when none can be NULL.
    """
    if required is None:
        required = [] if isinstance(keys, Mapping) else list(keys)
    if not required:
        return first_per_key(df, keys, order, count, sums)
    named = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    alone = F.when(any_of(F.col(c).isNull() for c in required), F.monotonically_increasing_id())
    tagged = df.withColumn("_alone", alone)
    return first_per_key(tagged, {**named, "_alone": "_alone"}, order, count, sums).drop("_alone")


def duplicate_report(
    df: DataFrame, keys: Mapping[str, Column] | Sequence[str], kept: Column, kept_name: str = "min_id"
) -> DataFrame:
    """Key, lowest ``kept`` value and size of every group with more than one row."""
    named = dict(keys) if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    return (
        df.groupBy(*(c.alias(n) for n, c in named.items()))
        .agg(F.min(kept).alias(kept_name), F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
