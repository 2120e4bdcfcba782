"""Row-wise cleaning steps that can leave a change flag behind."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.functions.changes import all_of, any_of, changed
from lithic.functions.numbers import digits, unit_of
from lithic.functions.text import MISSING_TEXT


def update_where(
    df: DataFrame, condition: Column, values: Mapping[str, Column], flag: str | None = None
) -> DataFrame:
    """Set all of ``values`` in the rows where ``condition`` holds; NULL counts as False."""
    hit = F.coalesce(condition, F.lit(False))
    new = {name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()}
    if flag:
        new[flag] = hit
    return df.withColumns(new)


def rewrite_columns(
    df: DataFrame,
    columns: Sequence[str],
    rewrite: Callable[[Column], Column] | Sequence[Callable[[Column], Column]],
    flag: str | None = None,
    row_conditional: bool = False,
    guard: str | None = MISSING_TEXT,
) -> DataFrame:
    """Apply ``rewrite`` to each column where it changes the value and the value is not 'N/A'.

    A rewrite may be a list of steps. Each step is a projection of its own, so a step that uses its
    input twice does not repeat the steps before it.
    With ``row_conditional`` one such column is enough to rewrite all of them in that row; only
    ``guard`` then protects a value in the other columns (None protects nothing).
    """
    first, *others = [rewrite] if callable(rewrite) else rewrite
    new = {f"_new_{c}": first(F.col(c)) for c in columns}
    rewritten = df.withColumns(new)
    for step in others:
        rewritten = rewritten.withColumns({n: step(F.col(n)) for n in new})
    pending = {c: (F.col(c) != MISSING_TEXT) & (F.col(c) != F.col(f"_new_{c}")) for c in columns}
    any_pending = F.coalesce(any_of(pending.values()), F.lit(False))
    if row_conditional:
        kept = {c: F.lit(False) if guard is None else F.col(c) == guard for c in columns}
        values = {c: F.when(any_pending & ~kept[c], F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    else:
        values = {c: F.when(F.col(c) == MISSING_TEXT, F.col(c)).otherwise(F.col(f"_new_{c}")) for c in columns}
    if flag:
        values[flag] = any_pending
    return rewritten.withColumns(values).drop(*new)


def split_unit(df: DataFrame, value: str, unit: str, flag: str | None = None) -> DataFrame:
    """Move a unit named inside ``value`` to ``unit``; without one both columns stay."""
    named = df.withColumn("_unit", unit_of(value))
    new = {unit: F.coalesce("_unit", unit), value: F.when(F.col("_unit").isNotNull(), digits(value)).otherwise(F.col(value))}
    if flag:
        new[flag] = F.col("_unit").isNotNull()
    return named.withColumns(new).drop("_unit")


def fill_blank(df: DataFrame, defaults: Mapping[str, str], flag: str | None = None) -> DataFrame:
    """Default for NULL or blank text; other values keep their outer spaces."""
    filled = {c: F.trim(c) != "" for c in defaults}
    new = {c: F.when(filled[c], F.col(c)).otherwise(default) for c, default in defaults.items()}
    if flag:
        new[flag] = ~F.coalesce(all_of(filled.values()), F.lit(False))
    return df.withColumns(new)


def set_column(df: DataFrame, name: str, value: Column, flag: str | None = None) -> DataFrame:
    """Replace one column; the flag tells where the value differs from before."""
    if not flag:
        return df.withColumn(name, value)
    new = f"_new_{name}"
    return df.withColumn(new, value).withColumns({flag: changed(name, new), name: F.col(new)}).drop(new)
