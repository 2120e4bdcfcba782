"""Change predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lithic.functions.text import as_column


def changed(a: Column | str, b: Column | str) -> Column:
    """Null-safe difference: NULL against a value is a change."""
    return ~as_column(a).eqNullSafe(as_column(b))


def changed3(a: Column | str, b: Column | str) -> Column:
    """Three-valued difference: NULL on either side is never a change."""
    return F.coalesce(as_column(a) != as_column(b), F.lit(False))


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions, False when there are none."""
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of the conditions, True when there are none."""
    return reduce(lambda x, y: x & y, conditions, F.lit(True))
