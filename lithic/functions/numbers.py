"""Numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lithic.functions.dates import strict_date
from lithic.functions.text import as_column


def decimal_comma(col: Column | str) -> Column:
    """All commas become dots where the text holds a digit and a comma."""
    c = as_column(col)
    return F.when(c.rlike("[0-9]") & c.contains(","), F.replace(c, F.lit(","), F.lit("."))).otherwise(c)


def unit_of(col: Column | str) -> Column:
    """'KG' or 'LBS' when the text names that unit (kg first), else NULL."""
    c = F.lower(as_column(col))
    return F.when(c.contains("kg"), "KG").when(c.contains("lbs"), "LBS")


def digits(col: Column | str) -> Column:
    """Digits and dots only."""
    return F.regexp_replace(as_column(col), r"[^0-9.]", "")


def parsed(col: Column | str, type_name: str) -> Column:
    """Text as ``type_name``, NULL where it does not parse."""
    return strict_date(F.trim(as_column(col))) if type_name == "date" else as_column(col).try_cast(type_name)


def cast_or(col: Column | str, type_name: str, default: object, strict: bool = False) -> Column:
    """Typed value of a text column with a default for NULL.

    Malformed text takes the default as well, or fails the job when ``strict``.
    """
    c = as_column(col)
    value = parsed(c, type_name)
    if strict:
        message = F.concat(F.lit(f"not a {type_name}: "), c)
        value = F.when(malformed(c, type_name), F.raise_error(message).cast(type_name)).otherwise(value)
    return F.coalesce(value, F.lit(default).cast(type_name))


def malformed(col: Column | str, type_name: str) -> Column:
    """True where there is text that does not parse as ``type_name``."""
    c = as_column(col)
    return c.isNotNull() & parsed(c, type_name).isNull()
