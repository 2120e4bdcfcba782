"""Date text and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lithic.functions.text import as_column

# The date that stands for a missing one, and the date shapes that are recognised.
MISSING_DATE = "1900-01-01"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
OTHER_DATES = r"^(?:(\d{4}).(\d{2}).(\d{2})|(\d{2})/(\d{2})/(\d{4}))\z"


def dashed_date(col: Column | str) -> Column:
    """``MM/DD/YYYY`` and ``YYYY?MM?DD`` (any separator) in the order and form ``YYYY-MM-DD``."""
    # Only the groups of the shape that matched hold text; the others are empty.
    return F.regexp_replace(as_column(col), OTHER_DATES, "$1$6-$2$4-$3$5")


def real_date(dashed: Column | str, original: Column | str) -> Column:
    """The dashed text where it names a real day, else the original."""
    return F.coalesce(strict_date(dashed).cast("string"), as_column(original))


def standardize_date(col: Column | str) -> Column:
    """Rewrite ``MM/DD/YYYY`` and ``YYYY?MM?DD`` as ``YYYY-MM-DD``.

    Other text stays, and so does text of the right shape that names no real day.
    """
    return real_date(dashed_date(col), col)


def date_or_missing(col: Column | str) -> Column:
    """The missing date for NULL only; blank text passes."""
    return F.coalesce(as_column(col), F.lit(MISSING_DATE))


def strict_date(col: Column | str) -> Column:
    """ISO text as a date, NULL for anything else (a bare year is not a date)."""
    c = as_column(col)
    return F.when(c.rlike(ISO_DATE), c.try_cast("date"))


def is_weekend(day: Column | str) -> Column:
    """'Y' on Saturday and Sunday, else 'N'."""
    return F.when(F.dayofweek(as_column(day)).isin(1, 7), "Y").otherwise("N")


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """The attributes of one calendar day, by column name."""
    d = as_column(day)
    return {
        "day_name_in_week": F.date_format(d, "EEEE"),
        "day_number_in_month": F.dayofmonth(d),
        "calendar_month_number": F.month(d),
        "calendar_month_desc": F.date_format(d, "MMMM"),
        "calendar_year": F.year(d),
        "is_weekend": is_weekend(d),
    }


def month_label(day: Column | str, lo: str, hi: str, fallback: str = "default") -> Column:
    """``yyyy_MM`` for days between ``lo`` and ``hi`` inclusive, else ``fallback``."""
    d = as_column(day)
    inside = d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return F.when(inside, F.date_format(d, "yyyy_MM")).otherwise(fallback)
