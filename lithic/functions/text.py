"""Text cleaning as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-text marker and the characters that cleaning keeps.
MISSING_TEXT = "N/A"
# They are listed one by one: Java looks those up in one table of bits, but tests a class of ranges range by range, for
# each character of a text.
SPECIAL_CHARACTERS = rf"[^ \t\n\x0B\f\r\-.,{string.digits}{string.ascii_letters}]"
WHITESPACE = " \t\n\r\x0b\x0c"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim(col: Column | str) -> Column:
    """Drop space characters at both ends; tabs and newlines stay."""
    return F.trim(as_column(col))


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(trim(col), F.lit(""))


def blank_to(col: Column | str, default: str) -> Column:
    """Trimmed text, with ``default`` for NULL and for blank text."""
    return F.coalesce(blank_to_null(col), F.lit(default))


def collapse_spaces(col: Column | str) -> Column:
    return F.regexp_replace(as_column(col), r"\s+", " ")


def upper_first(col: Column | str) -> Column:
    """First character upper, the rest lower."""
    c = as_column(col)
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def sentence_case(col: Column | str, trimmed: bool = False) -> Column:
    """First character upper, the rest lower, every run of whitespace one space.

    ``trimmed`` removes outer spaces first; otherwise a leading space counts as the first character.
    """
    return collapse_spaces(upper_first(trim(col) if trimmed else col))


def strip_special(col: Column | str) -> Column:
    """Keep ASCII letters, digits, whitespace, hyphen, dot and comma."""
    return F.regexp_replace(as_column(col), SPECIAL_CHARACTERS, "")


def single_spaced(col: Column | str) -> Column:
    """Every run of whitespace one space, none at the ends."""
    return trim(collapse_spaces(col))


def tidy(col: Column | str) -> Column:
    """Sentence case without outer whitespace, also where a tab or line break stands at an end."""
    return upper_first(single_spaced(col))


# The same as steps for ``rewrite_columns``.
TIDY_STEPS = (single_spaced, upper_first)


def clean_text(col: Column | str) -> Column:
    """The full cleaning of one text value: symbols out, tidy, 'N/A' untouched. Twice is the same."""
    c = as_column(col)
    return F.when(c == MISSING_TEXT, c).otherwise(tidy(strip_special(c)))


def normalized(col: Column | str) -> Column:
    """Comparison form of a text value: trimmed sentence case, 'N/A' for NULL."""
    return F.coalesce(sentence_case(col, trimmed=True), F.lit(MISSING_TEXT))


def folded(col: Column | str) -> Column:
    """Case-folded text without outer whitespace of any kind."""
    return F.lower(F.btrim(as_column(col), F.lit(WHITESPACE)))


def same_text(a: Column | str, b: Column | str) -> Column:
    """Equality that ignores case and outer whitespace; two NULLs are equal."""
    return folded(a).eqNullSafe(folded(b))
