from __future__ import annotations

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lithic.functions import changes, dates, numbers, text


def values(spark, expression, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_trim_removes_spaces_only(spark):
    assert values(spark, text.trim, "  a b ", "\ta ", None) == ["a b", "\ta", None]


def test_blank_to(spark):
    assert values(spark, lambda c: text.blank_to(c, "N/A"), None, "", "  ", " a ") == ["N/A", "N/A", "N/A", "a"]


def test_sentence_case(spark):
    inputs = ["bench   PRESS", " bench press", "", None, "a\t\nB"]
    assert values(spark, text.sentence_case, *inputs) == ["Bench press", " bench press", "", None, "A b"]
    trimmed = values(spark, lambda c: text.sentence_case(c, trimmed=True), *inputs)
    assert trimmed == ["Bench press", "Bench press", "", None, "A b"]


def test_strip_special(spark):
    assert values(spark, text.strip_special, "Pull-up! #1.5, ok", "N/A", "café", None) == [
        "Pull-up 1.5, ok", "NA", "caf", None,
    ]


def test_clean_text_is_idempotent(spark):
    inputs = ["  bench   PRESS ", "Bench press!", "N/A", "\tfoo BAR\n", "!!", None, "ÉCOLE x"]
    once = values(spark, text.clean_text, *inputs)
    assert once[:5] == ["Bench press", "Bench press", "N/A", "Foo bar", ""]
    assert values(spark, text.clean_text, *once) == once


def test_same_text(spark):
    df = spark.createDataFrame([(" Chest\t", "CHEST"), ("a", "b"), (None, None), (None, "")], "a string, b string")
    assert [r[0] for r in df.select(text.same_text("a", "b")).collect()] == [True, False, True, False]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("08/01/2025", "2025-08-01"),
        ("2025.08.01", "2025-08-01"),
        ("2025/08/01", "2025-08-01"),
        ("2025-08-01", "2025-08-01"),
        ("8/1/2025", "8/1/2025"),
        ("13/45/2025", "13/45/2025"),
        ("2025", "2025"),
        ("+2025-8-01", "+2025-8-01"),
        ("", ""),
        (None, None),
        ("2025-08-01\n", "2025-08-01\n"),
    ],
)
def test_standardize_date(spark, raw, expected):
    assert values(spark, dates.standardize_date, raw) == [expected]


def test_date_or_missing_lets_blank_pass(spark):
    assert values(spark, dates.date_or_missing, None, "", " ") == ["1900-01-01", "", " "]


def test_decimal_comma(spark):
    assert values(spark, numbers.decimal_comma, "72,5 kg", "1,2,3", "a,b", None) == ["72.5 kg", "1.2.3", "a,b", None]


def test_cast_or(spark):
    number = lambda c: numbers.cast_or(c, "int", -1)
    assert values(spark, number, "12", " 7 ", "W1", "12.5", None) == [12, 7, -1, -1, -1]
    amount = lambda c: numbers.cast_or(c, "decimal(38,6)", -1)
    assert values(spark, amount, "72.5", "bodyweight") == [Decimal("72.5"), Decimal(-1)]
    day = lambda c: numbers.cast_or(c, "date", "1900-01-01")
    assert values(spark, day, "2025-08-01", "2025", None) == [date(2025, 8, 1), date(1900, 1, 1), date(1900, 1, 1)]


def test_strict_cast_fails_on_malformed_text(spark):
    with pytest.raises(Exception, match="not a int: W1"):
        values(spark, lambda c: numbers.cast_or(c, "int", -1, strict=True), "1", "W1")
    assert values(spark, lambda c: numbers.cast_or(c, "int", -1, strict=True), "1", None) == [1, -1]


def test_change_predicates(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "a string, b string")
    rows = df.select(changes.changed("a", "b"), changes.changed3("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(False, False), (True, True), (True, False), (False, False)]


def test_month_label(spark):
    label = lambda c: dates.month_label(c, "2025-07-01", "2030-12-31")
    days = [date(2025, 6, 30), date(2025, 7, 1), date(2030, 12, 31), date(2031, 1, 1), date(1900, 1, 1)]
    assert values(spark, label, *days, kind="date") == ["default", "2025_07", "2030_12", "default", "default"]


def test_special_characters_are_tested_in_one_table(spark):
    assert not re.search(r"\\s|\\w|\\d|[0-9A-Za-z]-[0-9A-Za-z]", text.SPECIAL_CHARACTERS)
    every = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10300), 0x1F600]))
    kept = re.sub(r"[^0-9A-Za-z \t\n\x0b\f\r\-.,]", "", every)
    assert values(spark, text.strip_special, every, "Bench\tpress, no. 1-a!#\u00a0é") == [kept, "Bench\tpress, no. 1-a"]
