from __future__ import annotations

import pytest
from conftest import table
from pyspark.sql import functions as F

from lithic.functions.text import sentence_case, strip_special
from lithic.operators.audit import count_changes
from lithic.operators.cleaning import fill_blank, rewrite_columns, split_unit, update_where
from lithic.operators.conform import conform, rename_columns, stamp
from lithic.plans.cleansing import WORKOUT_RULES, clean_columns, clean_workout_rows, workout_flags


def test_update_where_treats_null_as_false(rows):
    df = update_where(rows("a,b", ("x", "1"), (None, "2")), F.col("a") == "x", {"b": F.lit("9")}, "hit")
    assert table(df) == [("x", "9", True), (None, "2", False)]


def test_na_survives_beside_a_dirty_column(rows):
    df = rows("a,b", ("N/A", "x!"), ("y", "N/A"))
    assert table(rewrite_columns(df, ["a", "b"], strip_special, "hit")) == [("N/A", "x", True), ("y", "N/A", False)]


def test_literal_form_turns_na_into_na_without_slash(rows):
    df = rows("a,b", ("N/A", "x!"), ("y", "N/A"))
    once = rewrite_columns(df, ["a", "b"], strip_special, row_conditional=True, guard=None)
    assert table(once) == [("NA", "x"), ("y", "N/A")]
    assert table(clean_columns(df, ["a", "b"], row_conditional=True), "a", "b") == [("Na", "X"), ("Y", "N/a")]
    guarded = rewrite_columns(df, ["a", "b"], sentence_case, row_conditional=True)
    assert table(guarded) == [("N/A", "X!"), ("Y", "N/A")]


def test_null_columns_stay_null(rows):
    assert table(rewrite_columns(rows("a,b", (None, "x!")), ["a", "b"], strip_special, "hit")) == [(None, "x", True)]


def test_split_unit(rows):
    df = rows("load,unit", ("72.5 kg", None), ("100LBS", None), ("60", None), ("kg", None), ("5 lbs kg", None), ("7", "KG"))
    assert table(split_unit(df, "load", "unit")) == sorted(
        [("72.5", "KG"), ("100", "LBS"), ("60", None), ("", "KG"), ("5", "KG"), ("7", "KG")], key=repr
    )


def test_fill_blank_keeps_outer_spaces(rows):
    df = fill_blank(rows("a", (None,), ("",), ("  ",), (" x ",)), {"a": "0"}, "hit")
    assert table(df) == sorted([("0", True)] * 3 + [(" x ", False)], key=repr)


def test_conform(rows, spark):
    df = rename_columns(spark.createDataFrame([(1, "x")], "`ID` int, `Name` string"), {"ID": "id", "Name": "name"})
    assert conform(df, ["name", "id"]).dtypes == [("name", "string"), ("id", "string")]
    with pytest.raises(ValueError, match="missing from the input: role"):
        conform(df, ["id", "role"])
    assert stamp(df, "2025-01-01 00:00:00", updated=False).columns == ["id", "name", "created_at"]


COLUMNS = "workout_number,date,set_number,exercise,reps,load,resistance_type,set_type,comments,workout_type"


def test_workout_rules(rows):
    raw = rows(
        COLUMNS,
        ("1", "08/01/2025", "1", "  bench   PRESS ", None, "72,5 kg", "barbell", "s", "c", "Strength!"),
        (None, None, " ", "###", "  ", "kg", None, None, None, "A/B"),
        ("2", "  ", "1", "N/A", "5", "bodyweight", "x", "s", "c", "N/A"),
    )
    done = clean_workout_rows(raw)
    assert table(done, "workout_number", "date", "set_number", "exercise", "reps", "load", "unit", "workout_type") == sorted(
        [
            ("1", "2025-08-01", "1", "Bench press", "0", "72.5", "KG", "Strength"),
            ("-1", "1900-01-01", "0", "N/A", "0", "0", "KG", "AB"),
            ("2", "1900-01-01", "1", "N/A", "5", "bodyweight", None, "N/A"),
        ],
        key=repr,
    )
    flags = done.select(*(c.alias(n) for n, c in workout_flags().items()))
    counts = count_changes(flags, WORKOUT_RULES).first().asDict()
    assert counts == {
        "date": 1, "load_dot": 1, "special_chars": 2, "capitalize": 2, "load_unit": 2, "defaults": 2, "total_changed": 10,
    }
