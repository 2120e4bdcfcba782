"""Staging to cleansing: load, clean and deduplicate in one chain per table.

Values are normalised before they are compared with the table, so a second run on the same input
finds every row again. Each function returns the new content of its table with bookkeeping columns
that ``lithic.plans.run`` turns into audit counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.functions.changes import all_of, any_of, changed
from lithic.functions.dates import MISSING_DATE, dashed_date, date_or_missing, real_date
from lithic.functions.numbers import decimal_comma
from lithic.functions.text import (
    MISSING_TEXT, TIDY_STEPS, blank_to, clean_text, normalized, sentence_case, strip_special,
)
from lithic.operators.cleaning import fill_blank, rewrite_columns, set_column, split_unit
from lithic.operators.dedup import first_per_key, first_per_key_of_table, numeric_order
from lithic.operators.joins import anti_join, anti_join_few, fill_key, match_parents
from lithic.operators.keys import assign_keys, highest_key
from lithic.operators.merge import INSERTED, KEPT, cleansing_insert, update_from
from lithic.sources.shared import stable

ACTION = "_action"
COPIES = "_copies"
LINKED = "_linked"
TEXT_RULES = ("special_chars", "capitalize")
WORKOUT_RULES = ("date", "load_dot", "special_chars", "capitalize", "load_unit", "defaults")

# What a missing workout value becomes.
WORKOUT_DEFAULTS = {
    "reps": "0",
    "load": "0",
    "set_number": "0",
    "exercise": MISSING_TEXT,
    "resistance_type": MISSING_TEXT,
    "set_type": MISSING_TEXT,
    "comments": MISSING_TEXT,
    "workout_type": MISSING_TEXT,
    "date": MISSING_DATE,
}
WORKOUT_KEY = ("workout_number", "date", "set_number", "exercise")


def clean_columns(df: DataFrame, columns: Sequence[str], row_conditional: bool = False) -> DataFrame:
    """Symbols out, then tidy, with a flag per rule.

    ``row_conditional`` is the literal form: one dirty column rewrites all columns of the row,
    nothing is trimmed, and 'N/A' in a neighbouring column is rewritten as well.
    """
    if row_conditional:
        df = rewrite_columns(df, columns, strip_special, "special_chars", row_conditional=True, guard=None)
        return rewrite_columns(df, columns, sentence_case, "capitalize", row_conditional=True, guard=None)
    df = rewrite_columns(df, columns, strip_special, "special_chars")
    return rewrite_columns(df, columns, TIDY_STEPS, "capitalize")


def load_dimension(
    target: DataFrame,
    staged: DataFrame,
    surrogate: str,
    source_id: str,
    attrs: Sequence[str],
    batch_ts: datetime | str,
    normalized_key: bool = True,
    start: int | None = None,
) -> DataFrame:
    """Cleansing content of a dimension after a load, cleaned, with action, copies and rule flags.

    Duplicates are rows with the same source id and attributes, compared after normalisation or,
    without ``normalized_key``, as they are; the lowest id stays. ``start`` is the highest id so far.
    """
    src = staged.select(F.col(surrogate).alias(source_id), *attrs)
    updated = update_from(target, src, [source_id], attrs, batch_ts, normalize=clean_text, action=ACTION)
    columns = {source_id: F.col(source_id), **{a: blank_to(a, MISSING_TEXT) for a in attrs}}
    order = [*numeric_order(source_id), *attrs]
    fresh = cleansing_insert(target, src, surrogate, columns, [source_id], order, batch_ts, null_safe=True, start=start)
    loaded = updated.unionByName(fresh.withColumn(ACTION, F.lit(INSERTED)))
    key = {source_id: F.col(source_id), **{a: normalized(a) if normalized_key else F.col(a) for a in attrs}}
    kept = first_per_key(loaded, key, numeric_order(surrogate), count=COPIES)
    return clean_columns(kept, attrs)


def load_bridge(
    target: DataFrame, staged: DataFrame, exercises: DataFrame, muscles: DataFrame, batch_ts: datetime | str
) -> DataFrame:
    """Cleansing content of the exercise-muscle bridge after a load, cleaned.

    Pairs without both parents are left out. New rows take the surrogate ids of their parents.
    """
    pair, attrs = ["exercise_src_id", "muscle_src_id"], ["exercise_name", "muscle_name", "muscle_role"]
    src = staged.select(
        F.col("exercise_id").alias("exercise_src_id"), F.col("muscle_id").alias("muscle_src_id"), *attrs
    )
    matched = match_parents(
        src,
        [
            (exercises, "exercise_src_id", {"exercise_src_id": "exercise_src_id", "exercise_id": "exercise_id"}),
            (muscles, "muscle_src_id", {"muscle_src_id": "muscle_src_id", "muscle_id": "muscle_id"}),
        ],
    )
    updated = update_from(
        target, matched, pair, attrs, batch_ts, normalize=clean_text, blank_is_change=True, action=ACTION
    )
    cleaned = matched.select(
        "exercise_id", "muscle_id", *pair, *(clean_text(blank_to(a, MISSING_TEXT)).alias(a) for a in attrs)
    ).distinct()
    now, never = F.lit(batch_ts).cast("timestamp"), F.lit(None).cast("timestamp")
    fresh = anti_join(cleaned, target, pair).withColumns(
        {"created_at": now, "updated_at": never, ACTION: F.lit(INSERTED)}
    )
    loaded = updated.unionByName(fresh.select(*target.columns, ACTION))
    key: Mapping[str, Column] = {**{p: F.col(p) for p in pair}, **{a: normalized(a) for a in attrs}}
    return clean_columns(first_per_key(loaded, key, ["created_at"], count=COPIES), attrs)


def clean_workout_rows(staged: DataFrame, row_conditional: bool = False) -> DataFrame:
    """Cleaned workout values with a flag per rule, one row per staged row."""
    cased = sentence_case("exercise", trimmed=True)
    if not row_conditional:
        cased = F.when(F.trim("exercise") == MISSING_TEXT, MISSING_TEXT).otherwise(cased)
    loaded = staged.select(
        blank_to("workout_number", "-1").alias("workout_number"),
        date_or_missing("date").alias("date"),
        blank_to("set_number", "0").alias("set_number"),
        blank_to(cased, MISSING_TEXT).alias("exercise"),
        blank_to("reps", "0").alias("reps"),
        "load",
        F.lit(None).cast("string").alias("unit"),
        *(blank_to(c, MISSING_TEXT).alias(c) for c in ("resistance_type", "set_type", "comments", "workout_type")),
    )
    dashed = loaded.withColumn("_dashed", dashed_date("date"))
    rows = set_column(dashed, "date", real_date("_dashed", "date"), "date_rule").drop("_dashed")
    rows = set_column(rows, "load", decimal_comma("load"), "load_dot")
    special, cased = ["exercise", "workout_type"], ["exercise", "resistance_type"]
    if row_conditional:
        rows = rewrite_columns(rows, special, strip_special, "special_chars", row_conditional=True, guard=None)
        rows = rewrite_columns(rows, cased, sentence_case, "capitalize", row_conditional=True, guard=None)
    else:
        rows = rewrite_columns(rows, special, strip_special, "special_chars")
        rows = rewrite_columns(rows, cased, TIDY_STEPS, "capitalize")
    rows = split_unit(rows, "load", "unit", "load_unit")
    # The other columns got their default on load and no rule can have blanked them.
    emptied = {c: WORKOUT_DEFAULTS[c] for c in ("load", "exercise", "resistance_type", "workout_type", "date")}
    return fill_blank(rows, emptied, "defaults").withColumnRenamed("date_rule", "date_changed")


def workout_flags() -> dict[str, Column]:
    """The flag column of each workout rule."""
    return {rule: F.col("date_changed" if rule == "date" else rule) for rule in WORKOUT_RULES}


def load_workouts(
    linked: DataFrame,
    pending: DataFrame,
    staged: DataFrame,
    exercises: DataFrame,
    resistance_types: DataFrame,
    batch_ts: datetime | str,
    start: int | None = None,
) -> DataFrame:
    """Workouts to write after a load: the new ones and the earlier ones that still lack a key.

    Staged rows are cleaned, reduced to one row per set (the first, which gets the lowest id), and
    those in neither table are numbered. Missing keys of new and pending rows are then looked up by
    name. ``linked`` rows have both keys and never change, so they are read for the comparison only.
    ``start`` is the highest id so far. Bookkeeping: action, copies, and per rule the number of staged rows it changed.
    """
    sums = {f"_{rule}": flag for rule, flag in workout_flags().items()}
    rows = stable(clean_workout_rows(staged))
    values = [c for c in rows.columns if c in pending.columns]
    order = [*numeric_order("workout_number"), "date", *numeric_order("set_number"), "exercise"]
    # The numbering goes by the key, which is the same in all rows of a set; the first goes by the other values.
    kept = first_per_key_of_table(rows, WORKOUT_KEY, (), count=COPIES, sums=sums, columns=values)
    known = linked.unionByName(pending)
    fresh = kept if known.isEmpty() else anti_join_few(stable(kept), known, WORKOUT_KEY)
    absent = {"_old_exercise": F.lit(None).cast("string"), "_old_resistance": F.lit(None).cast("string")}

    def keyed(df: DataFrame) -> DataFrame:
        found = fill_key(df, exercises, "exercise", "exercise_name", "exercise_id")
        return fill_key(found, resistance_types, "resistance_type", "resistance_type", "resistance_id")

    # Keys are looked up before the numbering writes the rows, so that neither part of the result looks them up again.
    named = keyed(fresh.withColumns({"exercise_id": absent["_old_exercise"], "resistance_id": absent["_old_resistance"]}))
    numbered = assign_keys(named, "id", order, highest_key(known, "id") if start is None else start)
    new = numbered.withColumns(
        {
            "id": F.col("id").cast("string"),
            "created_at": F.lit(batch_ts).cast("timestamp"),
            ACTION: F.lit(INSERTED),
            **absent,
        }
    )
    both = new.select(*pending.columns, ACTION, COPIES, *sums, *absent)
    if not pending.isEmpty():
        old = pending.withColumns(
            {
                ACTION: F.lit(KEPT), COPIES: F.lit(1).cast("long"), **{s: F.lit(0).cast("long") for s in sums},
                "_old_exercise": F.col("exercise_id"), "_old_resistance": F.col("resistance_id"),
            }
        )
        both = keyed(old).unionByName(both)
    found = any_of([changed("exercise_id", "_old_exercise"), changed("resistance_id", "_old_resistance")])
    return both.withColumn(LINKED, found).drop(*absent)


def has_both_keys() -> Column:
    """True for workouts that no later lookup can change."""
    return all_of(F.coalesce(F.col(k) != "-1", F.lit(False)) for k in ("exercise_id", "resistance_id"))


def lacks_a_key() -> Column:
    """True for the other workouts, in a form that files can be skipped by."""
    return any_of(F.col(k).isNull() | (F.col(k) == "-1") for k in ("exercise_id", "resistance_id"))
