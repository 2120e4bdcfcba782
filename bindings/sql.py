"""DuckDB spellings of the column expressions, for the oracle SQL."""

from __future__ import annotations

from bindings.tables import SETS_SQL

SYMBOLS = r"[^0-9A-Za-z\s\-\.,]"


def trim(x: str) -> str:
    return f"trim({x}, ' ')"


def blank_to(x: str, default: str) -> str:
    return f"coalesce(nullif({trim(x)}, ''), '{default}')"


def collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def sentence(x: str) -> str:
    return collapse(f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))")


def strip_special(x: str) -> str:
    return f"regexp_replace({x}, '{SYMBOLS}', '', 'g')"


def tidy(x: str) -> str:
    return sentence(trim(collapse(x)))


def clean(x: str) -> str:
    return f"CASE WHEN {x} = 'N/A' THEN {x} ELSE {tidy(strip_special(x))} END"


def normalized(x: str) -> str:
    return f"coalesce({sentence(trim(x))}, 'N/A')"


def folded(x: str) -> str:
    return f"lower(trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)))"


def standard_date(x: str) -> str:
    month_first = f"substr({x}, 7, 4) || '-' || substr({x}, 1, 2) || '-' || substr({x}, 4, 2)"
    year_first = f"substr({x}, 1, 4) || '-' || substr({x}, 6, 2) || '-' || substr({x}, 9, 2)"
    return (
        rf"CASE WHEN regexp_full_match({x}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN {x}"
        rf" WHEN regexp_full_match({x}, '\d{{2}}/\d{{2}}/\d{{4}}') THEN"
        f" coalesce(CAST(TRY_CAST({month_first} AS DATE) AS VARCHAR), {x})"
        rf" WHEN regexp_full_match({x}, '\d{{4}}.\d{{2}}.\d{{2}}') THEN"
        f" coalesce(CAST(TRY_CAST({year_first} AS DATE) AS VARCHAR), {x}) ELSE {x} END"
    )


def decimal_comma(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '[0-9]') AND contains({x}, ',') THEN replace({x}, ',', '.') ELSE {x} END"


def unit(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '(?i)kg') THEN 'KG' WHEN regexp_matches({x}, '(?i)lbs') THEN 'LBS' END"


def without_unit(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '(?i)kg|lbs') THEN regexp_replace({x}, '[^0-9.]', '', 'g') ELSE {x} END"


def fill(x: str, default: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {trim(x)} = '' THEN '{default}' ELSE {x} END"


def time(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def id_order(x: str) -> str:
    """Ascending order of an id held as text: by number, NULL (not a number) first, then as text."""
    return f"TRY_CAST({x} AS DECIMAL(38,0)) NULLS FIRST, {x} NULLS FIRST"


def rewritten(x: str, by: str) -> str:
    """The value of a guarded, per-column rewrite."""
    return f"CASE WHEN {x} <> 'N/A' AND {x} <> {by} THEN {by} ELSE {x} END"


def pending(x: str, by: str) -> str:
    return f"coalesce({x} <> 'N/A' AND {x} <> {by}, FALSE)"


VALUES = "workout_number, date, set_number, exercise, reps, load, resistance_type, set_type, comments, workout_type"

# Raw sets through the workout rules, in steps that each refer to the step before.
STEPS_SQL = f"""
loaded_sets AS (
  SELECT earlier, {blank_to('workout_number', '-1')} AS workout_number, coalesce("date", '1900-01-01') AS "date",
    {blank_to('set_number', '0')} AS set_number,
    CASE WHEN {trim('exercise')} = 'N/A' THEN 'N/A' ELSE {blank_to(sentence(trim('exercise')), 'N/A')} END AS exercise,
    {blank_to('reps', '0')} AS reps, load, {blank_to('resistance_type', 'N/A')} AS resistance_type,
    {blank_to('set_type', 'N/A')} AS set_type, {blank_to('comments', 'N/A')} AS comments,
    {blank_to('workout_type', 'N/A')} AS workout_type FROM SOURCE),
stripped_sets AS (
  SELECT * REPLACE ({standard_date('"date"')} AS "date", {decimal_comma('load')} AS load,
      {rewritten('exercise', strip_special('exercise'))} AS exercise,
      {rewritten('workout_type', strip_special('workout_type'))} AS workout_type),
    {standard_date('"date"')} IS DISTINCT FROM "date" AS chg_date,
    {decimal_comma('load')} IS DISTINCT FROM load AS chg_load_dot,
    {pending('exercise', strip_special('exercise'))} OR {pending('workout_type', strip_special('workout_type'))}
      AS chg_special_chars
  FROM loaded_sets),
cased_sets AS (
  SELECT * REPLACE ({rewritten('exercise', tidy('exercise'))} AS exercise,
      {rewritten('resistance_type', tidy('resistance_type'))} AS resistance_type,
      {without_unit('load')} AS load),
    {unit('load')} AS unit,
    {pending('exercise', tidy('exercise'))} OR {pending('resistance_type', tidy('resistance_type'))}
      AS chg_capitalize,
    coalesce(regexp_matches(load, '(?i)kg|lbs'), FALSE) AS chg_load_unit
  FROM stripped_sets),
clean_sets AS (
  SELECT * REPLACE ({fill('reps', '0')} AS reps, {fill('load', '0')} AS load, {fill('set_number', '0')} AS set_number,
      {fill('exercise', 'N/A')} AS exercise, {fill('resistance_type', 'N/A')} AS resistance_type,
      {fill('set_type', 'N/A')} AS set_type, {fill('comments', 'N/A')} AS comments,
      {fill('workout_type', 'N/A')} AS workout_type, {fill('"date"', '1900-01-01')} AS "date"),
    {' OR '.join(f"{c} IS NULL OR {trim(c)} = ''" for c in ('reps', 'load', 'set_number', 'exercise',
                 'resistance_type', 'set_type', 'comments', 'workout_type', '"date"'))} AS chg_defaults
  FROM cased_sets),
unique_sets AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY workout_number, "date", set_number, exercise
      ORDER BY reps, load, unit NULLS FIRST, resistance_type, set_type, comments, workout_type) AS rn
    FROM clean_sets) WHERE rn = 1),
numbered_sets AS (
  SELECT *, row_number() OVER (ORDER BY {id_order('workout_number')}, "date", {id_order('set_number')}, exercise) AS id
  FROM unique_sets)"""


CLEAN_SETS_SQL = f"{SETS_SQL},{STEPS_SQL.replace('FROM SOURCE', 'FROM raw_sets')}"

# The same after the staging load, which keeps the first raw row of each set.
STAGED_SETS_SQL = f"""{SETS_SQL},
staged_sets AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY workout_number, "date", set_number, exercise
      ORDER BY reps, load, resistance_type, set_type, comments, workout_type) AS rn
    FROM raw_sets) WHERE rn = 1),{STEPS_SQL.replace('FROM SOURCE', 'FROM staged_sets')}"""

# Typed sets with the lowest part key of their exercise and the number of their resistance type.
FACT_SQL = f"""
typed_sets AS (
  SELECT s.workout_number, coalesce(TRY_CAST(s."date" AS DATE), DATE '1900-01-01') AS date_id, s.set_number,
    coalesce(CAST(e.exercise_id AS BIGINT), -1) AS exercise_id,
    coalesce(CAST(replace(r.resistance_id, 'R', '') AS BIGINT), -1) AS resistance_id,
    coalesce(TRY_CAST(reps AS DECIMAL(38,6)), -1) AS reps, coalesce(TRY_CAST(load AS DECIMAL(38,6)), -1) AS load,
    coalesce(unit, 'N/A') AS unit, set_type, comments, workout_type
  FROM unique_sets s LEFT JOIN (SELECT {clean('exercise_name')} AS exercise, exercise_id FROM exercise_tab) e
    ON s.exercise = e.exercise LEFT JOIN resistance_tab r ON s.resistance_type = r.resistance_type),
measured_sets AS (
  SELECT *, CASE WHEN reps >= 0 THEN reps END AS done,
    CASE WHEN reps >= 0 AND load >= 0 THEN CAST(reps AS DOUBLE) * CAST(load AS DOUBLE) END AS volume,
    CASE WHEN load >= 0 THEN load END AS lifted, year(date_id) AS y, month(date_id) AS m
  FROM typed_sets)"""
