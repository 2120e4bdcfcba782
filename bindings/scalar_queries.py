"""Text, date and number cleaning, row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import sql
from bindings.registry import query
from bindings.tables import (
    BATCH, EARLIER_SIZE, SETS_SQL, TABS_SQL, exercise_tab, raw_sets, read, time_text,
)
from lithic.functions.changes import changed, changed3
from lithic.functions.dates import calendar_parts, date_or_missing, standardize_date
from lithic.functions.numbers import decimal_comma
from lithic.functions.text import blank_to, same_text, sentence_case, strip_special, tidy, trim
from lithic.operators.audit import count_changes
from lithic.operators.cleaning import fill_blank, rewrite_columns, split_unit
from lithic.operators.conform import stamp
from lithic.operators.fact import typed_columns
from lithic.operators.joins import lookup_join
from lithic.plans import schemas as s
from lithic.plans.cleansing import WORKOUT_DEFAULTS, WORKOUT_RULES, clean_workout_rows, workout_flags
from lithic.plans.staging import conform_tab
from lithic.sources.shared import scratch_path
from lithic.sources.tabs import read_records, read_tab

SETS = f"WITH {SETS_SQL}"
CLEAN = f"WITH {sql.CLEAN_SETS_SQL}"


@query(f"SELECT doc_id, {sql.sentence('text')} AS raw_case, {sql.sentence(sql.trim('text'))} AS trimmed_case FROM documents")
def text_sentence_case(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", sentence_case("text").alias("raw_case"), sentence_case("text", trimmed=True).alias("trimmed_case")
    )


@query(f"SELECT doc_id, {sql.strip_special('text')} AS cleaned FROM documents")
def text_strip_special(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", strip_special("text").alias("cleaned"))


@query(f"SELECT conv_id, turn, role, {sql.trim('text')} AS trimmed FROM conversations")
def text_trim(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", trim("text").alias("trimmed"))


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.blank_to('reps', '0')} AS reps, {sql.blank_to('load', '0')} AS load,"
    f" {sql.blank_to('comments', 'N/A')} AS comments FROM raw_sets"
)
def text_blank_default(spark, sf_dir):
    return raw_sets(spark, sf_dir).select(
        "workout_number",
        "set_number",
        blank_to("reps", "0").alias("reps"),
        blank_to("load", "0").alias("load"),
        blank_to("comments", "N/A").alias("comments"),
    )


_EITHER = " OR ".join(sql.pending(c, sql.strip_special(c)) for c in ("exercise", "workout_type"))


@query(
    f"{SETS} SELECT workout_number, set_number,"
    f" CASE WHEN {_EITHER} THEN {sql.strip_special('exercise')} ELSE exercise END AS exercise,"
    f" CASE WHEN {_EITHER} THEN {sql.strip_special('workout_type')} ELSE workout_type END AS workout_type,"
    f" {_EITHER} AS changed FROM raw_sets"
)
def row_conditional_update(spark, sf_dir):
    """The literal form: one dirty column rewrites both, so 'N/A' can become 'NA'."""
    rows = raw_sets(spark, sf_dir).select("workout_number", "set_number", "exercise", "workout_type")
    return rewrite_columns(
        rows, ["exercise", "workout_type"], strip_special, "changed", row_conditional=True, guard=None
    )


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.rewritten('exercise', sql.strip_special('exercise'))} AS exercise,"
    f" {sql.rewritten('workout_type', sql.strip_special('workout_type'))} AS workout_type, {_EITHER} AS changed"
    " FROM raw_sets"
)
def guarded_update(spark, sf_dir):
    rows = raw_sets(spark, sf_dir).select("workout_number", "set_number", "exercise", "workout_type")
    return rewrite_columns(rows, ["exercise", "workout_type"], strip_special, "changed")


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.rewritten('exercise', sql.tidy('exercise'))} AS exercise,"
    f" {sql.rewritten('workout_type', sql.tidy('workout_type'))} AS workout_type FROM raw_sets"
)
def na_guard(spark, sf_dir):
    rows = raw_sets(spark, sf_dir).select("workout_number", "set_number", "exercise", "workout_type")
    return rewrite_columns(rows, ["exercise", "workout_type"], tidy)


_BLANK_DATE = "CASE WHEN comments = '  ' THEN NULL WHEN set_type = 'R' THEN '' ELSE \"date\" END"


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.standard_date('date')} AS date,"
    f" coalesce({_BLANK_DATE}, '1900-01-01') AS loaded_date FROM raw_sets"
)
def date_standardize(spark, sf_dir):
    sparse = F.when(F.col("comments") == "  ", F.lit(None)).when(F.col("set_type") == "R", "").otherwise(F.col("date"))
    return raw_sets(spark, sf_dir).select(
        "workout_number",
        "set_number",
        standardize_date("date").alias("date"),
        date_or_missing(sparse).alias("loaded_date"),
    )


@query(f"{SETS} SELECT workout_number, set_number, {sql.decimal_comma('load')} AS load FROM raw_sets", name="decimal_comma")
def decimal_point(spark, sf_dir):
    return raw_sets(spark, sf_dir).select("workout_number", "set_number", decimal_comma("load").alias("load"))


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.without_unit('load')} AS load, {sql.unit('load')} AS unit FROM raw_sets"
)
def unit_split(spark, sf_dir):
    rows = raw_sets(spark, sf_dir).select("workout_number", "set_number", "load", F.lit(None).cast("string").alias("unit"))
    return split_unit(rows, "load", "unit")


@query(
    f"{SETS} SELECT workout_number, set_number, exercise, {sql.fill('reps', '0')} AS reps, {sql.fill('load', '0')} AS load,"
    f" {sql.fill('comments', 'N/A')} AS comments FROM raw_sets",
    name="fill_blank",
)
def fill_blank_defaults(spark, sf_dir):
    rows = raw_sets(spark, sf_dir).select("workout_number", "set_number", "exercise", "reps", "load", "comments")
    return fill_blank(rows, {c: WORKOUT_DEFAULTS[c] for c in ("reps", "load", "comments")})


@query(
    f"{CLEAN} SELECT CAST(coalesce(TRY_CAST(workout_number AS INTEGER), -1) AS BIGINT) AS workout_number,"
    " CAST(coalesce(TRY_CAST(\"date\" AS DATE), DATE '1900-01-01') AS VARCHAR) AS date_id,"
    " CAST(coalesce(TRY_CAST(set_number AS INTEGER), -1) AS BIGINT) AS set_number,"
    " CAST(coalesce(TRY_CAST(reps AS DECIMAL(38,6)), -1) AS DOUBLE) AS reps,"
    " CAST(coalesce(TRY_CAST(load AS DECIMAL(38,6)), -1) AS DOUBLE) AS load,"
    " coalesce(unit, 'N/A') AS unit, set_type, comments, workout_type FROM clean_sets"
)
def typed_cast_default(spark, sf_dir):
    typed = clean_workout_rows(raw_sets(spark, sf_dir)).select(*(c.alias(n) for n, c in typed_columns().items()))
    plain = {"date_id": "string", "reps": "double", "load": "double", "workout_number": "long", "set_number": "long"}
    return typed.withColumns({c: F.col(c).cast(t) for c, t in plain.items()})


_EARLIER = f"(SELECT p_name, min(p_type) AS p_type, max(p_brand) AS p_brand FROM part WHERE p_size <= {EARLIER_SIZE} GROUP BY 1)"


@query(
    f"""WITH {TABS_SQL} SELECT exercise_name, m IS DISTINCT FROM exercise_movement_type AS movement_changed,
      coalesce(m <> exercise_movement_type, FALSE) AS movement_changed3,
      b IS DISTINCT FROM exercise_bodysplit AS bodysplit_changed,
      coalesce(b <> exercise_bodysplit, FALSE) AS bodysplit_changed3
    FROM (SELECT t.*, nullif(e.p_type, 'SMALL') AS m, e.p_brand AS b
      FROM exercise_tab t LEFT JOIN {_EARLIER} e ON t.exercise_name = e.p_name)"""
)
def change_predicates(spark, sf_dir):
    """Null-safe and three-valued change of each exercise against an earlier catalogue."""
    earlier = (
        read(spark, sf_dir, "part")
        .where(F.col("p_size") <= EARLIER_SIZE)
        .groupBy(F.col("p_name").alias("exercise_name"))
        .agg(F.nullif(F.min("p_type"), F.lit("SMALL")).alias("m"), F.max("p_brand").alias("b"))
    )
    both = lookup_join(exercise_tab(spark, sf_dir), earlier, ["exercise_name"])
    return both.select(
        "exercise_name",
        changed("m", "exercise_movement_type").alias("movement_changed"),
        changed3("m", "exercise_movement_type").alias("movement_changed3"),
        changed("b", "exercise_bodysplit").alias("bodysplit_changed"),
        changed3("b", "exercise_bodysplit").alias("bodysplit_changed3"),
    )


@query(
    f"{SETS} SELECT workout_number, set_number, {sql.folded('exercise')} IS NOT DISTINCT FROM {sql.folded('resistance_type')}"
    f" AS same_as_type, {sql.folded('exercise')} IS NOT DISTINCT FROM {sql.folded('upper(exercise)')} AS same_as_upper,"
    f" {sql.folded('comments')} IS NOT DISTINCT FROM 'ok' AS is_ok FROM raw_sets"
)
def text_equality(spark, sf_dir):
    return raw_sets(spark, sf_dir).select(
        "workout_number",
        "set_number",
        same_text("exercise", "resistance_type").alias("same_as_type"),
        same_text("exercise", F.upper("exercise")).alias("same_as_upper"),
        same_text("comments", F.lit("OK")).alias("is_ok"),
    )


@query(
    "SELECT o_orderkey, dayname(o_orderdate) AS day_name_in_week, CAST(day(o_orderdate) AS BIGINT) AS day_number_in_month,"
    " CAST(month(o_orderdate) AS BIGINT) AS calendar_month_number, monthname(o_orderdate) AS calendar_month_desc,"
    " CAST(year(o_orderdate) AS BIGINT) AS calendar_year,"
    " CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend FROM orders"
)
def order_calendar_parts(spark, sf_dir):
    parts = calendar_parts("o_orderdate")
    for name in ("day_number_in_month", "calendar_month_number", "calendar_year"):
        parts[name] = parts[name].cast("long")
    return read(spark, sf_dir, "orders").select("o_orderkey", *(c.alias(n) for n, c in parts.items()))


_COLUMNS = '"' + '", "'.join(s.WORKOUTS.columns) + '"'


@query(f"{SETS} SELECT {_COLUMNS}, '{BATCH}' AS created_at FROM raw_sets")
def tab_round_trip(spark, sf_dir):
    """The workouts tab exported as CSV, read by header, renamed, conformed and stamped."""
    headers = {c: h for h, c in s.WORKOUTS.headers.items()}
    folder = scratch_path(spark, "tabs")
    export = raw_sets(spark, sf_dir).withColumnsRenamed(headers)
    export.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{folder}/{s.WORKOUTS.name}.csv")
    rows, _ = conform_tab(read_tab(spark, folder, s.WORKOUTS.name), s.WORKOUTS)
    return stamp(rows, BATCH, updated=False).withColumn("created_at", time_text("created_at"))


def _exported(spark, sf_dir):
    return raw_sets(spark, sf_dir).withColumnsRenamed({c: h for h, c in s.WORKOUTS.headers.items()})


def _stamped_records(spark, folder):
    rows, _ = read_records(spark, folder, s.WORKOUTS.name, headers=tuple(s.WORKOUTS.headers))
    return stamp(conform_tab(rows, s.WORKOUTS)[0], BATCH, updated=False).withColumn("created_at", time_text("created_at"))


@query(f"{SETS} SELECT {_COLUMNS}, '{BATCH}' AS created_at FROM raw_sets")
def tab_round_trip_json(spark, sf_dir):
    """The workouts tab exported as JSON lines and read back."""
    folder = scratch_path(spark, "tabs")
    _exported(spark, sf_dir).write.json(f"{folder}/{s.WORKOUTS.name}.json")
    return _stamped_records(spark, folder)


@query(f"{SETS} SELECT {_COLUMNS}, '{BATCH}' AS created_at FROM raw_sets")
def tab_round_trip_parquet(spark, sf_dir):
    """The workouts tab exported as Parquet and read back."""
    folder = scratch_path(spark, "tabs")
    _exported(spark, sf_dir).write.parquet(f"{folder}/{s.WORKOUTS.name}.parquet")
    return _stamped_records(spark, folder)


@query(
    f"""{SETS} SELECT CASE WHEN set_number = '7' THEN 'unread' ELSE 'read' END AS kind, count(*) AS n_records,
      sum(CAST(workout_number AS BIGINT))::BIGINT AS workouts FROM raw_sets GROUP BY 1"""
)
def unread_records(spark, sf_dir):
    """Records read and not read from an export in which the lines of all seventh sets are cut off before their end."""
    folder, exported = scratch_path(spark, "tabs"), _exported(spark, sf_dir)
    line = F.to_json(F.struct(*exported.columns))
    cut = F.when(F.col("Set") == "7", F.expr("substr(line, 1, length(line) - 1)")).otherwise(F.col("line"))
    exported.select("Set", line.alias("line")).select(cut.alias("value")).write.text(f"{folder}/{s.WORKOUTS.name}.json")
    rows, lost = read_records(spark, folder, s.WORKOUTS.name, headers=tuple(s.WORKOUTS.headers))
    number = F.regexp_extract("record", '"Workout number":"([0-9]+)"', 1)
    both = rows.select(F.lit("read").alias("kind"), F.col("Workout number").alias("number")).unionByName(
        lost.select(F.lit("unread").alias("kind"), number.alias("number"))
    )
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.col("number").cast("long")).alias("workouts")
    )


@query(
    f"{CLEAN} SELECT "
    + ", ".join(f"CAST(count(*) FILTER (WHERE chg_{r}) AS BIGINT) AS {r}" for r in WORKOUT_RULES)
    + ", CAST("
    + " + ".join(f"count(*) FILTER (WHERE chg_{r})" for r in WORKOUT_RULES)
    + " AS BIGINT) AS total_changed FROM clean_sets"
)
def change_audit(spark, sf_dir):
    """Rows changed by each cleaning rule, from one pass."""
    cleaned = clean_workout_rows(raw_sets(spark, sf_dir)).select(*(c.alias(n) for n, c in workout_flags().items()))
    return count_changes(cleaned, WORKOUT_RULES)
