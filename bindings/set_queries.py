"""Dedup, joins, calendar and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import sql
from bindings.registry import query
from bindings.tables import (
    CUTOFF, EARLIER_SIZE, SETS_SQL, TABS_SQL, bridge_tab, exercise_tab, muscle_tab, raw_sets, read, resistance_tab,
    ship_calendar, text, trained_pairs, unique_sets,
)
from lithic.functions.text import blank_to, normalized
from lithic.operators.checks import foreign_key_violations, key_violations, length_violations, null_violations
from lithic.operators.dedup import distinct_rows, drop_duplicates, duplicate_report, numeric_order
from lithic.operators.joins import anti_join, fill_key, lookup_join, match_parents, orphans
from lithic.plans import schemas as s
from lithic.plans.cleansing import WORKOUT_KEY, clean_workout_rows
from lithic.plans.key_index import index_keys, keys_near
from lithic.sources.shared import scratch_path
from lithic.sources.tables import TableStore, number_mark

SETS = f"WITH {SETS_SQL}"
CLEAN = f"WITH {sql.CLEAN_SETS_SQL}"


@query(
    f"{SETS} SELECT DISTINCT {sql.blank_to('exercise', 'N/A')} AS exercise, {sql.blank_to('reps', '0')} AS reps,"
    f" {sql.blank_to('load', '0')} AS load, {sql.blank_to('comments', 'N/A')} AS comments FROM raw_sets"
)
def distinct_clean(spark, sf_dir):
    defaults = {"exercise": "N/A", "reps": "0", "load": "0", "comments": "N/A"}
    return distinct_rows(raw_sets(spark, sf_dir), {c: blank_to(c, d) for c, d in defaults.items()})


@query(
    """SELECT event_id, user_id, event_type, day, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY CAST(event_id AS BIGINT)) AS rn
      FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, value
        FROM events)) WHERE rn = 1 OR user_id IS NULL OR event_type IS NULL OR day IS NULL"""
)
def dedup_keep_lowest(spark, sf_dir):
    """First event of each user, type and day; ids are text and compared as numbers."""
    events = read(spark, sf_dir, "events").select(
        text("event_id").alias("event_id"), "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value"
    )
    return drop_duplicates(events, ["user_id", "event_type", "day"], numeric_order("event_id"))


@query(
    f"{CLEAN} SELECT workout_number, date, set_number, exercise, reps, load, unit, resistance_type, set_type, comments,"
    " workout_type FROM unique_sets"
)
def dedup_sets(spark, sf_dir):
    """One row per set after cleaning; duplicates differ in other columns, ties go by value."""
    return unique_sets(spark, sf_dir)


_VARIANTS = """variants AS (
  SELECT CAST(l_partkey AS VARCHAR) AS src_id, l_orderkey, l_linenumber,
    CASE l_suppkey % 3 WHEN 0 THEN '  ' || upper(p_name) WHEN 1 THEN replace(p_name, ' ', '  ') ELSE p_name END AS name,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE p_type END AS kind
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def variants(spark, sf_dir):
    """Spellings of part names met in line items."""
    lines = read(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    rows = lookup_join(lines, read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), ["p_partkey"], "inner")
    spelling = F.col("l_suppkey") % 3
    return rows.select(
        text("p_partkey").alias("src_id"),
        "l_orderkey",
        "l_linenumber",
        F.when(spelling == 0, F.concat(F.lit("  "), F.upper("p_name")))
        .when(spelling == 1, F.replace("p_name", F.lit(" "), F.lit("  ")))
        .otherwise(F.col("p_name"))
        .alias("name"),
        F.when(F.col("l_returnflag") != "R", F.col("p_type")).alias("kind"),
    )


@query(
    f"""WITH {_VARIANTS} SELECT src_id, l_orderkey, l_linenumber, name, kind FROM (
      SELECT *, row_number() OVER (PARTITION BY src_id, {sql.normalized('name')}, {sql.normalized('kind')}
        ORDER BY l_orderkey, l_linenumber, name, kind NULLS FIRST) AS rn FROM variants) WHERE rn = 1"""
)
def dedup_normalized(spark, sf_dir):
    rows = variants(spark, sf_dir)
    key = {"src_id": F.col("src_id"), "name": normalized("name"), "kind": normalized("kind")}
    return drop_duplicates(rows, key, ["l_orderkey", "l_linenumber"], required=["src_id"])


@query(
    f"""WITH {_VARIANTS} SELECT src_id, l_orderkey, l_linenumber, name, kind FROM (
      SELECT *, row_number() OVER (PARTITION BY src_id, name, kind ORDER BY l_orderkey, l_linenumber) AS rn
      FROM variants WHERE kind IS NOT NULL) WHERE rn = 1
    UNION ALL SELECT src_id, l_orderkey, l_linenumber, name, kind FROM variants WHERE kind IS NULL"""
)
def dedup_exact(spark, sf_dir):
    """Duplicates on raw values; rows with NULL in the key are nobody's duplicate and all stay."""
    return drop_duplicates(variants(spark, sf_dir), ["src_id", "name", "kind"], ["l_orderkey", "l_linenumber"])


@query(
    f"""WITH {TABS_SQL} SELECT exercise_id, exercise_name, muscle_id, muscle_name, created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY exercise_id, {sql.normalized('exercise_name')}, muscle_id,
        {sql.normalized('muscle_name')} ORDER BY created_at) AS rn
      FROM (SELECT exercise_id, exercise_name, muscle_id, muscle_name, strftime(l_shipdate, '%Y-%m-%d') AS created_at
        FROM trained_pairs)) WHERE rn = 1"""
)
def dedup_bridge_rows(spark, sf_dir):
    """Bridge rows have no id; the earliest row of each pair stays."""
    rows = trained_pairs(spark, sf_dir).select(
        "exercise_id", "exercise_name", "muscle_id", "muscle_name",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("created_at"),
    )
    key = {
        "exercise_id": F.col("exercise_id"), "exercise_name": normalized("exercise_name"),
        "muscle_id": F.col("muscle_id"), "muscle_name": normalized("muscle_name"),
    }
    return drop_duplicates(rows, key, ["created_at"], required=["exercise_id", "muscle_id"])


@query(
    "SELECT l_orderkey, l_linenumber, min(l_partkey) AS min_id, count(*) AS n_rows FROM lineitem"
    " GROUP BY 1, 2 HAVING count(*) > 1",
    name="duplicate_report",
)
def duplicate_groups(spark, sf_dir):
    return duplicate_report(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_partkey"))


@query(
    f"{CLEAN}, {TABS_SQL} SELECT s.workout_number, s.set_number, s.exercise, e.exercise_id, r.resistance_id"
    f" FROM clean_sets s LEFT JOIN (SELECT {sql.tidy('exercise_name')} AS exercise, exercise_id FROM exercise_tab) e"
    " ON s.exercise = e.exercise LEFT JOIN resistance_tab r ON s.resistance_type = r.resistance_type"
)
def left_lookup(spark, sf_dir):
    """Sets with the ids of their exercise and resistance type, NULL without a match."""
    sets = clean_workout_rows(raw_sets(spark, sf_dir)).select("workout_number", "set_number", "exercise", "resistance_type")
    names = exercise_tab(spark, sf_dir).select(normalized("exercise_name").alias("exercise"), "exercise_id")
    kinds = resistance_tab(spark, sf_dir).select("resistance_type", "resistance_id")
    both = lookup_join(lookup_join(sets, names, ["exercise"]), kinds, ["resistance_type"])
    return both.select("workout_number", "set_number", "exercise", "exercise_id", "resistance_id")


@query(
    f"""WITH {TABS_SQL} SELECT b.exercise_id, e.exercise_movement_type, b.muscle_id, m.muscle_group, b.muscle_role
    FROM bridge_tab b JOIN (SELECT * FROM exercise_tab WHERE exercise_movement_type <> 'SMALL'
      AND exercise_bodysplit < 'Brand#12') e ON b.exercise_id = e.exercise_id
    JOIN muscle_tab m ON b.muscle_id = m.muscle_id"""
)
def bridge_parents(spark, sf_dir):
    """Bridge rows with attributes of both parents; pairs without their exercise are dropped."""
    exercises = exercise_tab(spark, sf_dir).where("exercise_movement_type <> 'SMALL' AND exercise_bodysplit < 'Brand#12'")
    parents = [
        (exercises, "exercise_id", {"exercise_id": "exercise_id", "exercise_movement_type": "exercise_movement_type"}),
        (muscle_tab(spark, sf_dir), "muscle_id", {"muscle_id": "muscle_id", "muscle_group": "muscle_group"}),
    ]
    return match_parents(bridge_tab(spark, sf_dir).select("exercise_id", "muscle_id", "muscle_role"), parents)


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS src_id, o_totalprice FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate < TIMESTAMP '{CUTOFF} 00:00:00')"""
)
def anti_source_id(spark, sf_dir):
    """Orders without a line shipped before the cutoff."""
    orders = read(spark, sf_dir, "orders").select(text("o_orderkey").alias("src_id"), "o_totalprice")
    shipped = read(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < F.lit(CUTOFF).cast("date"))
    return anti_join(orders, shipped, {"src_id": (F.col("src_id"), text("l_orderkey"))})


# The number of a line is made of its order's key and its place in the order; keys in a bucket of the index.
LINE_KEYS, KEY_WIDTH = 8, 100_000


@query(
    f"""WITH keyed AS (SELECT CAST({LINE_KEYS} * l_orderkey + l_linenumber AS VARCHAR) AS src_id, l_quantity, l_shipdate
      FROM lineitem)
    SELECT src_id, l_quantity FROM keyed k WHERE NOT EXISTS (
      SELECT 1 FROM keyed e WHERE e.src_id = k.src_id AND e.l_shipdate < TIMESTAMP '{CUTOFF} 00:00:00')"""
)
def anti_indexed(spark, sf_dir):
    """Lines that two earlier loads do not hold, found in the buckets of the lines' keys alone."""
    key = text(F.lit(LINE_KEYS) * F.col("l_orderkey") + F.col("l_linenumber")).alias("src_id")
    lines = read(spark, sf_dir, "lineitem").select(key, "l_linenumber", "l_quantity", "l_shipdate")
    store, schema = TableStore(spark, scratch_path(spark, "store")), s.table(src_id=s.TEXT)
    for half in (F.col("l_linenumber") <= 2, F.col("l_linenumber") > 2):
        earlier = lines.where(half & (F.col("l_shipdate") < F.lit(CUTOFF).cast("date"))).select("src_id")
        store.append(earlier, "warehouse", "lines", marks=number_mark("src_id"))
    index_keys(store, "warehouse", "lines", "keys", schema, "src_id", KEY_WIDTH)
    known = keys_near(store, "warehouse", "keys", "src_id", lines, "src_id", KEY_WIDTH)
    wanted = lines.select("src_id", "l_quantity")
    return wanted if known is None else anti_join(wanted, known, ["src_id"])


@query(
    f"{CLEAN} SELECT workout_number, date, set_number, exercise, reps, load FROM unique_sets s WHERE NOT EXISTS ("
    ' SELECT 1 FROM clean_sets t WHERE t.earlier AND t.workout_number = s.workout_number AND t."date" = s."date"'
    " AND t.set_number = s.set_number AND t.exercise = s.exercise)"
)
def anti_insert_new(spark, sf_dir):
    """Sets whose four-column key an earlier load does not hold."""
    known = clean_workout_rows(raw_sets(spark, sf_dir, earlier=True))
    return anti_join(unique_sets(spark, sf_dir), known, WORKOUT_KEY).select(*WORKOUT_KEY, "reps", "load")


@query(
    f"""WITH {_VARIANTS}, known AS (SELECT CAST(p_partkey AS VARCHAR) AS src_id, p_name AS name, p_type AS kind
      FROM part WHERE p_size <= {EARLIER_SIZE})
    SELECT DISTINCT src_id, name, kind FROM variants v WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.src_id = v.src_id
      AND {sql.normalized('k.name')} = {sql.normalized('v.name')} AND {sql.normalized('k.kind')} = {sql.normalized('v.kind')})"""
)
def anti_normalized(spark, sf_dir):
    """Spellings that an earlier catalogue lacks once both sides are normalised."""
    known = (
        read(spark, sf_dir, "part")
        .where(F.col("p_size") <= EARLIER_SIZE)
        .select(text("p_partkey").alias("src_id"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    )
    on = {"src_id": (F.col("src_id"), F.col("src_id"))}
    on.update({c: (normalized(c), normalized(c)) for c in ("name", "kind")})
    return anti_join(distinct_rows(variants(spark, sf_dir).select("src_id", "name", "kind")), known, on)


@query(
    f"""{CLEAN}, lookup AS (SELECT {sql.sentence('p_name')} AS exercise, min(p_partkey) AS low FROM part GROUP BY 1)
    SELECT workout_number, set_number, s.exercise, CASE WHEN known IS NULL OR known = '-1'
      THEN coalesce(CAST(low AS VARCHAR), known) ELSE known END AS exercise_id
    FROM (SELECT *, CASE set_type WHEN 'R' THEN '-1' WHEN 'A' THEN '7' END AS known FROM clean_sets) s
    LEFT JOIN lookup l ON s.exercise = l.exercise"""
)
def key_lookup(spark, sf_dir):
    """Exercise ids by name where they are missing; of several parts with a name the lowest id counts."""
    known = F.when(F.col("set_type") == "R", "-1").when(F.col("set_type") == "A", "7")
    rows = clean_workout_rows(raw_sets(spark, sf_dir)).select(
        "workout_number", "set_number", "exercise", known.alias("exercise_id")
    )
    parts = read(spark, sf_dir, "part").select(
        normalized("p_name").alias("exercise_name"), text("p_partkey").alias("exercise_id")
    )
    return fill_key(rows, parts, "exercise", "exercise_name", "exercise_id")


@query(
    "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"
    " ON l_suppkey = s_suppkey WHERE l_suppkey IS NOT NULL AND s_suppkey IS NULL"
)
def orphan_keys(spark, sf_dir):
    """Line items whose supplier is not among those with a positive balance."""
    solvent = read(spark, sf_dir, "supplier").where("s_acctbal > 0")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return orphans(lines, "l_suppkey", solvent, "s_suppkey")


@query(
    "SELECT o_orderkey, o_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"
    " ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL AND c_custkey IS NULL"
)
def foreign_keys(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return foreign_key_violations(orders, "o_custkey", customers, "c_custkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", name="key_violations")
def repeated_keys(spark, sf_dir):
    return key_violations(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    f"""{SETS} SELECT workout_number, set_number, reps, load,
      concat_ws(',', CASE WHEN reps IS NULL THEN 'reps' END, CASE WHEN load IS NULL THEN 'load' END) AS null_columns
    FROM (SELECT workout_number, set_number, nullif(reps, '') AS reps, nullif(load, '') AS load FROM raw_sets)
    WHERE reps IS NULL OR load IS NULL""",
    name="not_null_violations",
)
def missing_values(spark, sf_dir):
    rows = raw_sets(spark, sf_dir).select(
        "workout_number", "set_number", *(F.nullif(c, F.lit("")).alias(c) for c in ("reps", "load"))
    )
    return null_violations(rows, ["reps", "load"])


@query(
    """SELECT page_id, url, concat_ws(',', CASE WHEN length(url) > 30 THEN 'url' END,
      CASE WHEN length(html) > 256 THEN 'html' END) AS long_columns
    FROM pages WHERE length(url) > 30 OR length(html) > 256""",
    name="length_violations",
)
def length_limits(spark, sf_dir):
    return length_violations(read(spark, sf_dir, "pages"), {"url": 30, "html": 256}).drop("html")


@query(
    """WITH days AS (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d
      FROM lineitem)
    SELECT CAST(d AS VARCHAR) AS date, dayname(d) AS day_name_in_week, CAST(day(d) AS BIGINT) AS day_number_in_month,
      CAST(month(d) AS BIGINT) AS calendar_month_number, monthname(d) AS calendar_month_desc,
      CAST(year(d) AS BIGINT) AS calendar_year, CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend
    FROM days UNION ALL SELECT '1900-01-01', 'N/A', -1, -1, 'N/A', -1, 'N'"""
)
def date_dimension(spark, sf_dir):
    days = ship_calendar(spark, sf_dir)
    types = {c: "long" for c in ("day_number_in_month", "calendar_month_number", "calendar_year")}
    return days.withColumns({c: F.col(c).cast(t) for c, t in {**types, "date": "string"}.items()})
