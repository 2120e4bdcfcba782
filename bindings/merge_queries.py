"""Upserts, merges, keys, fact, sinks, reports and the full run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bindings import sql
from bindings.registry import query
from bindings.tables import (
    BATCH, CUTOFF, EARLIER_BATCH, EARLIER_SIZE, SETS_SQL, TABS_SQL, bridge_tab, exercise_dimension, exercise_tab,
    muscle_tab, raw_sets, read, resistance_dimension, ship_calendar, tabs, text, trained_pairs, typed_sets,
    unique_sets,
)
from lithic.functions.text import MISSING_TEXT, blank_to
from lithic.operators.dedup import first_per_key, numeric_order
from lithic.operators.fact import load_fact, write_fact
from lithic.operators.feed import change_feed
from lithic.operators.joins import lookup_join, match_parents
from lithic.operators.keys import assign_keys
from lithic.operators.merge import (
    cleansing_insert, ensure_unknown, insert_new, merge_bridge, merge_dimension, update_from, upsert,
)
from lithic.operators.rules import foreign_name, judged
from lithic.plans import reports
from lithic.plans import schemas as s
from lithic.plans.rollup import roll_up
from lithic.plans.run import QUARANTINE, Run, run_tabs
from lithic.sources.shared import scratch_path, stable
from lithic.sources.tables import TableStore, append

PAIR = ["exercise_src_id", "muscle_src_id"]
ATTRS = ["exercise_name", "exercise_movement_type", "exercise_bodysplit"]


def moment(value: str):
    return F.lit(value).cast("timestamp")


def parts(spark, sf_dir, earlier: bool = False) -> DataFrame:
    """Parts as exercises; the earlier catalogue is smaller and spells some values differently."""
    rows = read(spark, sf_dir, "part")
    if earlier:
        rows = rows.where(F.col("p_size") <= EARLIER_SIZE)
    kind = F.when(F.col("p_type") == "SMALL", "TINY").otherwise(F.col("p_type")) if earlier else F.col("p_type")
    name = F.nullif(F.col("p_name"), F.lit("blue bolt")) if earlier else F.col("p_name")
    return rows.select(
        "p_partkey", "p_retailprice", text("p_partkey").alias("exercise_id"), name.alias("exercise_name"),
        kind.alias("exercise_movement_type"), F.col("p_brand").alias("exercise_bodysplit"),
    )


PARTS_SQL = f"""
parts AS (SELECT p_partkey, p_retailprice, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS kind, p_brand AS body
  FROM part),
earlier_parts AS (SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS id, nullif(p_name, 'blue bolt') AS name,
  CASE WHEN p_type = 'SMALL' THEN 'TINY' ELSE p_type END AS kind, p_brand AS body
  FROM part WHERE p_size <= {EARLIER_SIZE})"""

# Parts above this price are listed a second time further down, with another value.
RELISTED_PRICE = 950


def staged(df: DataFrame) -> DataFrame:
    return df.withColumns({"created_at": moment(EARLIER_BATCH), "updated_at": moment(EARLIER_BATCH)})


def listing(spark, sf_dir, again: dict) -> DataFrame:
    """Every part once, then the dearer ones again with other values, in row order."""
    first = parts(spark, sf_dir).withColumn("row_no", F.col("p_partkey") * 10)
    more = first.where(F.col("p_retailprice") >= RELISTED_PRICE)
    for position, values in again.items():
        first = first.unionByName(more.withColumns({**values, "row_no": F.col("p_partkey") * 10 + position}))
    return first


def with_time_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


@query(
    f"""WITH {PARTS_SQL}, final AS (SELECT id, name, body, CASE WHEN p_retailprice >= {RELISTED_PRICE}
      THEN 'REVISED' ELSE kind END AS kind, p_retailprice >= {RELISTED_PRICE} AS twice, kind AS first_kind FROM parts)
    SELECT f.id AS exercise_id, f.name AS exercise_name, f.kind AS exercise_movement_type, f.body AS exercise_bodysplit,
      CASE WHEN e.id IS NULL THEN '{BATCH}' ELSE '{EARLIER_BATCH}' END AS created_at,
      CASE WHEN e.id IS NULL OR f.name IS DISTINCT FROM e.name OR f.kind IS DISTINCT FROM e.kind
        OR f.first_kind IS DISTINCT FROM e.kind THEN '{BATCH}' ELSE '{EARLIER_BATCH}' END AS updated_at
    FROM final f LEFT JOIN earlier_parts e ON f.id = e.id"""
)
def staging_upsert(spark, sf_dir):
    """Exact comparison; a later listing of a part wins."""
    target = staged(parts(spark, sf_dir, earlier=True).select("exercise_id", *ATTRS))
    source = listing(spark, sf_dir, {1: {"exercise_movement_type": F.lit("REVISED")}})
    result = upsert(target, source, ["exercise_id"], ATTRS, ["row_no"], BATCH)
    return with_time_text(result, "created_at", "updated_at")


@query(
    f"""WITH {PARTS_SQL}, rows AS (
      SELECT id, upper(p_name) AS name, -1 AS pos FROM part JOIN parts ON part.p_partkey = parts.p_partkey
        WHERE p_size <= {EARLIER_SIZE}
      UNION ALL SELECT id, name, 0 FROM parts
      UNION ALL SELECT id, 'new ' || name, 1 FROM parts WHERE p_retailprice >= {RELISTED_PRICE} AND kind = 'SMALL'
      UNION ALL SELECT id, ' ' || upper(name), 2 FROM parts WHERE p_retailprice >= {RELISTED_PRICE}
      UNION ALL SELECT id, name || ' ', 3 FROM parts WHERE p_retailprice >= {RELISTED_PRICE}),
    texts AS (SELECT *, {sql.folded('name')} AS t FROM rows),
    ends AS (SELECT id, arg_max(t, pos) AS t, min(pos) AS first_pos, count(DISTINCT t) AS n FROM texts GROUP BY id),
    breaks AS (SELECT x.id, max(x.pos) AS b FROM texts x JOIN ends e ON x.id = e.id AND x.t <> e.t GROUP BY x.id)
    SELECT e.id AS muscle_id, arg_min(x.name, x.pos) AS muscle_name,
      CASE WHEN e.first_pos = -1 THEN '{EARLIER_BATCH}' ELSE '{BATCH}' END AS created_at,
      CASE WHEN e.first_pos = -1 AND e.n = 1 THEN '{EARLIER_BATCH}' ELSE '{BATCH}' END AS updated_at
    FROM ends e JOIN texts x ON e.id = x.id LEFT JOIN breaks b ON e.id = b.id
    WHERE x.pos > coalesce(b.b, -2) GROUP BY e.id, e.first_pos, e.n"""
)
def staging_upsert_text(spark, sf_dir):
    """Case and outer spaces are no change: the spelling of the last real change stays."""
    early = read(spark, sf_dir, "part").where(F.col("p_size") <= EARLIER_SIZE)
    target = staged(early.select(text("p_partkey").alias("muscle_id"), F.upper("p_name").alias("muscle_name")))
    name = F.col("muscle_name")
    first = read(spark, sf_dir, "part").select(
        text("p_partkey").alias("muscle_id"), F.col("p_name").alias("muscle_name"), "p_type", "p_retailprice",
        F.lit(0).alias("row_no"),
    )
    again = first.where(F.col("p_retailprice") >= RELISTED_PRICE)
    source = (
        first.unionByName(
            again.where("p_type = 'SMALL'").withColumns({"muscle_name": F.concat(F.lit("new "), name), "row_no": F.lit(1)})
        )
        .unionByName(again.withColumns({"muscle_name": F.concat(F.lit(" "), F.upper(name)), "row_no": F.lit(2)}))
        .unionByName(again.withColumns({"muscle_name": F.concat(name, F.lit(" ")), "row_no": F.lit(3)}))
    )
    result = upsert(target, source, ["muscle_id"], ["muscle_name"], ["row_no"], BATCH, text_insensitive=True)
    return with_time_text(result, "created_at", "updated_at")


_SET_COLUMNS = 'workout_number, "date", set_number, exercise, reps, load, resistance_type, set_type, comments, workout_type'
_FIRST = (
    'row_number() OVER (PARTITION BY workout_number, "date", set_number, exercise'
    " ORDER BY reps, load, resistance_type, set_type, comments, workout_type) AS rn"
)


@query(
    f"""WITH {SETS_SQL}, old AS (SELECT * FROM (SELECT *, {_FIRST} FROM raw_sets WHERE earlier) WHERE rn = 1),
    new AS (SELECT * FROM (SELECT *, {_FIRST} FROM raw_sets) WHERE rn = 1)
    SELECT {_SET_COLUMNS}, '{EARLIER_BATCH}' AS created_at FROM old UNION ALL
    SELECT {_SET_COLUMNS}, '{BATCH}' AS created_at FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o
      WHERE o.workout_number = n.workout_number AND o."date" = n."date" AND o.set_number = n.set_number
      AND o.exercise = n.exercise)"""
)
def staging_insert_new(spark, sf_dir):
    columns = list(s.WORKOUTS.columns)
    known = first_per_key(raw_sets(spark, sf_dir, earlier=True), s.WORKOUTS.keys, columns)
    source = raw_sets(spark, sf_dir).withColumn("created_at", moment(BATCH))
    result = insert_new(known.withColumn("created_at", moment(EARLIER_BATCH)), source, s.WORKOUTS.keys, columns)
    return with_time_text(result, "created_at")


def cleansed(df: DataFrame) -> DataFrame:
    return df.withColumns({"created_at": moment(EARLIER_BATCH), "updated_at": F.lit(None).cast("timestamp")})


_NEW_NAME = "CASE WHEN p.kind = 'PROMO' THEN '  ' WHEN p.body = 'Brand#7' THEN NULL ELSE ' ' || upper(p.name) || ' ' END"
_NAME_HIT = f"nullif({sql.trim(_NEW_NAME)}, '') IS NOT NULL AND {sql.sentence(sql.trim(_NEW_NAME))} IS DISTINCT FROM {sql.sentence(sql.trim('e.name'))}"
_KIND_HIT = f"{sql.sentence(sql.trim('p.kind'))} IS DISTINCT FROM {sql.sentence(sql.trim('e.kind'))}"


@query(
    f"""WITH {PARTS_SQL} SELECT e.id AS exercise_src_id,
      CASE WHEN {_NAME_HIT} OR {_KIND_HIT} THEN coalesce(nullif({sql.trim(_NEW_NAME)}, ''), e.name) ELSE e.name END
        AS exercise_name,
      CASE WHEN {_NAME_HIT} OR {_KIND_HIT} THEN p.kind ELSE e.kind END AS exercise_movement_type,
      '{EARLIER_BATCH}' AS created_at, CASE WHEN {_NAME_HIT} OR {_KIND_HIT} THEN '{BATCH}' END AS updated_at
    FROM earlier_parts e JOIN parts p ON e.id = p.id"""
)
def cleansing_update(spark, sf_dir):
    """Staged values replace target values that differ beyond case and spaces; blanks never do."""
    attrs = ["exercise_name", "exercise_movement_type"]
    target = cleansed(
        parts(spark, sf_dir, earlier=True).select(F.col("exercise_id").alias("exercise_src_id"), *attrs)
    )
    staged_name = (
        F.when(F.col("exercise_movement_type") == "PROMO", "  ")
        .when(F.col("exercise_bodysplit") != "Brand#7", F.concat(F.lit(" "), F.upper("exercise_name"), F.lit(" ")))
        .alias("exercise_name")
    )
    source = parts(spark, sf_dir).select(
        F.col("exercise_id").alias("exercise_src_id"), staged_name, "exercise_movement_type"
    )
    result = update_from(target, source, ["exercise_src_id"], attrs, BATCH)
    return with_time_text(result, "created_at", "updated_at")


EARLIEST = "1996-01-01"


def early_pairs(spark, sf_dir) -> DataFrame:
    return (
        trained_pairs(spark, sf_dir)
        .where(F.col("l_shipdate") < F.lit(EARLIEST).cast("date"))
        .groupBy("exercise_id", "exercise_name", "muscle_id", "muscle_name")
        .agg(F.min("l_returnflag").alias("muscle_role"))
    )


_EARLY_SQL = f"""
early_pairs AS (SELECT exercise_id, exercise_name, muscle_id, muscle_name, min(l_returnflag) AS muscle_role
  FROM trained_pairs WHERE l_shipdate < TIMESTAMP '{EARLIEST} 00:00:00' GROUP BY ALL)"""


@query(
    f"""WITH {TABS_SQL}, {_EARLY_SQL}, old AS (SELECT exercise_id, muscle_id,
      CASE muscle_role WHEN 'A' THEN 'Primary' WHEN 'N' THEN 'Secondary' ELSE 'N/A' END AS role FROM early_pairs),
    new AS (SELECT b.exercise_id, b.muscle_id, CASE WHEN m.muscle_group = 'ASIA' THEN ' ' ELSE b.muscle_role END AS role
      FROM bridge_tab b JOIN muscle_tab m ON b.muscle_id = m.muscle_id
      JOIN (SELECT * FROM exercise_tab WHERE exercise_bodysplit < 'Brand#12') e ON b.exercise_id = e.exercise_id),
    joined AS (SELECT o.*, n.role AS new_role, n.exercise_id IS NOT NULL
      AND {sql.normalized('n.role')} IS DISTINCT FROM {sql.normalized('o.role')} AS hit
      FROM old o LEFT JOIN new n ON o.exercise_id = n.exercise_id AND o.muscle_id = n.muscle_id)
    SELECT exercise_id AS exercise_src_id, muscle_id AS muscle_src_id,
      CASE WHEN hit THEN coalesce(nullif({sql.trim('new_role')}, ''), role) ELSE role END AS muscle_role,
      CASE WHEN hit THEN '{BATCH}' END AS updated_at FROM joined"""
)
def bridge_update(spark, sf_dir):
    """A blank staged role counts as a change and keeps the text; the pair must match both parents."""
    role = F.when(F.col("muscle_role") == "A", "Primary").when(F.col("muscle_role") == "N", "Secondary")
    target = cleansed(
        early_pairs(spark, sf_dir).select(
            F.col("exercise_id").alias("exercise_src_id"),
            F.col("muscle_id").alias("muscle_src_id"),
            role.otherwise(MISSING_TEXT).alias("muscle_role"),
        )
    )
    exercises = exercise_tab(spark, sf_dir).where("exercise_bodysplit < 'Brand#12'")
    matched = match_parents(
        bridge_tab(spark, sf_dir).select("exercise_id", "muscle_id", "muscle_role"),
        [
            (exercises, "exercise_id", {"exercise_id": "exercise_id"}),
            (muscle_tab(spark, sf_dir), "muscle_id", {"muscle_id": "muscle_id", "muscle_group": "muscle_group"}),
        ],
    )
    source = matched.select(
        F.col("exercise_id").alias("exercise_src_id"),
        F.col("muscle_id").alias("muscle_src_id"),
        F.when(F.col("muscle_group") == "ASIA", " ").otherwise(F.col("muscle_role")).alias("muscle_role"),
    )
    result = update_from(target, source, PAIR, ["muscle_role"], BATCH, blank_is_change=True)
    return with_time_text(result, "updated_at").drop("created_at")


@query(
    f"""WITH {PARTS_SQL}, fresh AS (SELECT DISTINCT p.id, {sql.blank_to('p.name', 'N/A')} AS name,
      {sql.blank_to('p.kind', 'N/A')} AS kind, {sql.blank_to('p.body', 'N/A')} AS body
      FROM parts p WHERE NOT EXISTS (SELECT 1 FROM earlier_parts e WHERE e.id = p.id))
    SELECT CAST((SELECT max(p_partkey) FROM earlier_parts) + row_number() OVER (ORDER BY CAST(id AS BIGINT)) AS VARCHAR)
      AS exercise_id, id AS exercise_src_id, name AS exercise_name, kind AS exercise_movement_type,
      body AS exercise_bodysplit, '{BATCH}' AS created_at, CAST(NULL AS VARCHAR) AS updated_at FROM fresh"""
)
def cleansing_insert_new(spark, sf_dir):
    """Parts the table lacks, numbered after its highest id."""
    old = parts(spark, sf_dir, earlier=True)
    target = cleansed(old.select("exercise_id", F.col("exercise_id").alias("exercise_src_id"), *ATTRS))
    source = parts(spark, sf_dir).select("exercise_id", *ATTRS)
    columns = {"exercise_src_id": F.col("exercise_id"), **{a: blank_to(a, MISSING_TEXT) for a in ATTRS}}
    order = numeric_order("exercise_src_id")
    result = cleansing_insert(target, source, "exercise_id", columns, ["exercise_src_id"], order, BATCH)
    return with_time_text(result, "created_at", "updated_at")


def dimension(df: DataFrame) -> DataFrame:
    stamps = {"ta_created_at": moment(EARLIER_BATCH), "ta_updated_at": moment(EARLIER_BATCH)}
    return df.select(
        (F.col("p_partkey") + 1).alias("exercise_id"), F.col("exercise_id").alias("exercise_src_id"), *ATTRS
    ).withColumns(stamps)


_CHANGED = "coalesce(p.name <> e.name, FALSE) OR coalesce(p.kind <> e.kind, FALSE) OR coalesce(p.body <> e.body, FALSE)"


@query(
    f"""WITH {PARTS_SQL}, old AS (SELECT p_partkey + 1 AS sk, e.* FROM earlier_parts e),
    fresh AS (SELECT (SELECT max(sk) FROM old) + row_number() OVER (ORDER BY p_partkey) AS sk, * FROM parts
      WHERE id NOT IN (SELECT id FROM old))
    SELECT e.sk AS exercise_id, e.id AS exercise_src_id, CASE WHEN {_CHANGED} THEN p.name ELSE e.name END AS exercise_name,
      CASE WHEN {_CHANGED} THEN p.kind ELSE e.kind END AS exercise_movement_type,
      CASE WHEN {_CHANGED} THEN p.body ELSE e.body END AS exercise_bodysplit,
      '{EARLIER_BATCH}' AS ta_created_at, CASE WHEN {_CHANGED} THEN '{BATCH}' ELSE '{EARLIER_BATCH}' END AS ta_updated_at
    FROM old e JOIN parts p ON e.id = p.id
    UNION ALL SELECT sk, id, name, kind, body, '{BATCH}', '{BATCH}' FROM fresh"""
)
def dimension_merge(spark, sf_dir):
    target = dimension(parts(spark, sf_dir, earlier=True))
    source = parts(spark, sf_dir).select(F.col("exercise_id").alias("exercise_src_id"), *ATTRS)
    order = numeric_order("exercise_src_id")
    result = merge_dimension(target, source, ["exercise_src_id"], ATTRS, BATCH, "exercise_id", order)
    return with_time_text(result, "ta_created_at", "ta_updated_at")


@query(
    f"""WITH {TABS_SQL}, {_EARLY_SQL}
    SELECT CAST(b.exercise_id AS BIGINT) AS exercise_id, b.exercise_id AS exercise_src_id,
      CAST(b.muscle_id AS BIGINT) AS muscle_id, b.muscle_id AS muscle_src_id, b.muscle_role,
      CASE WHEN o.muscle_id IS NULL THEN '{BATCH}' ELSE '{EARLIER_BATCH}' END AS ta_created_at,
      CASE WHEN o.muscle_id IS NULL OR o.muscle_role <> b.muscle_role THEN '{BATCH}' ELSE '{EARLIER_BATCH}' END
        AS ta_updated_at
    FROM bridge_tab b LEFT JOIN (SELECT exercise_id, muscle_id,
        CASE WHEN muscle_role = 'A' THEN ' secondary ' ELSE 'primary' END AS muscle_role FROM early_pairs) o
      ON b.exercise_id = o.exercise_id AND b.muscle_id = o.muscle_id"""
)
def bridge_merge(spark, sf_dir):
    def keyed(df):
        return df.select(
            F.col("exercise_id").cast("long").alias("exercise_id"), F.col("exercise_id").alias("exercise_src_id"),
            F.col("muscle_id").cast("long").alias("muscle_id"), F.col("muscle_id").alias("muscle_src_id"), "muscle_role",
        )

    role = F.when(F.col("muscle_role") == "A", " secondary ").otherwise("primary")
    stamps = {"ta_created_at": moment(EARLIER_BATCH), "ta_updated_at": moment(EARLIER_BATCH)}
    target = keyed(early_pairs(spark, sf_dir).withColumn("muscle_role", role)).withColumns(stamps)
    source = keyed(bridge_tab(spark, sf_dir))
    result = merge_bridge(target, source, PAIR, ["muscle_role"], ["exercise_id", "muscle_id"], BATCH)
    return with_time_text(result, "ta_created_at", "ta_updated_at")


@query(
    f"""WITH {PARTS_SQL} SELECT p_partkey + 1 AS exercise_id, id AS exercise_src_id, name AS exercise_name,
      kind AS exercise_movement_type, body AS exercise_bodysplit, '{EARLIER_BATCH}' AS ta_created_at FROM parts
    UNION ALL SELECT -1, '-1', 'N/A', 'N/A', 'N/A', '{BATCH}'"""
)
def unknown_member(spark, sf_dir):
    """Adding the member twice adds it once."""
    dim = dimension(parts(spark, sf_dir)).drop("ta_updated_at")
    for batch in (BATCH, "2025-08-04 06:00:00"):
        dim = ensure_unknown(dim, "exercise_id", "exercise_src_id", batch)
    return with_time_text(dim, "ta_created_at")


@query(
    """SELECT l_orderkey, l_linenumber, 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS id
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)"""
)
def surrogate_keys(spark, sf_dir):
    keys = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return assign_keys(keys, "id", ["l_orderkey", "l_linenumber"], start=1000)


_CL_IDS = """
cl_exercises AS (SELECT *, row_number() OVER (ORDER BY TRY_CAST(exercise_id AS BIGINT) NULLS FIRST, exercise_id) AS sk
  FROM exercise_tab),
cl_resistances AS (SELECT *, row_number() OVER (ORDER BY TRY_CAST(resistance_id AS BIGINT) NULLS FIRST, resistance_id) AS sk
  FROM resistance_tab)"""

_FACT_COLUMNS = f"""CAST(id AS VARCHAR) AS src_id, CAST(s.workout_number AS BIGINT) AS workout_number,
    CAST(s."date" AS VARCHAR) AS date_id, CAST(s.set_number AS BIGINT) AS set_number,
    coalesce(e.sk, -1) AS exercise_id, CAST(coalesce(TRY_CAST(reps AS DECIMAL(38,6)), -1) AS DOUBLE) AS reps,
    CAST(coalesce(TRY_CAST(load AS DECIMAL(38,6)), -1) AS DOUBLE) AS load, coalesce(unit, 'N/A') AS unit,
    coalesce(r.sk, -1) AS resistance_id, set_type, comments, workout_type
  FROM numbered_sets s LEFT JOIN (SELECT {sql.clean('exercise_name')} AS exercise, sk FROM cl_exercises) e
    ON s.exercise = e.exercise LEFT JOIN cl_resistances r ON s.resistance_type = r.resistance_type"""


def plain_fact(df: DataFrame) -> DataFrame:
    types = {"workout_number": "long", "set_number": "long", "date_id": "string", "reps": "double", "load": "double"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()}).drop("ta_created_at", "month")


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {_CL_IDS}, facts AS (SELECT {_FACT_COLUMNS}),
    old AS (SELECT max(CAST(src_id AS BIGINT)) AS top FROM facts WHERE date_id < '{CUTOFF}')
    SELECT old.top + row_number() OVER (ORDER BY date_id, CAST(src_id AS BIGINT)) AS id, facts.*
    FROM facts, old WHERE date_id >= '{CUTOFF}'"""
)
def fact_load(spark, sf_dir):
    """Sets of the later dates, keyed to both dimensions and numbered after the facts already there."""
    sets = unique_sets(spark, sf_dir)
    order = [*numeric_order("workout_number"), "date", *numeric_order("set_number"), "exercise"]
    names = assign_keys(exercise_tab(spark, sf_dir), "sk", numeric_order("exercise_id"))
    kinds = resistance_dimension(spark, sf_dir).withColumn("rid", F.concat(F.lit("R"), "resistance_id"))
    kinds = assign_keys(kinds, "sk", numeric_order("rid"))
    exercises = names.select(
        F.col("exercise_id").alias("exercise_src_id"), F.col("sk").alias("exercise_id"), "exercise_name"
    )
    kinds = kinds.select(F.col("rid").alias("resistance_src_id"), F.col("sk").alias("resistance_id"), "resistance_type")
    by_name = exercise_dimension(spark, sf_dir).select(
        F.col("exercise_name").alias("exercise"), text("exercise_id").alias("exercise_id")
    )
    by_type = kinds.select("resistance_type", F.col("resistance_src_id").alias("resistance_id"))
    source = lookup_join(assign_keys(sets, "id", order), by_name, ["exercise"])
    source = lookup_join(source, by_type, ["resistance_type"]).withColumn("id", text("id"))
    earlier = source.where(F.col("date") < CUTOFF).select(F.col("id").cast("long").alias("id"), F.col("id").alias("src_id"))
    return plain_fact(load_fact(source, exercises, kinds, earlier, BATCH))


MONTHS = ("1996-07-01", "2001-06-30")


@query(
    f"""WITH {sql.CLEAN_SETS_SQL} SELECT CASE WHEN "date" BETWEEN '{MONTHS[0]}' AND '{MONTHS[1]}'
      THEN replace(substr("date", 1, 7), '-', '_') ELSE 'default' END AS month, count(*) AS n_rows
    FROM unique_sets GROUP BY 1"""
)
def month_partition_counts(spark, sf_dir):
    """Rows of each month partition after the fact is written and read back."""
    path = scratch_path(spark, "fact")
    write_fact(typed_sets(spark, sf_dir), path, *MONTHS)
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def appended_rows(spark, sf_dir):
    """Two appends to one table: the orders before the cutoff, then the others."""
    path = scratch_path(spark, "orders")
    orders = read(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(CUTOFF).cast("date")
    for half in (early, ~early):
        append(orders.where(half).select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("SELECT CAST(p_partkey AS VARCHAR) AS exercise_id, p_name AS exercise_name, p_type AS exercise_movement_type FROM part")
def published_versions(spark, sf_dir):
    """The second published version of a table, computed from the first, replaces it."""
    schema = s.table(exercise_id=s.TEXT, exercise_name=s.TEXT, exercise_movement_type=s.TEXT)
    store = TableStore(spark, scratch_path(spark, "store"))
    store.publish(parts(spark, sf_dir, earlier=True).select(*schema.names), "staging", "exercises", schema)
    known = staged(store.read("staging", "exercises", schema))
    source = parts(spark, sf_dir).withColumn("row_no", F.lit(0))
    content = upsert(known, source, ["exercise_id"], schema.names[1:], ["row_no"], BATCH)
    store.publish(content, "staging", "exercises", schema)
    return store.read("staging", "exercises", schema)


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {sql.FACT_SQL}
    SELECT {sql.clean('e.exercise_name')} AS exercise_name, y AS calendar_year, m AS calendar_month_number,
      count(*) AS sets, coalesce(sum(volume), 0) AS volume, CAST(coalesce(max(lifted), 0) AS DOUBLE) AS max_load
    FROM measured_sets f JOIN exercise_tab e ON f.exercise_id = CAST(e.exercise_id AS BIGINT) GROUP BY 1, 2, 3"""
)
def volume_by_exercise(spark, sf_dir):
    report = reports.volume_by_exercise(
        typed_sets(spark, sf_dir), exercise_dimension(spark, sf_dir), ship_calendar(spark, sf_dir)
    )
    return report.withColumns({c: F.col(c).cast("long") for c in reports.MONTH})


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {sql.FACT_SQL}
    SELECT muscle_group, muscle_role, y AS calendar_year, m AS calendar_month_number, count(*) AS sets,
      CAST(coalesce(sum(done), 0) AS DOUBLE) AS reps, coalesce(sum(volume), 0) AS volume
    FROM measured_sets f JOIN bridge_tab b ON f.exercise_id = CAST(b.exercise_id AS BIGINT)
      JOIN muscle_tab t ON b.muscle_id = t.muscle_id GROUP BY 1, 2, 3, 4"""
)
def volume_by_muscle(spark, sf_dir):
    bridge = bridge_tab(spark, sf_dir).withColumn("exercise_id", F.col("exercise_id").cast("long"))
    report = reports.volume_by_muscle(
        typed_sets(spark, sf_dir), bridge, muscle_tab(spark, sf_dir), ship_calendar(spark, sf_dir)
    )
    return report.withColumns({c: F.col(c).cast("long") for c in reports.MONTH})


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {sql.FACT_SQL}
    SELECT resistance_category, count(*) FILTER (WHERE dayofweek(date_id) NOT IN (0, 6)) AS weekday_sets,
      count(*) FILTER (WHERE dayofweek(date_id) IN (0, 6)) AS weekend_sets
    FROM measured_sets f JOIN resistance_tab r
      ON f.resistance_id = CAST(replace(r.resistance_id, 'R', '') AS BIGINT) GROUP BY 1"""
)
def sets_by_resistance(spark, sf_dir):
    return reports.sets_by_resistance(
        typed_sets(spark, sf_dir), resistance_dimension(spark, sf_dir), ship_calendar(spark, sf_dir)
    )


def rolled_up(spark, sf_dir):
    """Daily sums of the sets, appended in two batches and summed up after each.

    The sets are written once, so that the batches don't clean them and remove their duplicates twice.
    """
    store, sets = TableStore(spark, scratch_path(spark, "store")), stable(typed_sets(spark, sf_dir))
    early = F.col("date_id") < F.lit(CUTOFF).cast("date")
    stored = StructType([*sets.schema.fields, s.FACT_STORED["month"]])
    for half in (early, ~early):
        store.append_fact(sets.where(half), "warehouse", "fact", *MONTHS, arrange=True)
        roll_up(store, "warehouse", "fact", "daily", stored, *MONTHS)
    return store.read("warehouse", "daily", s.DAILY_STORED)


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {sql.FACT_SQL}
    SELECT {sql.clean('e.exercise_name')} AS exercise_name, y AS calendar_year, m AS calendar_month_number,
      count(*) AS sets, coalesce(sum(volume), 0) AS volume, CAST(coalesce(max(lifted), 0) AS DOUBLE) AS max_load
    FROM measured_sets f JOIN exercise_tab e ON f.exercise_id = CAST(e.exercise_id AS BIGINT) GROUP BY 1, 2, 3"""
)
def rolled_up_volume(spark, sf_dir):
    """Volume per exercise and month from the daily sums alone."""
    report = reports.volume_by_exercise(
        rolled_up(spark, sf_dir), exercise_dimension(spark, sf_dir), ship_calendar(spark, sf_dir)
    )
    return report.withColumns({c: F.col(c).cast("long") for c in reports.MONTH})


SPAN = ("1996-11-20", "1998-02-10")


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}, {TABS_SQL}, {sql.FACT_SQL}
    SELECT resistance_category, count(*) FILTER (WHERE dayofweek(date_id) NOT IN (0, 6)) AS weekday_sets,
      count(*) FILTER (WHERE dayofweek(date_id) IN (0, 6)) AS weekend_sets
    FROM measured_sets f JOIN resistance_tab r
      ON f.resistance_id = CAST(replace(r.resistance_id, 'R', '') AS BIGINT)
    WHERE date_id BETWEEN '{SPAN[0]}' AND '{SPAN[1]}' GROUP BY 1"""
)
def sets_in_span(spark, sf_dir):
    """Sets per resistance category in a span of days, from the daily sums of its months."""
    return reports.sets_by_resistance(
        reports.between(rolled_up(spark, sf_dir), *SPAN, *MONTHS),
        resistance_dimension(spark, sf_dir),
        ship_calendar(spark, sf_dir),
    )


@query(
    f"""WITH {PARTS_SQL}
    SELECT p.id AS exercise_src_id, e.name AS name_before, p.name AS name_after, 1 AS copies,
      CASE WHEN e.id IS NULL THEN 'inserted' WHEN {_CHANGED} THEN 'updated' ELSE 'kept' END AS action
    FROM parts p LEFT JOIN earlier_parts e ON e.id = p.id"""
)
def dimension_changes(spark, sf_dir):
    """What merging the parts into the earlier catalogue does to each of them."""
    target = dimension(parts(spark, sf_dir, earlier=True))
    source = parts(spark, sf_dir).select(F.col("exercise_id").alias("exercise_src_id"), *ATTRS)
    feed = change_feed(target, source, ["exercise_src_id"], ATTRS, surrogate="exercise_id")
    names = (F.col(f"{side}.exercise_name").alias(f"name_{side}") for side in ("before", "after"))
    return feed.rows.select("exercise_src_id", *names, F.col("copies").cast("int").alias("copies"), "action")


FULL_RANGES = {"calendar_range": ("1995-01-01", "2001-12-31"), "partition_range": ("1995-01-01", "2001-12-31")}


@query(
    f"""WITH {sql.STAGED_SETS_SQL}, {TABS_SQL}, {_CL_IDS}, facts AS (SELECT {_FACT_COLUMNS})
    SELECT row_number() OVER (ORDER BY date_id, CAST(src_id AS BIGINT)) AS id, facts.* FROM facts"""
)
def warehouse_fact(spark, sf_dir):
    """The fact table after the full run over all five tabs."""
    tables = run_tabs(spark, tabs(spark, sf_dir), scratch_path(spark, "warehouse"), BATCH, **FULL_RANGES)
    return plain_fact(tables["fact_workouts"])


_SET_KEY = 'workout_number, "date", set_number, exercise'
_UNCHANGED = ", ".join(
    f"('{layer}', '{name}')"
    for layer, names in {
        "staging": ("exercises", "muscles", "resistance_types", "exercise_muscle"),
        "cleansing": ("cl_exercises", "cl_muscles", "cl_resistance_types", "cl_exercise_muscle"),
        "warehouse": ("ce_exercises", "ce_muscles", "ce_resistance_types", "ce_exercise_muscle", "ce_dates"),
    }.items()
    for name in names
)


def _new_keys(table: str) -> str:
    return f"""(SELECT count(*) FROM (SELECT {_SET_KEY} FROM {table} EXCEPT
      SELECT {_SET_KEY} FROM {table} WHERE earlier))"""


@query(
    f"""WITH {sql.CLEAN_SETS_SQL}
    SELECT layer, table_name, 0 AS inserted, 0 AS updated FROM (VALUES {_UNCHANGED}) AS t(layer, table_name)
    UNION ALL SELECT 'staging', 'workouts', {_new_keys('raw_sets')}, 0
    UNION ALL SELECT 'cleansing', 'cl_workouts', {_new_keys('clean_sets')}, 0
    UNION ALL SELECT 'warehouse', 'fact_workouts', {_new_keys('clean_sets')}, 0"""
)
def warehouse_rerun(spark, sf_dir):
    """What a second run adds, by its audit: only the sets that the first run had not seen."""
    out, every = scratch_path(spark, "warehouse"), tabs(spark, sf_dir)
    every[s.EXERCISE_MUSCLE.name] = stable(every[s.EXERCISE_MUSCLE.name])  # for both runs
    early = raw_sets(spark, sf_dir, earlier=True).withColumnsRenamed({c: h for h, c in s.WORKOUTS.headers.items()})
    run_tabs(spark, {**every, s.WORKOUTS.name: early}, out, EARLIER_BATCH, **FULL_RANGES)
    audit = run_tabs(spark, every, out, BATCH, **FULL_RANGES)["audit"]
    return audit.where(F.col("batch_ts") == moment(BATCH)).select("layer", "table_name", "inserted", "updated")


SHORT_CALENDAR = ("1995-01-01", "1998-12-31")


@query(
    f"""WITH {sql.STAGED_SETS_SQL}, {TABS_SQL}, {_CL_IDS}, facts AS (SELECT {_FACT_COLUMNS}),
    days AS (SELECT count(*) AS n, count(*) FILTER (WHERE date_id <> '1900-01-01'
      AND date_id NOT BETWEEN '{SHORT_CALENDAR[0]}' AND '{SHORT_CALENDAR[1]}') AS lost FROM facts)
    SELECT 'fact_workouts' AS table_name, 'date_id' AS column_name, n AS checked, lost AS broken FROM days
    UNION ALL SELECT 'fact_workouts', 'exercise_id', n, 0 FROM days
    UNION ALL SELECT 'fact_workouts', 'resistance_id', n, 0 FROM days
    UNION ALL SELECT 'ce_exercise_muscle', 'exercise_id', count(*), 0 FROM bridge_tab
    UNION ALL SELECT 'ce_exercise_muscle', 'muscle_id', count(*), 0 FROM bridge_tab"""
)
def warehouse_foreign_keys(spark, sf_dir):
    """Rows checked and found broken per foreign key, after a full run whose calendar ends before the sets do."""
    out = scratch_path(spark, "warehouse")
    tables = run_tabs(spark, tabs(spark, sf_dir), out, BATCH, SHORT_CALENDAR, FULL_RANGES["partition_range"])
    waiting = TableStore(spark, out).read("warehouse", QUARANTINE, s.CL_WORKOUTS)
    rows = {"fact_workouts": [tables["fact_workouts"], waiting], "ce_exercise_muscle": [tables["ce_exercise_muscle"]]}
    named = [df.select(F.lit(name).alias("table_name")) for name, parts_ in rows.items() for df in parts_]
    checked = reduce(DataFrame.unionByName, named).groupBy("table_name").agg(F.count(F.lit(1)).alias("checked"))
    broken = tables["violations"].groupBy("table_name", "rule").agg(F.count(F.lit(1)).alias("broken"))
    keys = [(table, column, foreign_name(column)) for table, column, _, _ in s.FOREIGN_KEYS]
    listed = spark.createDataFrame(keys, "table_name string, column_name string, rule string")
    found = listed.join(checked, "table_name", "left").join(broken, ["table_name", "rule"], "left")
    return found.select("table_name", "column_name", "checked", F.coalesce("broken", F.lit(0).cast("long")).alias("broken"))


@query(
    f"""WITH {sql.STAGED_SETS_SQL}, {TABS_SQL},
    known AS (SELECT DISTINCT {sql.clean('exercise_name')} AS exercise, TRUE AS found FROM exercise_tab
      WHERE TRY_CAST(exercise_id AS BIGINT) % 2 = 0)
    SELECT 'exercise_id' AS key_column, count(*) AS n_rows, count(*) FILTER (WHERE found IS NULL) AS without_key,
      0 AS orphans FROM numbered_sets LEFT JOIN known USING (exercise)
    UNION ALL SELECT 'resistance_id', count(*), count(*) FILTER (WHERE r.resistance_id IS NULL), 0
    FROM numbered_sets LEFT JOIN resistance_tab r USING (resistance_type)"""
)
def warehouse_orphans(spark, sf_dir):
    """The keys of the cleansed sets of a run that knows half of the exercises: no key may lead nowhere."""
    out, every = scratch_path(spark, "warehouse"), tabs(spark, sf_dir)
    every[s.EXERCISES.name] = every[s.EXERCISES.name].where(F.col("ID").cast("long") % 2 == 0)
    run_tabs(spark, every, out, BATCH, layers=["staging", "cleansing"])
    cleansed = Run(spark, TableStore(spark, out), BATCH).cleansed()
    parents = {"cl_exercises": cleansed["exercises"], "cl_resistance_types": cleansed["resistance_types"]}
    rules = s.RULES["cl_workouts"]
    marked = judged(cleansed["workouts"], rules, parents)
    stack = [
        F.struct(
            F.lit(c).alias("key_column"),
            F.col(c).isNull().alias("none"),
            F.array_contains("_failed", foreign_name(c)).alias("orphan"),
        )
        for c, _, _ in rules.foreign
    ]
    return marked.select(F.explode(F.array(*stack)).alias("k")).groupBy("k.key_column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("k.none").alias("without_key"), F.count_if("k.orphan").alias("orphans")
    )
