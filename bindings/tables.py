"""Workout tabs and layer tables derived from the driver's tables, in Spark and as SQL.

Earlier contents of a table are what an earlier business date would have held: sets shipped before
``CUTOFF`` and parts up to size ``EARLIER_SIZE``. The later load always covers the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithic.functions.text import clean_text
from lithic.operators.calendar import days_between, with_parts
from lithic.operators.dedup import drop_duplicates
from lithic.operators.fact import typed_columns
from lithic.operators.joins import lookup_join
from lithic.plans import schemas as s
from lithic.plans.cleansing import WORKOUT_KEY, clean_workout_rows

BATCH = "2025-08-03 06:00:00"
EARLIER_BATCH = "2025-01-01 00:00:00"
CUTOFF = "1999-01-01"
EARLIER_SIZE = 25


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def time_text(name: str) -> Column:
    """A timestamp as text, which both engines print alike."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def sets_of(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Raw workout rows of line items: three date formats, untidy names, loads with and without unit.

    What depends on the part alone is spelled out on the side of the part, before the join.
    """
    name, kind = F.col("p_name"), F.col("p_partkey") % 4
    brand = F.replace("p_brand", F.lit("#"), F.lit(" "))
    spelled = part.select(
        "p_partkey",
        F.array(
            F.concat(F.lit("  "), name, F.lit(" ")),
            F.upper(name),
            F.replace(name, F.lit(" "), F.lit("   ")),
            F.concat(name, F.lit("!")),
            name,
        ).alias("names"),
        F.array(F.lower(brand), brand).alias("brands"),
        F.when(kind == 0, ",5 kg").when(kind == 1, " LBS").when(kind == 3, "").alias("suffix"),
    )
    rows = lookup_join(lineitem.withColumnRenamed("l_partkey", "p_partkey"), spelled, ["p_partkey"], "inner")
    line, supplier, amount = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_quantity").cast("long")
    day = F.col("l_shipdate").cast("date")
    return rows.select(
        text("l_orderkey").alias("workout_number"),
        F.when(line % 3 == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(line % 3 == 1, F.replace(text(day), F.lit("-"), F.lit(".")))
        .otherwise(text(day))
        .alias("date"),
        text(line).alias("set_number"),
        F.get("names", (supplier % 5).cast("int")).alias("exercise"),
        F.when(amount >= 48, "").otherwise(text(amount)).alias("reps"),
        F.when(amount == 1, "bodyweight").otherwise(
            F.coalesce(F.concat(text(amount + 20), "suffix"), F.lit(""))
        ).alias("load"),
        F.get("brands", (supplier % 2).cast("int")).alias("resistance_type"),
        F.col("l_returnflag").alias("set_type"),
        F.when(F.col("l_tax") == 0, "  ").otherwise(" ok ").alias("comments"),
        F.when(line == 7, "N/A").otherwise(F.concat("l_linestatus", F.lit("*"))).alias("workout_type"),
    )


SETS_SQL = """
raw_sets AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS workout_number,
    CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%m/%d/%Y')
      WHEN 1 THEN strftime(l_shipdate, '%Y.%m.%d') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS "date",
    CAST(l_linenumber AS VARCHAR) AS set_number,
    CASE l_suppkey % 5 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN upper(p_name)
      WHEN 2 THEN replace(p_name, ' ', '   ') WHEN 3 THEN p_name || '!' ELSE p_name END AS exercise,
    CASE WHEN l_quantity >= 48 THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS reps,
    CASE WHEN l_quantity = 1 THEN 'bodyweight'
      WHEN p_partkey % 4 = 0 THEN CAST(CAST(l_quantity AS BIGINT) + 20 AS VARCHAR) || ',5 kg'
      WHEN p_partkey % 4 = 1 THEN CAST(CAST(l_quantity AS BIGINT) + 20 AS VARCHAR) || ' LBS'
      WHEN p_partkey % 4 = 2 THEN ''
      ELSE CAST(CAST(l_quantity AS BIGINT) + 20 AS VARCHAR) END AS load,
    CASE WHEN l_suppkey % 2 = 0 THEN lower(replace(p_brand, '#', ' ')) ELSE replace(p_brand, '#', ' ') END
      AS resistance_type,
    l_returnflag AS set_type,
    CASE WHEN l_tax = 0 THEN '  ' ELSE ' ok ' END AS comments,
    CASE WHEN l_linenumber = 7 THEN 'N/A' ELSE l_linestatus || '*' END AS workout_type,
    l_shipdate < TIMESTAMP '1999-01-01 00:00:00' AS earlier
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def raw_sets(spark: SparkSession, sf_dir: str, earlier: bool = False) -> DataFrame:
    lineitem = read(spark, sf_dir, "lineitem")
    if earlier:
        lineitem = lineitem.where(F.col("l_shipdate") < F.lit(CUTOFF).cast("date"))
    return sets_of(lineitem, read(spark, sf_dir, "part"))


def exercise_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exercise per part name, with its lowest part key as id."""
    return (
        read(spark, sf_dir, "part")
        .groupBy("p_name")
        .agg(
            text(F.min("p_partkey")).alias("exercise_id"),
            F.min_by("p_type", "p_partkey").alias("exercise_movement_type"),
            F.min_by("p_brand", "p_partkey").alias("exercise_bodysplit"),
        )
        .select("exercise_id", F.col("p_name").alias("exercise_name"), "exercise_movement_type", "exercise_bodysplit")
    )


def muscle_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return lookup_join(
        nation.withColumnRenamed("n_regionkey", "r_regionkey"), region, ["r_regionkey"], "inner"
    ).select(
        text("n_nationkey").alias("muscle_id"), F.col("n_name").alias("muscle_name"), F.col("r_name").alias("muscle_group")
    )


def resistance_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(F.min_by("p_type", "p_partkey").alias("resistance_category"))
        .select(
            F.replace("p_brand", F.lit("Brand#"), F.lit("R")).alias("resistance_id"),
            F.replace("p_brand", F.lit("#"), F.lit(" ")).alias("resistance_type"),
            "resistance_category",
        )
    )


def trained_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as (exercise id, exercise name, muscle id, muscle name, ship date, return flag)."""
    lineitem, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    names = exercise_tab(spark, sf_dir).select(F.col("exercise_name").alias("p_name"), "exercise_id")
    named = lookup_join(part.select("p_partkey", "p_name"), names, ["p_name"], "inner")
    suppliers = lookup_join(
        read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")),
        read(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
        ["n_nationkey"],
        "inner",
    )
    rows = lineitem.select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"), "l_shipdate", "l_returnflag"
    )
    rows = lookup_join(lookup_join(rows, named, ["p_partkey"], "inner"), suppliers, ["s_suppkey"], "inner")
    return rows.select(
        "exercise_id",
        F.col("p_name").alias("exercise_name"),
        text("n_nationkey").alias("muscle_id"),
        F.col("n_name").alias("muscle_name"),
        "l_shipdate",
        "l_returnflag",
    )


def bridge_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per exercise and muscle; 'primary' when no line item of the pair was returned."""
    keys = ["exercise_id", "exercise_name", "muscle_id", "muscle_name"]
    returned = F.max((F.col("l_returnflag") == "R").cast("int"))
    return trained_pairs(spark, sf_dir).groupBy(*keys).agg(
        F.when(returned == 1, " secondary ").otherwise("primary").alias("muscle_role")
    )


TABS_SQL = """
exercise_tab AS (
  SELECT CAST(min(p_partkey) AS VARCHAR) AS exercise_id, p_name AS exercise_name,
    arg_min(p_type, p_partkey) AS exercise_movement_type, arg_min(p_brand, p_partkey) AS exercise_bodysplit
  FROM part GROUP BY p_name),
muscle_tab AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS muscle_id, n_name AS muscle_name, r_name AS muscle_group
  FROM nation JOIN region ON n_regionkey = r_regionkey),
resistance_tab AS (
  SELECT replace(p_brand, 'Brand#', 'R') AS resistance_id, replace(p_brand, '#', ' ') AS resistance_type,
    arg_min(p_type, p_partkey) AS resistance_category
  FROM part GROUP BY p_brand),
trained_pairs AS (
  SELECT e.exercise_id, e.exercise_name, CAST(s_nationkey AS VARCHAR) AS muscle_id, n_name AS muscle_name,
    l_shipdate, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN exercise_tab e ON p_name = e.exercise_name
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
bridge_tab AS (
  SELECT exercise_id, exercise_name, muscle_id, muscle_name,
    CASE WHEN max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN ' secondary ' ELSE 'primary' END
      AS muscle_role
  FROM trained_pairs GROUP BY ALL)"""


def tabs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tabs under their sheet headers."""
    content = [
        (s.EXERCISES, exercise_tab),
        (s.MUSCLES, muscle_tab),
        (s.RESISTANCE_TYPES, resistance_tab),
        (s.EXERCISE_MUSCLE, bridge_tab),
        (s.WORKOUTS, raw_sets),
    ]
    return {
        tab.name: build(spark, sf_dir).withColumnsRenamed({c: h for h, c in tab.headers.items()})
        for tab, build in content
    }


SET_VALUES = ("reps", "load", "unit", "resistance_type", "set_type", "comments", "workout_type")


def unique_sets(spark: SparkSession, sf_dir: str, earlier: bool = False) -> DataFrame:
    """Cleaned sets, one per key."""
    cleaned = clean_workout_rows(raw_sets(spark, sf_dir, earlier)).select(*WORKOUT_KEY, *SET_VALUES)
    return drop_duplicates(cleaned, WORKOUT_KEY, SET_VALUES, required=())


def exercise_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exercise_tab(spark, sf_dir).select(
        F.col("exercise_id").cast("long").alias("exercise_id"), clean_text("exercise_name").alias("exercise_name")
    )


def resistance_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resistance_tab(spark, sf_dir).select(
        F.replace("resistance_id", F.lit("R"), F.lit("")).cast("long").alias("resistance_id"),
        "resistance_type",
        "resistance_category",
    )


def typed_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned sets with dimension keys and typed measures, without ids of their own."""
    keyed = unique_sets(spark, sf_dir)
    names = exercise_dimension(spark, sf_dir).withColumnRenamed("exercise_name", "exercise")
    kinds = resistance_dimension(spark, sf_dir).drop("resistance_category")
    keyed = lookup_join(lookup_join(keyed, names, ["exercise"]), kinds, ["resistance_type"])
    keys = [F.coalesce(k, F.lit(-1).cast("long")).alias(k) for k in ("exercise_id", "resistance_id")]
    return keyed.select(*(c.alias(n) for n, c in typed_columns().items()), *keys)


def ship_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over all ship dates, with its missing-date member."""
    span = read(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi")
    )
    return with_parts(days_between(span, "lo", "hi"))
