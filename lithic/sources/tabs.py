"""Exported spreadsheet tabs as text tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithic.sources.shared import path_exists, stable

FORMATS = ("parquet", "csv", "json")
CORRUPT, FILE, BLOCK = "_corrupt_record", "_file", "_block"
REJECTED = T.StructType(
    [T.StructField(n, T.LongType() if n == "block" else T.StringType()) for n in ("tab", "file", "block", "record")]
)


def read_tab(
    spark: SparkSession,
    path: str,
    name: str,
    file_format: str | None = None,
    multi_line: bool = True,
    headers: Sequence[str] = (),
) -> DataFrame:
    """The records of one tab, by header name, from ``<path>/<name>.<format>`` (a file or a folder).

    Blank CSV cells are empty text, as in the sheet, not NULL. ``multi_line`` allows line breaks
    inside quoted CSV cells; without it large CSV files can be split. With ``headers`` JSON records
    are read as text of these names, without a pass to find out what they hold.
    """
    found, location = _located(spark, path, name, file_format)
    if found == "csv":
        return _csv(spark, multi_line).csv(location).fillna("")
    if found == "json":
        reader = spark.read.option("primitivesAsString", True)
        return (reader.schema(_texts(headers)) if headers else reader).json(location)
    return spark.read.parquet(location)


def read_records(
    spark: SparkSession,
    path: str,
    name: str,
    file_format: str | None = None,
    multi_line: bool = False,
    headers: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The records of a tab as ``read_tab`` gives them, and what could not be read as a record.

    A CSV record with too few or too many cells, or a line that is no JSON, is a row (tab, file, block, record) of the
    second table: the file, the place of the block it was read from, and the text as it stands. A file is read once and
    kept as a table, from which both come. Line breaks inside cells need ``multi_line``, which reads a file in one task;
    without it they show up among the rejects. ``headers`` are the names that JSON records may have.
    """
    found, location = _located(spark, path, name, file_format)
    if found == "parquet":
        rows = spark.read.parquet(location)
        return rows, spark.createDataFrame([], REJECTED)
    if found == "csv":
        names = _csv(spark, multi_line).csv(location).columns  # from the first line alone
        # A parser that skips columns would not see that cells are missing.
        reader = _csv(spark, multi_line).option("columnPruning", False)
    else:
        reader = spark.read.option("primitivesAsString", True).option("multiLine", multi_line)
        names = list(headers) or reader.json(location).columns
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    raw = raw.schema(_texts([*names, CORRUPT])).format(found).load(location)
    parsed = stable(raw.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)))
    good = F.col(CORRUPT).isNull()
    rows = parsed.where(good).select(*(F.col(f"`{n}`") for n in names))
    rejected = parsed.where(~good).select(
        F.lit(name).alias("tab"), F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), F.col(CORRUPT).alias("record")
    )
    return (rows.fillna("") if found == "csv" else rows), rejected


def _located(spark: SparkSession, path: str, name: str, file_format: str | None) -> tuple[str, str]:
    found = file_format or next((f for f in FORMATS if path_exists(spark, f"{path}/{name}.{f}")), None)
    if found is None:
        raise FileNotFoundError(f"no {name} tab in {path}")
    return found, f"{path}/{name}.{found}"


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
