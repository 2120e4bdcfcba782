"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


# Spark drops the shuffle files of a query at its end, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_step = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lithic-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stable(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as written to a table in the shared folder, which cuts their lineage."""
    path = scratch_path(df.sparkSession, "stable")
    if getattr(_step, "tables", None) is not None:
        _step.tables.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what ``stable`` writes in this thread within the block at its end; nothing may read it any more then."""
    outer, _step.tables = getattr(_step, "tables", None), []
    try:
        yield
    finally:
        paths, _step.tables = _step.tables, outer
        for path in paths:
            delete(spark, path)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let queries that run within the block drop their shuffle files at their end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def observed(df: DataFrame, counts: Mapping[str, Column] | None) -> tuple[Observation | None, DataFrame]:
    """``df`` with ``counts`` taken in the stage that writes it, where a retried task counts once."""
    if not counts:
        return None, df
    seen = Observation()
    return seen, df.observe(seen, *(c.alias(n) for n, c in counts.items()))


def values_of(seen: Observation | None) -> dict[str, int]:
    return {n: v or 0 for n, v in seen.get.items()} if seen else {}


def stable_with(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """``stable``, and ``counts`` taken while it is written."""
    seen, df = observed(df, counts)
    return stable(df), values_of(seen)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, text: str, aside: str, path: str) -> bool:
    """Write a small file ``aside`` and rename it to ``path``; False, and nothing written, if that is there already."""
    fs, aside_path = _file_system(spark, aside)
    stream = fs.create(aside_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    to = hadoop.Path(path)
    context = hadoop.FileContext.getFileContext(fs.makeQualified(to).toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(aside_path), fs.makeQualified(to), options)
        return True
    except Exception:
        fs.delete(aside_path, False)
        if fs.exists(to):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)
