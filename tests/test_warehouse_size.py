"""What a full run moves and leaves behind: keys by their hashes, parts that a load has taken in, passing files."""

from __future__ import annotations

import fixtures
import pytest
from conftest import table
from pyspark.sql import functions as F

from lithic.operators import fact
from lithic.operators.dedup import first_per_key, first_per_key_of_table
from lithic.operators.joins import anti_join, anti_join_few
from lithic.operators.merge import new_rows, new_rows_of_tables
from lithic.plans import cleansing
from lithic.plans.run import run_tabs
from lithic.plans.staging import stage_new_rows
from lithic.plans import schemas as s
from lithic.sources.shared import SHUFFLE_CLEANUP, child_names, passing_tables, shared_folder, stable
from lithic.sources.tables import TableStore

FIRST, SECOND, THIRD = "2025-08-03 06:00:00", "2025-08-04 06:00:00", "2025-08-05 06:00:00"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sets(rows):
    """Keys of one row, of several, and with NULL in several places."""
    return rows(
        "a string, b string, n long, flag boolean",
        ("1", "x", 3, True), ("1", "x", 2, False), ("1", "y", 1, True), (None, "x", 5, None), (None, "x", 4, True),
        ("x", None, 6, False), (None, None, 7, True), ("2", "z", 8, None), ("2", "", 9, False), ("", "2", 10, False),
    )


def test_first_rows_found_by_hashes_are_the_same(sets):
    options = {"count": "_copies", "sums": {"_flags": F.col("flag")}, "columns": ["b", "a", "n"]}
    want = table(first_per_key(sets, ["a", "b"], ["n"], **options))
    assert len(want) == 8 and sum(r[3] for r in want) == 10
    for max_bytes in (0, 10**6):
        assert table(first_per_key_of_table(sets, ["a", "b"], ["n"], **options, max_bytes=max_bytes)) == want
    numbers = sets.selectExpr("cast(if(n % 2 = 0, 0.0, -0.0) as double) as a", "n")
    assert first_per_key_of_table(numbers, ["a"], ["n"]).count() == 1


def test_large_anti_joins_by_hashes_are_the_same(spark):
    left = spark.range(3000).selectExpr("cast(nullif(id, 7) as string) as a", "if(id % 2 = 0, 'x', null) as b", "id")
    right = spark.range(2990, 4000).selectExpr("cast(id as string) as a", "if(id % 2 = 0, 'x', null) as b")
    right = right.unionByName(spark.sql("select cast(null as string) as a, cast(null as string) as b")).unionByName(right)
    for null_safe, rows in ((False, 2995), (True, 2989)):
        want = table(anti_join(left, right, ["a", "b"], null_safe))
        found = anti_join_few(left, right, ["a", "b"], null_safe, max_bytes=2000)
        assert table(found) == want and len(want) == rows
        # Whole rows are not shuffled; only the rows that meet a hash are joined.
        assert "SortMergeJoin" not in plan_of(found) and "hashpartitioning(a" not in plan_of(found)


def test_new_rows_of_written_tables_are_the_same(rows, sets):
    old = rows("a string, b string, n long, flag boolean", ("1", "x", 0, None), (None, "x", 0, None), ("7", "7", 0, None))
    want = table(new_rows(old, sets, ["a", "b"], ["n"]))
    assert table(new_rows_of_tables(old, sets, ["a", "b"], ["n"])) == want and len(want) == 6
    assert table(new_rows_of_tables(None, sets, ["a", "b"], ["n"])) == table(first_per_key(sets, ["a", "b"], ["n"]))


def test_sets_with_keys_of_their_own_are_staged_without_a_sort(spark):
    new = stage_new_rows(None, fixtures.tabs(spark)["Workouts"], s.WORKOUTS, FIRST)
    assert new.count() == 7
    # One branch passes rows on as they are, the other sorts those whose keys are repeated.
    assert "LeftAnti" in plan_of(new) and "LeftSemi" in plan_of(new)


def test_a_run_leaves_no_passing_tables_and_no_shuffle_files(spark, tmp_path):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    tabs = {name: stable(tab) for name, tab in fixtures.tabs(spark).items()}
    before, held = set(child_names(spark, shared_folder(spark))), files()
    tables = run_tabs(spark, tabs, str(tmp_path / "out"), FIRST)
    assert set(child_names(spark, shared_folder(spark))) == before
    assert files() <= held
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
    assert tables["fact_workouts"].count() == 6


def test_passing_tables_are_those_of_the_block(spark):
    kept = stable(spark.range(3))
    with pytest.raises(RuntimeError, match="killed"), passing_tables(spark):
        outer = stable(spark.range(4))
        with passing_tables(spark):
            inner = stable(spark.range(5))
        assert outer.count() == 4
        with pytest.raises(Exception):
            spark.read.parquet(*inner.inputFiles())
        raise RuntimeError("killed")
    assert kept.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(*outer.inputFiles())


def test_a_load_reads_no_part_that_an_earlier_one_has_taken_in(spark, tmp_path, monkeypatch):
    seen = []
    load_workouts, load_fact = cleansing.load_workouts, fact.load_fact

    def workouts(linked, pending, staged, *rest):
        seen.append(staged.count())
        return load_workouts(linked, pending, staged, *rest)

    def facts(src, *rest, **options):
        seen.append(src.count())
        return load_fact(src, *rest, **options)

    monkeypatch.setattr(cleansing, "load_workouts", workouts)
    monkeypatch.setattr(fact, "load_fact", facts)
    tabs, out = fixtures.tabs(spark), str(tmp_path / "out")
    run_tabs(spark, tabs, out, FIRST)
    run_tabs(spark, tabs, out, SECOND)
    new = ("9", "2025-08-01", "1", "Squat", "2", "100", "Band", "", "", "", 99)
    tabs["Workouts"] = tabs["Workouts"].unionByName(spark.createDataFrame([new], tabs["Workouts"].schema))
    for _ in range(2):  # the second time as a batch that is repeated
        last = run_tabs(spark, tabs, out, THIRD)
    # Seven sets, six of them different and two of these pending; nothing; the new one; nothing again.
    assert seen[:4] == [7, 6, 0, 2] and seen[4] == 1 and seen[6] == 0
    assert last["fact_workouts"].count() == 7
    store = TableStore(spark, out)
    assert store.covered("cleansing", "cl_workouts_pending") == 4 and store.covered("warehouse", "fact_workouts") == 4
