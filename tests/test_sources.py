from __future__ import annotations

import pytest
from conftest import table
from pyspark.sql import functions as F

from lithic.plans.schemas import TEXT, table as schema_of
from lithic.sources.tables import TableStore
from lithic.sources.tabs import read_records, read_tab

CSV = 'ID,Muscle name,Muscle groups\n1,"Chest, ""upper""\npart",\n2, Back ,Torso\n'
SCHEMA = schema_of(k=TEXT)


def test_csv_tab(spark, tmp_path):
    (tmp_path / "Muscles.csv").write_text(CSV)
    df = read_tab(spark, str(tmp_path), "Muscles")
    assert df.columns == ["ID", "Muscle name", "Muscle groups"]
    assert table(df) == [("1", 'Chest, "upper"\npart', ""), ("2", " Back ", "Torso")]


def test_json_and_parquet_tabs(spark, tmp_path):
    (tmp_path / "A.json").write_text('{"ID": 1, "Name": "x"}\n')
    assert table(read_tab(spark, str(tmp_path), "A"), "ID", "Name") == [("1", "x")]
    spark.range(2).write.parquet(str(tmp_path / "B.parquet"))
    assert read_tab(spark, str(tmp_path), "B").count() == 2
    with pytest.raises(FileNotFoundError):
        read_tab(spark, str(tmp_path), "C")


def test_published_version_replaces_the_table_it_was_read_from(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.read("l", "t", SCHEMA).count() == 0
    first, counts = store.publish(rows("k", ("a",), ("b",)), "l", "t", SCHEMA, {"n": F.count(F.lit(1))})
    assert counts == {"n": 2}
    store.publish(first.unionByName(rows("k", ("c",))), "l", "t", SCHEMA)
    assert table(store.read("l", "t", SCHEMA)) == [("a",), ("b",), ("c",)]


def test_a_version_without_commit_does_not_count(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.publish(rows("k", ("a",)), "l", "t", SCHEMA)
    store.publish(rows("k", ("b",)), "l", "t", SCHEMA)
    (tmp_path / "l" / "t" / "v=00000002" / "_SUCCESS").unlink()
    assert table(store.read("l", "t", SCHEMA)) == [("a",)]
    store.publish(rows("k", ("c",)), "l", "t", SCHEMA)
    assert table(store.read("l", "t", SCHEMA)) == [("c",)]


def test_batches(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.read_batches("l", "t", SCHEMA, 0).count() == 0
    store.write_batch(rows("k", ("a",)), "l", "t", "1", SCHEMA)
    store.write_batch(rows("k", ("left over",)), "l", "t", "2", SCHEMA)
    assert table(store.read_batches("l", "t", SCHEMA, 1)) == [("a",)]
    store.write_batch(rows("k", ("b",)), "l", "t", "2", SCHEMA)
    assert table(store.read_batches("l", "t", SCHEMA, 2)) == [("a",), ("b",)]


def test_append(spark, rows, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.append(rows("k", ("a",)), "l", "t", {"inserted": F.count(F.lit(1))}) == {"inserted": 1}
    store.append(rows("k", ("b",)), "l", "t")
    assert table(store.read_appended("l", "t", SCHEMA)) == [("a",), ("b",)]


def test_ragged_and_unreadable_records_are_kept_with_their_place(spark, tmp_path):
    lines = ["ID,Muscle name,Muscle groups", "1,Chest,Torso", "2,short", '3,"a, ""b""",', "4,too,many,cells", "", '5,"open']
    (tmp_path / "Muscles.csv").write_text("\n".join(lines) + "\n")
    rows, lost = read_records(spark, str(tmp_path), "Muscles")
    assert table(rows) == [("1", "Chest", "Torso"), ("3", 'a, "b"', "")]
    assert sorted(r.record for r in lost.collect()) == ["2,short", "4,too,many,cells", '5,"open']
    assert {(r.tab, r.file.endswith("/Muscles.csv"), r.block) for r in lost.collect()} == {("Muscles", True, 0)}
    assert table(rows.select("ID")) == [("1",), ("3",)] and lost.count() == 3  # whatever columns are wanted
    (tmp_path / "A.json").write_text('{"ID": 1, "Name": "x", "more": [1]}\n{"ID": 2\nnothing\n{"Name": "y"}\n')
    rows, lost = read_records(spark, str(tmp_path), "A", headers=("ID", "Name"))
    assert table(rows) == [("1", "x"), (None, "y")]
    assert sorted(r.record for r in lost.collect()) == ["nothing", '{"ID": 2']
    spark.range(2).write.parquet(str(tmp_path / "B.parquet"))
    rows, lost = read_records(spark, str(tmp_path), "B")
    assert rows.count() == 2 and lost.count() == 0


def test_line_breaks_need_multi_line_and_one_task(spark, tmp_path):
    (tmp_path / "Muscles.csv").write_text(CSV)
    assert table(read_records(spark, str(tmp_path), "Muscles", multi_line=True)[0]) == [("1", 'Chest, "upper"\npart', ""), ("2", " Back ", "Torso")]
    assert read_records(spark, str(tmp_path), "Muscles")[1].count() == 2
    (tmp_path / "Big.csv").write_text("ID,Name\n" + "".join(f"{k},name {k}\n" for k in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert read_tab(spark, str(tmp_path), "Big", multi_line=False).rdd.getNumPartitions() > 3
        rows, lost = read_records(spark, str(tmp_path), "Big")
        assert rows.count() == 20000 and lost.count() == 0
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")
