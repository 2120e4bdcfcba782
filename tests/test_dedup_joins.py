from __future__ import annotations

from conftest import table
from pyspark.sql import functions as F

from lithic.functions.text import normalized
from lithic.operators.dedup import drop_duplicates, duplicate_report, first_per_key, numeric_order
from lithic.operators.joins import (
    anti_join, anti_join_few, fill_key, has_hot_keys, hot_keys, lookup_join, match_parents, measured_bytes, orphans, sized,
)
from lithic.operators.keys import assign_keys
from lithic.operators.merge import new_rows
from lithic.sources.shared import stable


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_lowest_id_is_numeric(rows):
    df = rows("id,k", ("10", "a"), ("9", "a"), ("2", "b"))
    assert table(drop_duplicates(df, ["k"], numeric_order("id"))) == [("2", "b"), ("9", "a")]


def test_null_keys_pass_through(rows):
    df = rows("id,k", ("1", None), ("1", None), ("3", "a"), ("4", "a"))
    assert table(drop_duplicates(df, ["k"], numeric_order("id"))) == [("1", None), ("1", None), ("3", "a")]
    kept = drop_duplicates(df, ["k"], numeric_order("id"), count="n", sums={"big": F.col("id") > 2})
    assert table(kept) == [("1", None, 1, 0), ("1", None, 1, 0), ("3", "a", 2, 2)]


def test_both_forms_keep_the_same_row_and_ignore_input_order(spark):
    data = [(i % 7, i * 37 % 11, f"v{i}") for i in range(200)]
    a, b = spark.createDataFrame(data, "k int, o int, v string"), spark.createDataFrame(data[::-1], "k int, o int, v string")
    expected = sorted(min((r for r in data if r[0] == k), key=lambda r: (r[1], r)) for k in range(7))
    for df in (a, b.repartition(5)):
        assert table(first_per_key(df, ["k"], ["o"])) == sorted(expected, key=repr)
        assert table(first_per_key(df, ["k"], ["o"], count="n").drop("n")) == sorted(expected, key=repr)


def test_rows_that_differ_in_one_attribute_all_stay(rows):
    df = rows("id,src,name,body", ("1", "5", "Squat", "Upper"), ("2", "5", "Squat", "Lower"))
    assert drop_duplicates(df, ["src", "name", "body"], numeric_order("id")).count() == 2


def test_normalised_key(rows):
    df = rows("id,src,name", ("2", "1", " chest"), ("1", "1", "CHEST"), ("3", "1", None), ("4", "1", "N/A"))
    key = {"src": F.col("src"), "name": normalized("name")}
    assert table(drop_duplicates(df, key, numeric_order("id"), required=["src"]), "id") == [("1",), ("3",), ("4",)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    text = plan(first_per_key(df, ["k"], ["id"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    assert "partial_min" in plan(first_per_key(df, ["k"], ["id"], count="n"))


def test_duplicate_report(rows):
    df = rows("id,k", ("3", "a"), ("1", "a"), ("2", "b"), ("7", None), ("8", None))
    report = duplicate_report(df, ["k"], F.col("id").cast("int"))
    assert table(report) == [("a", 1, 2), (None, 7, 2)]


def test_lookup_join_is_the_same_broadcast_or_salted(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 5).alias("k"), "id")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "k long, name string")
    for how in ("left", "inner"):
        small, salted = lookup_join(left, dim, ["k"], how), lookup_join(left, dim, ["k"], how, max_bytes=0, salts=4)
        assert "BroadcastHashJoin" in plan(small)
        assert "_salt" in plan(salted)
        assert table(small) == table(salted.select(*small.columns))


def test_measured_bytes_counts_values(rows):
    assert measured_bytes(rows("a,b", ("xxxx", None), ("y", "zz"))) == 4 * 16 + 7
    assert measured_bytes(rows("a,b")) == 0


def test_anti_join_null_keys(rows):
    left, right = rows("k,v", (None, "1"), ("a", "2"), ("b", "3")), rows("k", (None,), ("a",))
    assert table(anti_join(left, right, ["k"])) == [("b", "3"), (None, "1")]
    assert table(anti_join(left, right, ["k"], null_safe=True)) == [("b", "3")]


def test_anti_join_few_is_the_same_broadcast_or_not(spark):
    left = spark.range(50).select((F.col("id") % 20).alias("a"), F.when(F.col("id") > 4, F.col("id") % 3).alias("b"))
    right = spark.range(1000).select((F.col("id") % 11).alias("a"), F.when(F.col("id") > 9, F.lit(1)).alias("b"))
    for null_safe in (False, True):
        expected = table(anti_join(left, right, ["a", "b"], null_safe))
        few = anti_join_few(left, right, ["a", "b"], null_safe)
        assert "BroadcastHashJoin" in plan(few) and "LeftSemi" in plan(few)
        assert table(few) == expected
        assert table(anti_join_few(left, right, ["a", "b"], null_safe, max_bytes=0)) == expected


def test_fill_key(rows):
    sets = rows("name,id", ("Squat", None), ("Squat", "-1"), ("Squat", "77"), ("Ghost", None), (None, "-1"))
    names = rows("n,id", ("Squat", "10"), ("Squat", "9"), (None, "1"))
    assert table(fill_key(sets, names, "name", "n", "id")) == sorted(
        [("Squat", "9"), ("Squat", "9"), ("Squat", "77"), ("Ghost", None), (None, "-1")], key=repr
    )


def test_match_parents_drops_orphans(rows):
    bridge = rows("e,m", ("1", "1"), ("1", "9"), ("9", "1"))
    exercises, muscles = rows("src,id", ("1", "11")), rows("src,id", ("1", "21"))
    parents = [(exercises, "e", {"src": "e", "id": "eid"}), (muscles, "m", {"src": "m", "id": "mid"})]
    assert table(match_parents(bridge, parents), "e", "m", "eid", "mid") == [("1", "1", "11", "21")]


def test_orphans_leave_out_null_keys(rows):
    assert table(orphans(rows("k", ("1",), ("2",), (None,)), "k", rows("id", ("1",)), "id")) == [("2",)]


def test_a_lookup_of_long_arrays_is_not_broadcast(spark):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    lookup = spark.range(1, 3).selectExpr("id as k", "array_repeat('some words', 1000) as words")
    assert measured_bytes(lookup) > 20000
    joined = lookup_join(left, lookup, ["k"], max_bytes=10000)
    assert "BroadcastHashJoin [k" not in joined._jdf.queryExecution().sparkPlan().toString().split("words")[0]
    assert table(joined.selectExpr("k", "size(words)")) == [(1, 1000), (2, 1000)]


def test_hot_keys_are_spread_by_their_share(spark):
    left = spark.range(900).selectExpr("if(id < 600, 7, if(id < 700, null, id)) as k", "id")
    hot = {r["_hot0"]: r["_salts"] for r in hot_keys(left, ["k"]).collect()}
    assert hot == {7: 6, None: 1} or hot == {7: 6}
    lookup = spark.createDataFrame([(7, "a"), (701, "b")], "k long, v string")
    for how, n in (("left", 900), ("inner", 601), ("left_semi", 601), ("left_anti", 299)):
        assert lookup_join(left, lookup, ["k"], how, max_bytes=0).count() == n


def test_orphans_of_a_hot_key(spark):
    df = spark.range(50).selectExpr("if(id < 40, 5, id) as k", "id")
    parent = spark.createDataFrame([(41,), (42,)], "p long")
    assert orphans(df, "k", parent, "p").count() == 48


def test_rows_with_a_null_key_are_read_once_with_the_others(spark, tmp_path):
    rows = [(None, k, "x") for k in range(50)] + [(k % 3, k, "y") for k in range(60)]
    spark.createDataFrame(rows, "k long, id long, a string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for options in ({}, {"count": "n"}):
        kept = drop_duplicates(df, ["k"], ["id"], **options)
        assert plan(kept).count("FileScan") == 1
        got = table(kept.select("k", "id"))
        assert got == sorted([(None, k) for k in range(50)] + [(0, 0), (1, 1), (2, 2)], key=repr)


def test_the_size_of_a_derived_side_is_taken_while_it_is_written(spark, tmp_path):
    spark.range(100).selectExpr("id as k", "cast(id as string) as name").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plain, small = sized(stored.where("k > 3"))
    assert small and plain.count() == 96 and "FileScan" in plan(plain) and str(tmp_path) in plan(plain)
    derived = stored.groupBy("k").agg(F.min("name").alias("name"))
    written, small = sized(derived)
    assert small and "Aggregate" not in plan(written) and table(written) == table(derived)
    assert not sized(derived, 10)[1] and not sized(stored, 10)[1] and not sized(spark.range(99), 10)[1]


def test_new_rows_are_the_first_of_keys_that_the_target_lacks(spark, rows):
    old = rows("k,a", ("1", "x"), (None, "z"))
    src = rows("k,a,n", ("1", "y", "1"), ("2", "b", "3"), ("2", "a", "2"), (None, "q", "1"), ("3", None, None), ("3", None, None))
    fresh = new_rows(old, src, ["k"], ["n"])
    assert table(fresh) == [("2", "a", "2"), ("3", None, None)] and fresh.columns == ["k", "a", "n"]
    assert table(new_rows(old, src, ["k", "a"], ["n"]), "k", "a") == sorted(
        [("1", "y"), ("2", "b"), ("2", "a"), (None, "q"), ("3", None)], key=repr
    )


def test_keys_and_order_given_by_name_are_not_copied(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "cast(id as string) as o", "id as v")
    for options in ({}, {"count": "n"}):
        text = plan(first_per_key(df, ["k"], ["o"], **options))
        assert "_key0" not in text and "hashpartitioning(k#" in text
        assert table(first_per_key(df, ["k"], ["o"], **options), "k", "o") == [
            (k, min(str(v) for v in range(k, 100, 7))) for k in range(7)
        ]
    assert "_order0" not in plan(first_per_key(df, ["k"], ["o"]))
    assert "_left0" not in plan(anti_join(df, df.where("v < 9"), ["k"]))


def test_first_per_key_of_keys_alone_and_of_signed_zeros(spark):
    keys = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k long, t string")
    for options in ({}, {"count": "n"}):
        assert table(first_per_key(keys, ["k", "t"], ["t"], **options), "k", "t") == [(1, None), (2, "a")]
        assert table(first_per_key(keys, ["k", "t"], [], **options), "k", "t") == [(1, None), (2, "a")]
        zeros = spark.createDataFrame([(-0.0, 1), (0.0, 2)], "k double, v long")
        assert [str(r["k"]) for r in first_per_key(zeros, ["k"], ["v"], **options).collect()] == ["-0.0"]


def test_a_large_lookup_is_salted_only_if_there_are_hot_keys(spark):
    even = spark.range(4000).selectExpr("id % 1000 as k", "id")
    hot = spark.range(4000).selectExpr("if(id < 3000, 7, id) as k", "id")
    lookup = spark.range(1000).selectExpr("id as k", "cast(id as string) as name")
    assert not has_hot_keys(even, ["k"]) and has_hot_keys(hot, ["k"])
    assert has_hot_keys(even.selectExpr("if(id < 3000, null, k) as k"), ["k"])
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain, salted = (lookup_join(df, lookup, ["k"], how, max_bytes=0) for df in (even, hot))
        assert "_salt" not in plan(plain) and "_salt" in plan(salted)
        assert "ShuffledHashJoin" in plan(plain) and "BroadcastHashJoin" not in plan(plain)
        for df, joined in ((even, plain), (hot, salted)):
            assert table(joined) == table(df.join(lookup, "k", how).select(*joined.columns))


def test_keys_far_beyond_a_broadcast_are_not_collected_first(spark, monkeypatch):
    left = spark.range(2000).selectExpr("cast(id as string) as k", "id")
    right = spark.range(0, 2000, 3).selectExpr("cast(id as string) as k")
    monkeypatch.setattr("lithic.operators.joins.weighed", lambda *_: 1 / 0)
    few = anti_join_few(left, right, ["k"], max_bytes=1000)
    assert few.count() == 1333 and table(few) == table(anti_join(left, right, ["k"]))


def test_first_per_key_gives_the_wanted_columns_alone(spark):
    df = spark.createDataFrame([(1, "b", True), (1, "a", True), (2, "c", False)], "k long, v string, f boolean")
    kept = first_per_key(df, ["k"], (), count="n", sums={"hits": F.col("f")}, columns=["k", "v"])
    assert kept.columns == ["k", "v", "n", "hits"] and table(kept) == [(1, "a", 2, 2), (2, "c", 1, 0)]
    assert "f, f#" not in plan(kept)
    assert table(first_per_key(df, ["k"], (), columns=["v", "k"])) == [("a", 1), ("c", 2)]
    text = plan(first_per_key(df.withColumn("id", F.lit("7")), ["k"], numeric_order("id")))
    assert "_order1" not in text and len(numeric_order("id")) == 2


def test_numbers_are_given_without_copies_of_named_columns(spark, monkeypatch):
    seen, keep = [], stable
    monkeypatch.setattr("lithic.operators.keys.stable", lambda df: seen.append(plan(df)) or keep(df))
    df = spark.range(20).selectExpr("cast(20 - id as string) as k")
    numbered = assign_keys(df, "n", numeric_order("k"), start=5)
    assert table(numbered) == sorted([(str(i), 5 + i) for i in range(1, 21)], key=repr) and "_order1" not in seen[0]
