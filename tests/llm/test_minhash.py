from __future__ import annotations

import random

from pyspark.sql import functions as F

from lithic.llm import minhash
from lithic.llm.components import components


def sets(text):
    words = text.encode().lower().split() if text else []
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def brute(rows):
    """Smallest id reachable over all pairs."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = [(i, sets(t)) for i, t in rows]
    for k, (i, a) in enumerate(held):
        for j, b in held[:k]:
            common = len(a & b)
            if a and b and 100 * common >= 75 * (len(a) + len(b) - common):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in root}


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(400)}"
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(5, 120))]
        for _ in range(rnd.randint(1, 9)):
            copy = [word() if rnd.random() < rnd.choice([0, 0.01, 0.03, 0.08]) else w for w in base]
            rows.append(" ".join(copy))
    # a chain in which neighbours are alike and the ends are not
    chain = [word() for _ in range(100)]
    for _ in range(30):
        chain = chain[2:] + [word(), word()]
        rows.append("\n".join(chain))
    rows += ["one two three four", "One TWO three four", "one two three", "", " \n", "Ünique WORDS five in a row"] * 2
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_classes_agree_with_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
        out = minhash.near_duplicates(docs).collect()
        assert {r.doc_id: r.component_id for r in out} == brute(rows)
        for row in out:
            assert row.n_shingles == len(sets(rows[row.doc_id][1])) and row.kept == (row.doc_id == row.component_id)


def test_a_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = corpus(3)
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == brute(rows)


def test_blocks_of_a_mixed_bucket_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BYTES", 40_000)
    names = spark.range(60).select("id", F.lit(b"s").alias("signature"), F.repeat(F.lit("w "), 5000).alias("text"))
    buckets = names.select(F.lit(1).alias("key"), F.lit(0).alias("band"), "id")
    stars = names.select(F.col("id").alias("u"), F.greatest(F.lit(0), F.col("id") - 57).alias("v"))
    rows = minhash.dealt(names.select("id", "signature"), names.select("id", "text"), buckets, stars).collect()
    assert max(sum(map(len, r.text)) for r in rows) <= 6 * 40_000  # of 620,000
    met = [(a, b) for r in rows for a, x in zip(r.id, r.minor) for b, y in zip(r.id, r.minor) if x and not y]
    assert sorted(met) == [(a, b) for a in (58, 59) for b in range(60)]
    docs = corpus(4)
    out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == brute(docs)


def test_nulls_long_texts_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"w{k}" for k in range(60000))
    rows = [(4, None), (5, ""), (6, None), (3, long), (2, long + " end"), (2, long + " end"), (None, long), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert out[4] == (0, 4, True) and out[5] == (0, 5, True)
    assert out[3] == (59996, 2, False) and out[2] == (59997, 2, True)
    assert out[None][1:] == (None, None)
    assert minhash.near_duplicates(docs).count() == len(rows)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(7, 7), (39, 2), (2, 39), (None, 3)]
    out = components(spark.createDataFrame(edges, "u long, v long")).collect()
    want = {k: 100 for k in range(101, 161)} | {k: 1 for k in range(2, 40)}
    assert sorted(tuple(r) for r in out) == sorted(want.items())
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
