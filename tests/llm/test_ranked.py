from __future__ import annotations

import math
import random
import re

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from check_oracle import compare
from lithic.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, rank int, term string, block int", "item_id long, text string, rank int"
SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, top=50):
    held = [(k, TERM.findall(lowered(t))) for k, t in docs]
    n, total = sum(bool(x) for _, x in held), sum(len(x) for _, x in held)
    df = {}
    for _, found in held:
        for x in set(found):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(TERM.findall(lowered(text)))
    rows = []
    for item, terms in wanted.items():
        scores = []
        for k, found in held:
            m = 50 + 50 * len(found) * n // total if found else 0
            score = 0
            for x in terms.intersection(found):
                tf = found.count(x)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1000000000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, k is None, k))
        rows += [(item, r, k, -s) for r, (s, _, k) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(rows, key=repr)


def corpus(seed, n=300):
    rnd = random.Random(seed)
    words = ["the", "The", "THE", "naïve", "ÀÉ", "x_y", "a1", "日本"] + [f"w{k}" for k in range(60)]
    docs = []
    for k in range(n):
        size = rnd.choice([0, 1, 3, 30, 300])
        docs.append((k, rnd.choice([" ", "\n", "--"]).join(rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=size))))
    docs += [(n, None), (7, docs[7][1]), (7, "the w3"), (None, "w3 w4"), (None, "w3 w4"), (n + 1, "\x00;"), (n + 2, "w5 " * 400_000)]
    docs += [(n + 10 + k, "same copy of w9") for k in range(120)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randint(1, 12)))) for k in range(25)]
    return docs, items + [(3, "w7 copy"), (99, None), (98, "unknownword"), (97, ""), (None, "the")]


def test_search_agrees_with_brute_force(spark):
    docs, items = corpus(1)
    frame = spark.createDataFrame([(*d, 1, "t", 2) for d in docs], DOCS).repartition(5)
    indexed = ranked.index(frame)
    got = ranked.search(indexed, spark.createDataFrame([(*i, 0) for i in items], ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_items_in_chunks_and_a_smaller_top(spark, monkeypatch):
    monkeypatch.setattr(ranked, "QUERY_TERMS", 40)
    docs, items = corpus(2, 60)
    indexed = ranked.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = ranked.search(indexed, spark.createDataFrame(items, "item_id long, text string"), top=4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = corpus(3, 10)
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    nothing = spark.createDataFrame([(1, None), (2, " ;")], "doc_id long, text string")
    for left, right in ((docs.limit(0), items), (docs, items.limit(0)), (nothing, items)):
        assert ranked.search(ranked.index(left), right).count() == 0


@pytest.mark.parametrize("batch", (1, 3, 256))
def test_interval_search_of_one_block(batch):
    rnd = np.random.default_rng(batch)
    for n in (1, 2, 50, 700):
        places = [np.sort(rnd.choice(n, rnd.integers(1, n + 1), replace=False)) for _ in range(9)]
        impacts = [rnd.integers(0, 5 if n < 700 else 10**9, len(x)) for x in places]
        lists = ranked.Lists(places, impacts, n)
        for _ in range(20):
            own = rnd.permutation(9)[: rnd.integers(1, 10)]
            weights = rnd.integers(0, 4, len(own))
            scores = np.zeros(n, np.int64)
            for k, w in zip(own, weights):
                scores[places[k]] += w * impacts[k]
            top = int(rnd.integers(1, 12))
            want = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:top]
            assert [(-s, d) for d, s in lists.best(own, weights, n, top, batch)] == want


def test_range_maxima():
    rnd = np.random.default_rng(5)
    impacts = [rnd.integers(0, 9, n) for n in (1, 2, 3, 64, 65)]
    lists = ranked.Lists([np.arange(len(x)) for x in impacts], impacts, 65)
    for k, own in enumerate(impacts):
        for a in range(len(own) + 1):
            for b in range(a, len(own) + 1):
                at = lists.largest(np.array([[k]]), np.array([[a]]), np.array([[b]]))[0, 0]
                assert (at < 0) if a == b else lists.impacts[at] == own[a:b].max() and a <= at - lists.base[k] < b


def test_op12_agrees_with_its_sql(spark):
    db = duckdb.connect()
    for table in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = compare(spark, db, "op12_range_maxima", SF_DIR)
    assert result.startswith("ok"), result
    assert "op12_range_maxima" in entry.oracle_sql()
