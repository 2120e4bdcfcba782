from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from lithic.llm import sharding

COLUMNS = "doc_id long, text string, lang string, n double, size int, shard int, cell int"
DIMENSIONS = ("lang", "n")


def documents(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rnd.choice(["en", "en", "en", None, "de", "longer name a", "longer name b", ""])
        number = rnd.choice([1.0, 1.0, rnd.random() * 1e6, None, float("nan"), -3.0])
        text = "copy" if k % 3 == 0 else "é" * rnd.randint(0, 60)
        rows.append((k, text, lang, number, 1, 2, 3))
    return rows + [(5, rows[5][1], *rows[5][2:])] * 40 + [(None, None, None, None, 1, 2, 3)] * 3


def brute(rows, shards, root=None, first=0):
    """The tree by sorting whole cells; rows are (size, values, ties)."""
    if shards == 1 or not rows:
        return {r[2]: first for r in rows}
    ends = [(min(r[1][k] for r in rows), max(r[1][k] for r in rows)) for k in range(len(rows[0][1]))]
    root = root or ends
    width = [(b - a) / (d - c) if d > c else 0.0 for (a, b), (c, d) in zip(ends, root)]
    by = width.index(max(width))
    line = sorted(rows, key=lambda r: (r[1][by], r[2]))
    goal, below, cut = sum(r[0] for r in rows) * (shards // 2) / shards, 0, 0
    while below + line[cut][0] < goal:
        below, cut = below + line[cut][0], cut + 1
    cut += goal - below >= line[cut][0] / 2
    left = brute(line[:cut], shards // 2, root, first)
    return left | brute(line[cut:], shards - shards // 2, root, first + shards // 2)


@pytest.mark.parametrize("shards", (1, 5, 8))
def test_the_tree_is_that_of_sorting_whole_cells(spark, shards):
    docs = spark.createDataFrame(documents(shards), COLUMNS).repartition(5)
    rows = sharding.metadata(docs, "doc_id", "text", DIMENSIONS)
    found, _ = sharding.tree(rows, shards, 2)
    ties = lambda r: (r["_hash"], r["_part"], r["_row"])
    want = brute([(r["size"], tuple(r.dims), ties(r)) for r in rows.collect()], shards)
    assert {ties(r): r.cell for r in found.collect()} == want


@pytest.mark.parametrize("few", (False, True))
def test_shards_are_near_equal_and_slots_gapless(spark, monkeypatch, few):
    if few:  # many passes for each cut
        monkeypatch.setattr(sharding, "MOST", 50)
    data = documents(9)
    out = sharding.partition(spark.createDataFrame(data, COLUMNS), DIMENSIONS, shards=8).collect()
    of = defaultdict(list)
    for r in out:
        of[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    want = sorted(((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, *_ in data), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=repr) == want
    total, largest = sum(w[1] for w in want), max(w[1] for w in want)
    assert set(of) == set(range(8))
    for rows in of.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 8) < largest


def test_target_bytes_and_a_very_long_text(spark):
    data = [(k, "a" * 99, "en", 1.0, 1, 2, 3) for k in range(100)] + [(100, "b" * 3_000_000, "en", 2.0, 1, 2, 3)]
    out = sharding.partition(spark.createDataFrame(data, COLUMNS), DIMENSIONS, target_bytes=1_000_000).collect()
    assert len(out) == 101 and {r.shard for r in out} <= set(range(4))
    with pytest.raises(ValueError):
        sharding.partition(spark.createDataFrame(data, COLUMNS), DIMENSIONS)


def test_empty_tables_and_reruns(spark):
    docs = spark.createDataFrame(documents(4), COLUMNS)
    assert sharding.partition(docs.limit(0), DIMENSIONS, shards=8).count() == 0
    first = sorted(map(repr, sharding.partition(docs, DIMENSIONS, shards=3).collect()))
    assert first == sorted(map(repr, sharding.partition(docs.repartition(7), DIMENSIONS, shards=3).collect()))
