from __future__ import annotations

import random
import re

import pytest

from lithic.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing out again and again what is above the limit."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: weights[k % len(weights)] for k, x in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), list(names)
    while free:
        each = left / sum(weight[x] for x in free)
        over = [x for x in free if weight[x] * each > most * sizes[x] + 1e-9]
        if not over:
            return target | {x: weight[x] * each for x in free}
        for x in over:
            target[x] = most * sizes[x]
            left -= target[x]
            free.remove(x)
    return target


def highest_quotients(votes, seats):
    given = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda k: (-votes[k] / (2 * given[k] + 1), -votes[k], k))
        given[best] += 1
    return given


def documents(seed, n=300):
    rnd = random.Random(seed)
    sources = ["a", "Z", "é", None, "hot", "hot", "hot", "tiny"]
    rows = []
    for k in range(n):
        source = rnd.choice(sources) if k else "tiny"
        words = rnd.randint(0, 5 if source == "tiny" else 200)
        rows.append((k, rnd.choice([" ", "\n", "\t "]).join(f"w{rnd.randrange(99)}" for _ in range(words)), source))
    return rows + [(n, None, "a"), (n + 1, "\x1c one", "é"), (5, rows[5][1], rows[5][2])]


@pytest.mark.parametrize("shard", (10**9, 700))
def test_targets_are_met_and_no_document_is_used_too_often(spark, shard):
    rows = documents(1)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, taken int")
    out = mixing.mix(docs, shard=shard, block=4).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target, taken = wanted(sizes), dict.fromkeys(sizes, 0)
    of = {r[0]: r for r in rows}
    for row in out:
        _, text, source = of[row.doc_id]
        assert row["size"] == len(WORD.findall(text or "")) and row.source_size == sizes[source]
        assert row.target == pytest.approx(target[source]) and 0 <= row.taken <= 2 * row["size"]
        taken[source] += row.taken
    shards = {x: max(1, -(-n // shard)) for x, n in sizes.items()}
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 4 * (shards[source] + 1), source


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.createDataFrame(documents(2), "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.mix(docs, shard=900).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(5), shard=900).collect()))


def test_apportionment_is_by_highest_quotients(spark):
    rnd = random.Random(3)
    for _ in range(4):
        groups = {g: {k: rnd.choice([0, 1, 7, 7, rnd.randint(1, 10**6)]) for k in range(rnd.randint(1, 25))} for g in range(4)}
        groups[9] = {0: 0, 1: 0}
        seats = {g: rnd.randint(0, 300) for g in groups}
        rows = [(g, k, v, seats[g]) for g, votes in groups.items() for k, v in votes.items()]
        frame = spark.createDataFrame(rows, "g long, k long, votes long, seats long")
        got = {(r.g, r.k): r.quota for r in mixing.apportion(frame, ["g", "k"], "seats", ["g"]).collect()}
        for g, votes in groups.items():
            want = highest_quotients(votes, seats[g]) if sum(votes.values()) else dict.fromkeys(votes, 0)
            assert {k: got[g, k] for k in votes} == want


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert {(r["size"], r.target, r.taken) for r in mixing.mix(docs).collect()} == {(0, 0.0, 0)}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_a_tiny_source_gets_its_target_with_the_usual_block(spark):
    rows = [(k, "w " * 100, "big") for k in range(20)] + [(100, "one two three", "small"), (101, "one", None)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source, ids in (("small", {100}), (None, {101}), ("big", set(range(20)))):
        own = [r for r in out if r.doc_id in ids]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1, source
