from __future__ import annotations

import random

from lithic.llm import preferences

TURN = "pair_id long, turn long, role string, text string"


def brute(chosen, rejected):
    """(pair, part, role, text) in order."""
    out = []
    sides = [
        {p: [x[2:] for x in sorted(side, key=lambda x: (x[1], *x[2:])) if x[0] == p] for p in {x[0] for x in side}}
        for side in (chosen, rejected)
    ]
    for p in sides[0].keys() & sides[1].keys():
        a, b = sides[0][p], sides[1][p]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        out += [(p, "prompt", *x) for x in a[:n]] + [(p, "chosen", *x) for x in a[n:]] + [(p, "rejected", *x) for x in b[n:]]
    return out


def conversations(seed):
    rnd = random.Random(seed)
    turn = lambda: (rnd.choice(["user", "assistant"]), rnd.choice("abc"))
    left, right = [], []
    for p in range(60):
        common = [turn() for _ in range(rnd.randint(0, 4))]
        for side in (left, right):
            if rnd.random() < 0.95:
                side += [(p, 3 * k, *x) for k, x in enumerate(common + [turn() for _ in range(rnd.randint(0, 3))])]
    return left, right


def test_prefix_and_completions_agree_with_brute_force(spark):
    left, right = conversations(1)
    rows = preferences.aligned(spark.createDataFrame(left, TURN), spark.createDataFrame(right, TURN)).collect()
    got = [(r.pair_id, r.part, r.role, r.body.removesuffix("<|im_end|>\n")) for r in rows]
    assert sorted(got) == sorted(brute(left, right))
    for r in rows:
        assert r.trained == (r.part != "prompt" and r.role == "assistant") and r["head"] == f"<|im_start|>{r.role}\n"


def test_examples(spark):
    left = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <|im_end|>"), (2, 0, None, None), (None, 0, "user", "x")]
    right = [(1, 5, "user", "hi"), (1, 9, "assistant", "no"), (1, 10, "user", "why"), (2, 0, "user", "")]
    rows = preferences.aligned(spark.createDataFrame(left, TURN), spark.createDataFrame(right, TURN))
    one, two = sorted(preferences.examples(rows).collect())
    assert one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert [tuple(x) for x in one.chosen] == [("<|im_start|>assistant\n", False), ("yes < |im_end|><|im_end|>\n", True)]
    assert [x.trained for x in one.rejected] == [False, True, False, False]
    assert two.prompt == "<|im_start|>user\n<|im_end|>\n" and two.chosen == [] and two.rejected == []


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], TURN)
    some = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a")], TURN)
    assert preferences.aligned(none, some).count() == 0 and preferences.aligned(none, none).count() == 0
    assert [(r.part, r.place) for r in preferences.aligned(some, some).orderBy("place").collect()] == [("prompt", 0), ("prompt", 1)]


def test_neighbours_answer(spark):
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "z"), (5, 0, "user", "r"), (5, 1, "assistant", "b")]
    turns += [(2, 0, "user", "q"), (8, 0, "assistant", "c"), (8, 1, None, "y"), (None, 0, "assistant", "c"), (3, None, "assistant", "c")]
    frame = spark.createDataFrame([(*x, 1, 2) for x in turns], "conv_id long, turn long, role string, text string, answer int, end int")
    chosen, rejected = preferences.with_neighbours_answer(frame)
    assert sorted(map(tuple, chosen.collect())) == [x for x in turns[:5]] + [(8, 0, "assistant", "c"), (8, 1, None, "y")]
    assert sorted(map(tuple, rejected.collect())) == [
        (0, 0, "user", "q"), (0, 1, "assistant", "b"), (5, 0, "user", "r"), (5, 1, "assistant", "a"), (8, 0, "assistant", "b"),
    ]
    alone = frame.where("conv_id in (0, 2)")
    assert [x.count() for x in preferences.with_neighbours_answer(alone)] == [0, 0]
    assert [x.count() for x in preferences.with_neighbours_answer(frame.limit(0))] == [0, 0]


def test_ids_with_gaps_and_long_conversations_lose_no_answer(spark):
    turns = [(2 * p, t, "assistant" if t % 2 else "user", f"{p} {t}") for p in range(7) for t in range(p + 1)]
    turns += [(100, t, "assistant" if t % 2 else "user", "x" * 5000) for t in range(2001)]
    chosen, rejected = preferences.with_neighbours_answer(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = preferences.aligned(chosen, rejected)
    answered = {p for p, _, role, _ in turns if role == "assistant"}
    assert {r.pair_id for r in rows.select("pair_id").distinct().collect()} == answered
    kept = rows.where("part <> 'rejected'").groupBy("pair_id").count().collect()
    assert dict(map(tuple, kept)) == {p: sum(x[0] == p for x in turns) for p in answered}
    assert rows.where("part = 'rejected'").groupBy("pair_id").count().where("count <> 1").count() == 0
