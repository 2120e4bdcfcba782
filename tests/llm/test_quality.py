from __future__ import annotations

import random
import re

import pytest

from lithic.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    hit = set()
    for k, window in enumerate(windows):
        if windows.count(window) > 1:
            hit.update(range(k, k + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


def texts():
    rnd = random.Random(3)
    alphabet = ["a", "b", "é#", "c|d", " ", "\x1c", "x y"]
    gaps = [" ", "\n", "\t", "  ", "\r\n", "\n\n", "\x0b"]
    made = ["".join(rnd.choice(alphabet) + rnd.choice(gaps) for _ in range(rnd.randint(0, 90))) for _ in range(150)]
    prose = " ".join(f"word{rnd.randrange(10**6)}" for _ in range(400))
    return [None, "", " ", "\n", *made, prose, prose + " " + prose, "same line here\n" * 50]


def test_counts_agree_with_brute_force(spark):
    rows = list(enumerate(texts()))
    out = quality.rate(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "quality.*").collect()
    for row in out:
        assert tuple(row)[1:7] == brute(rows[row.doc_id][1]), rows[row.doc_id][1]
        assert not (row.base_failed and row.kept)


def test_bands_reject_what_repeats_or_is_random(spark):
    rnd = random.Random(5)
    prose = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(900))
    runs = " ".join(f"w{k // 7}" for k in range(200))  # no window of 8 words repeats
    noise = " ".join("".join(chr(rnd.randrange(33, 127)) for _ in range(60)) for _ in range(100))
    part = prose + " " + " ".join("".join(chr(rnd.randrange(33, 127)) for _ in range(40)) for _ in range(120))
    rows = [(0, prose), (1, runs), (2, noise), (3, part), (4, prose * 40)]
    out = quality.rate(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "quality.*")
    kept = {r.doc_id: (r.base_failed, r.kept) for r in out.collect()}
    assert kept == {0: (False, True), 1: (False, False), 2: (False, False), 3: (False, False), 4: (True, False)}


def test_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, quality int, kept string")
    out = quality.rate(docs)
    assert out.columns == ["doc_id", "text", "quality", "kept"] and out.first().kept == "x"
    assert quality.rate(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words", ([], [b"a"], [b"a"] * 8, [b"a"] * 9, [b"a", b"b"] * 9))
def test_repeat_words(words):
    want = len(words) if len(words) > 9 or len(words) == 9 else 0
    assert quality.repeat_words(words) == want


def test_the_end_of_a_text_lies_in_a_chunk(spark):
    rnd = random.Random(6)
    letters = "".join(rnd.choice("etaoinshrdlu ") for _ in range(4096))
    noise = "".join(chr(rnd.randrange(33, 127)) for _ in range(2040))
    rows = [(1, letters), (2, letters + noise), (3, letters[:2047]), (4, letters[:2049])]
    out = quality.rate(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "quality.bad_chunks")
    got = {r.doc_id: r.bad_chunks for r in out.collect()}
    assert got[1] == got[3] == got[4] == 0.0 and got[2] > 0.3
    assert quality.rate(spark.createDataFrame([(1, "word " * 2_000_000)], "doc_id long, text string")).count() == 1
