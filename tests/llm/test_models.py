from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithic.llm import language, toxicity

SF_DIR = "/root/testdata/sf0.01"
SYLLABLES = {"aa": "th er on an re he in ed nd ha".split(), "bb": "ei ch ün ge te en sch ä ber der".split()}


def prose(rnd, name, n):
    return " ".join("".join(rnd.choice(SYLLABLES[name]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def corpus():
    rnd = random.Random(1)
    rows = [(k, prose(rnd, name, rnd.randint(5, 80)), name) for k, name in enumerate(["aa", "bb"] * 60)]
    return rows + [(900, None, "aa"), (901, "", "bb"), (902, "12 34", None), (None, "ther on", None), (0, rows[0][1], "aa")]


def test_languages(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    model = language.fit(docs, F.col("doc_id") % 3 != 1, max_texts=60, max_landmarks=16)
    assert model.languages == ("aa", "bb")
    out = language.identify(docs, model).select("doc_id", "lang", "text", "language.*").collect()
    assert len(out) == len(rows)
    for row in out:
        assert 0 <= row.score <= 1
        want = row.lang if language.has_letter(row.text) else "und"
        assert row.lang_pred == (want if row.doc_id is not None else "aa")
    empty = docs.limit(0)
    assert language.fit(empty, F.lit(True)).languages == ()
    assert language.identify(docs, language.fit(empty, F.lit(True))).where("language.lang_pred <> 'und'").count() == 0


def test_a_model_is_learned_from_as_many_texts_as_stated(spark, monkeypatch):
    seen, solve = [], language.solve
    monkeypatch.setattr(language, "solve", lambda packed, *rest: seen.append((len(packed), *rest[1:])) or solve(packed, *rest))
    names = F.concat(F.lit("l"), (F.col("doc_id") % 4).cast("string"))
    docs = spark.range(4400).select(F.col("id").alias("doc_id"))
    docs = docs.withColumns({"lang": names, "text": F.concat(names, F.lit(" some words"))})
    assert len(language.fit(docs, F.lit(True), bits=8).languages) == 4
    assert seen == [(4000, 400)]


def test_few_rows_are_ranked_for_the_sample(spark):
    hashed = F.xxhash64("doc_id").alias("h")
    docs = spark.range(40000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 30000, "aa").otherwise("bb").alias("lang"))
    hot = docs.where("doc_id = 7").crossJoin(spark.range(50000)).select("doc_id", "lang")
    for rows, counts in ((docs, {"aa": 30000, "bb": 10000}), (docs.unionByName(hot), {"aa": 80000, "bb": 10000})):
        near = language.smallest_hashes(rows, "doc_id", "lang", counts, 300).collect()
        for name in counts:
            got = sorted(r["_hash"] for r in near if r.lang == name)
            want = sorted(r.h for r in docs.where(F.col("lang") == name).select(hashed).collect())
            assert got[:300] == want[:300] and len(got) < 1500


def test_presence_of_a_text_in_pieces_is_that_of_the_whole(monkeypatch):
    text = "Än 12 thér ON-" * 30
    whole = language.presence([text], 3, 12)
    for size in (1, 2, 7, 50):
        monkeypatch.setattr(language, "CHARS", size)
        assert np.array_equal(whole, language.presence([text], 3, 12))


def test_weights_are_the_kernel_times_the_coefficients():
    rnd = random.Random(7)
    names = np.array(["aa", "bb"] * 20)
    found = language.presence([prose(rnd, x, 30) for x in names], 2, 10)
    languages, weights = language.solve(np.packbits(found, axis=1), names, max_landmarks=8)
    scaled = found / np.sqrt(found.sum(axis=1))[:, None]
    marks = np.concatenate([np.flatnonzero(names == x)[:4] for x in languages])
    kernel = scaled @ scaled[marks].T
    left = kernel.T @ kernel + 40 * language.RIDGE * kernel[marks] + 4e-7 * np.eye(8)
    direct = kernel @ np.linalg.solve(left, kernel.T @ (names[:, None] == np.array(languages)))
    assert np.allclose(scaled @ weights, direct, atol=1e-3)


def test_toxic_words_are_found_and_clean_texts_left_alone(spark):
    rnd = random.Random(2)
    docs, labels = [], []
    for k in range(1200):
        text, toxic = prose(rnd, "aa", rnd.randint(20, 60)), k % 8 == 0
        if toxic:
            text += f" {rnd.choice(['Grumpf,', 'zottelig!', 'SNARK'])} " + prose(rnd, "aa", 10)
        docs.append((k, text))
        if k % 2 == 0:
            labels.append((k, int(toxic)))
    docs += [(5000, None), (5001, ""), (None, "ther"), (0, docs[0][1])]
    labels += [(None, 1), (5000, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(frame, known, F.col("doc_id") % 5 != 0)
    out = toxicity.score(frame, model).collect()
    assert len(out) == len(docs)
    held_out = [r for r in out if r.doc_id is not None and r.doc_id < 5000 and r.doc_id % 5 == 0]
    assert np.mean([(r.toxic_score >= 0.5) == (r.doc_id % 8 == 0) for r in held_out]) > 0.98
    assert all(0 <= r.toxic_score < 0.5 for r in out if not r.text)
    nothing = toxicity.fit(frame, known.limit(0), F.lit(True))
    assert all(r.toxic_score == pytest.approx(0.01) for r in toxicity.score(frame, nothing).collect())
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_samples_are_bounded(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('w', id) as text")
    assert 400 < len(toxicity.sample(docs, "doc_id", "text", 500)) < 600
    same = spark.range(3000).selectExpr("5L as doc_id", "'w' as text")
    assert len(toxicity.sample(same, "doc_id", "text", 500)) <= 1


def test_the_risk_is_turned_where_it_is_negative():
    some = [np.array([1, 2], np.uint32)] * 20
    other = [np.array([3], np.uint32)] * 180 + some
    model = toxicity.train(some, other, 0.1, min_texts=1, min_errors=0)
    assert model.weights[1] > 0 > model.weights[3]
