from __future__ import annotations

import random

import corpus_pipeline
from lithic.llm.quality import rate
from lithic.sources.shared import stable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality int, _size string"


def documents(spark):
    rnd = random.Random(1)
    made = [" ".join(rnd.choice(["the", "of", "and"]) + rnd.choice("abcdefgh") * 2 for _ in range(90)) for _ in range(60)]
    texts = [*made, made[0], made[1] + " more", None, "", "short", "12 34 " * 30]
    rows = [(k, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), k, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, made[2] + " x y", None, "s1", 0, 0, "y")], SCHEMA)


def test_stages_keep_columns_and_take_effect(spark):
    docs = documents(spark)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stable(stage(spark, docs, ""))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert stage is corpus_pipeline.encode or docs.dtypes == before.dtypes
    wanted = {r.doc_id for r in rate(documents(spark)).where("quality.kept").collect()}
    first, second, third, fourth, fifth = kept.values()
    assert first == second == wanted and {0, 1, 60, 61, None} <= wanted and not {62, 63, 64, 65} & wanted
    assert third == wanted - {60, 61}
    assert fourth <= third and fifth == fourth


def test_empty_documents(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stable(stage(spark, docs, ""))
    assert docs.count() == 0
