from __future__ import annotations

import hashlib
import os
import re
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from test_minhash import brute, sets
from test_mixing import WORD, wanted
from test_neighbours import brute as nearest
from test_quality import brute as counted
from test_warc import digest

import __spark_entry__ as entry
from check_oracle import compare
from lithic.llm import mixing
from lithic.llm.extraction import extract

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")


def rows_of(table, *columns):
    return [tuple(r.values()) for r in pq.read_table(f"{SF_DIR}/{table}.parquet", columns=list(columns)).to_pylist()]


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR).collect()


def test_op1_agrees_with_its_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
    result = compare(spark, db, "op1_preferences", SF_DIR)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name, of, held", [("op2_string_kernel", 3, 1), ("op4_positive_unlabelled", 5, 0)])
def test_folds_of_op2_and_op4(spark, name, of, held):
    got = run(spark, name)
    want = [(i, crc32(str(i).encode()) % of == held) for (i,) in rows_of("documents", "doc_id")]
    assert sorted((r.doc_id, r.held_out) for r in got) == sorted(want)
    if name.startswith("op4"):
        assert all(r.predicted == (r.score >= 0.5) for r in got)


def test_op3_counts_the_words_of_every_document(spark):
    want = [(i, *counted(text)) for i, text in rows_of("documents", "doc_id", "text")]
    got = run(spark, "op3_compression_bands")
    assert sorted(tuple(r)[:7] for r in got) == sorted(want)
    assert not any(r.base_failed and r.kept for r in got) and any(r.kept for r in got)


def test_digests_of_op5_are_those_of_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for key, text in rows_of("documents", "doc_id", "text"):
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        digests = (hashlib.sha256(x).hexdigest() for x in (packed, library.decode(ids).encode()))
        want.append((key, len(ids), *digests))
    assert sorted(map(tuple, run(spark, "op5_sentencepiece"))) == sorted(want)


def test_op6_has_the_text_of_every_page(spark):
    want = [(i, url, extract(html), len(extract(html))) for i, url, html in rows_of("pages", "page_id", "url", "html")]
    assert sorted(map(tuple, run(spark, "op6_rendered_text"))) == sorted(want)


def test_op7_has_targets_and_sizes_of_every_document_without_python(spark):
    frame = entry.queries()["op7_sainte_lague"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan), plan
    docs = {i: (len(WORD.findall(text or "")), source) for i, text, source in rows_of("documents", "doc_id", "text", "source")}
    sizes = {}
    for n, source in docs.values():
        sizes[source] = sizes.get(source, 0) + n
    target, got = wanted(sizes), frame.collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for row in got:
        size, source = docs[row.doc_id]
        assert (row["size"], row.source_size) == (size, sizes[source]) and row.target == pytest.approx(target[source])


    taken = dict.fromkeys(target, 0)
    for row in got:
        assert 0 <= row.taken <= 2 * row["size"]
        taken[docs[row.doc_id][1]] += row.taken
    for source in target:  # a shard each, as the table is small
        assert abs(taken[source] - target[source]) <= 2 * mixing.BLOCK, source


def test_op8_finds_nine_tenths_of_the_nearest_and_scores_them_exactly(spark):
    rows = {i: np.array(v, float) for i, v in rows_of("embeddings", "vec_id", "embedding")}
    want, got = nearest(rows, lambda i: i % 20 == 0, 20), {}
    for r in sorted(run(spark, "op8_one_bit_codes"), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.rank == len(got[r.query_id]) and r.score == pytest.approx(float(rows[r.query_id] @ rows[r.vec_id]), rel=1e-12)
    assert {i: len(x) for i, x in got.items()} == {i: len(x) for i, x in want.items()}
    found = sum(len({j for j, _ in want[i]} & set(got[i])) for i in want)
    assert found >= 0.9 * sum(map(len, want.values()))


def test_op9_has_a_record_of_every_page(spark):
    pages = [(i, (html or "").encode()) for i, html in rows_of("pages", "page_id", "html")]
    last = {}
    for i, data in pages:
        last[data] = max(i, last.get(data, i))
    want = [
        (i, len(data), digest(data), "response" if last[data] == i else "revisit", None if last[data] == i else last[data])
        for i, data in pages
    ]
    assert sorted(map(tuple, run(spark, "op9_warc_revisits"))) == sorted(want)


def test_op10_agrees_with_brute_force(spark):
    docs = rows_of("documents", "doc_id", "text")
    root = brute(docs)
    want = [(i, len(sets(text)), root[i], root[i] == i) for i, text in docs]
    assert sorted(map(tuple, run(spark, "op10_minhash"))) == sorted(want)
