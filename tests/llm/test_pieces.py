from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lithic.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(model):
    rnd = random.Random(1)
    alphabet = "aeinst  ▁▁\n\tçéß梦ö<s>/0x1Ａ日本語ab…🙂́\x00\xa0"
    words = [model.names[i].replace("▁", " ") for i in model.ids.values()]
    return [
        "",
        *("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)),
        *("".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(1500)),
        *("a" * k for k in (1, 2, 3, 17, 300)),
        *(" " * k + "the x" + " " * (k // 3) + "!" for k in range(60)),
        "lo" * 20000,
        "wordy " * 20000,
    ]


def test_encodes_and_decodes_as_the_library(library):
    model = pieces.pieces(PATH)
    for text in texts(model):
        ids = np.frombuffer(model.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), text[:80]
        assert model.decode(model.encode(text)) == library.decode(ids), text[:80]


def test_decodes_any_ids_as_the_library(library):
    model, rnd = pieces.pieces(PATH), random.Random(2)
    for _ in range(3000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(300)]) for _ in range(rnd.randint(0, 8))]
        assert model.decode(pieces.pack(ids)) == library.decode(ids), ids


def test_the_table_agrees_with_merging():
    model, rnd = pieces.pieces(PATH), random.Random(4)
    for _ in range(2000):
        text = "▁" + "".join(rnd.choice("abcdeinrst") for _ in range(rnd.randint(0, 24)))
        assert model.table(text) == model.merge(text) == model.merge_short(text)


def test_columns(spark, library):
    rows = [(1, None), (2, ""), (3, "the the"), (3, "the the"), (4, "x" * 300000)]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, ids string")
    out = pieces.with_pieces(docs, PATH).orderBy("doc_id").collect()
    for row in out:
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(row.text or "", add_bos=True, add_eos=True)
        assert row.decoded == (row.text or "")
    assert pieces.with_pieces(docs.limit(0), PATH).count() == 0
    plain = docs.select(pieces.encode(docs["text"], PATH, begin=False, end=False).alias("ids")).first()
    assert bytes(plain.ids) == b""
