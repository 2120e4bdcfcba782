from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from lithic.llm import alignment

SF_DIR = "/root/testdata/sf0.001"
FILES = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LEFT, RIGHT = Tokenizer.from_file(FILES[1]), sentencepiece.SentencePieceProcessor(model_file=FILES[2])
LEFT.encode_special_tokens = True


def byte_letters():
    """The character that byte-level entries show for each byte, reversed (printable ones are themselves)."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


LETTERS = byte_letters()


def spans(sizes):
    at = 0
    for i, size in sizes:
        yield i, at, at + size
        at += size


def encoded(text):
    if not text:
        return [], []
    data = b" " + text.encode()
    a = [(i, bytes(LETTERS[c] for c in LEFT.id_to_token(i))) for i in LEFT.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in RIGHT.encode(text):
        name = RIGHT.id_to_piece(i)
        b.append((i, bytes([int(name[1:-1], 16)]) if RIGHT.is_byte(i) else name.replace("▁", " ").encode()))
    same = all(b"".join(x for _, x in side) == data for side in (a, b))
    return (list(spans((i, len(x)) for i, x in a)), list(spans((i, len(x)) for i, x in b))) if same else ([], [])


def brute(docs):
    every, links_of, count = [], [], Counter()
    for key, text in docs:
        a, b = encoded(text)
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 2000 else swept(a, b)
        stops = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for stop in stops:
            sides = (",".join(str(i) for i, _, e in side if low < e <= stop) for side in (a, b))
            groups.append("|".join(sides))
            low = stop
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        every.append((key, len(a), len(b), len(stops), len(links), digest))
        links_of.append(links)
        count.update(links)
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    rows = []
    for (*head, digest), links in zip(every, links_of):
        rows.append((*head, sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), digest))
    return sorted(rows, key=repr)


def swept(a, b):
    links, k = [], 0
    for i, s, e in a:
        while b[k][2] <= s:
            k += 1
        m = k
        while m < len(b) and b[m][1] < e:
            links.append((i, b[m][0]))
            m += 1
    return links


def test_alignment_agrees_with_brute_force(spark):
    rnd = random.Random(1)
    odd = ["  two  spaces ", "naïve 日本語 \U0001f600", "▁mark", "<0x41> <s> </s> <|endoftext|>", "\n\n\t", "\x00", "a\u0301"]
    words = ["the", "quick", "Donaudampfschiff", "12345", "x=y+1;", "caf\u00e9", "...", "\n"]
    docs = [(k, " ".join(rnd.choices(words, k=rnd.randint(0, 40)))) for k in range(80)]
    docs += [(100 + k, x) for k, x in enumerate(odd)] + [(200, None), (201, ""), (None, "the"), (None, "the"), (3, docs[3][1])]
    docs += [(300, "the cat " * 9_000), (301, " " * 30_000 + "x")]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, block int, pair int").repartition(4)
    got = alignment.align(frame, FILES)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)
    assert alignment.align(frame.limit(0), FILES).count() == 0


def test_pair_counts_are_popcounts_over_all_blocks(spark):
    docs = [(k, "the cat sat" if k % 2 else "the the dog " * (k + 1)) for k in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    _, posted = alignment.postings(frame, FILES, "doc_id", "text")
    size = RIGHT.vocab_size()
    links, documents = Counter(), Counter()
    for _, text in docs:
        own = swept(*encoded(text))
        links.update(own)
        documents.update(set(own))
    got = {(r.a, r.b): (r.documents, r.links) for r in alignment.pair_counts(posted, size).collect()}
    assert got == {k: (documents[k], links[k]) for k in links}


def test_bitmaps_round_trip():
    rnd = np.random.default_rng(3)
    sets = [np.sort(rnd.choice(alignment.DOCS, n, replace=False)) for n in (0, 1, 5, 511, 512, 513, 8000, 8192, 0)]
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    offsets, data = alignment.bitmaps(rows, np.concatenate(sets), len(sets))
    row, place = alignment.places_of(offsets, data)
    order = np.lexsort((place, row))
    assert row[order].tolist() == rows.tolist() and place[order].tolist() == np.concatenate(sets).tolist()
    assert (np.diff(offsets) <= alignment.BITMAP).all()


def test_planes_of_a_block_hold_every_count():
    block, both = alignment.Block(), alignment.Pair(*FILES)
    texts = ["the " * k for k in range(1, 700)]
    for at in range(0, len(texts), 100):
        block.add(both, list(range(at, at + len(texts[at : at + 100]))), texts[at : at + 100])
    batches = list(block.rows(7))
    assert batches[0].num_rows == len(texts)
    held = Counter()
    for batch in batches[1:]:
        row, place, plane = alignment.expanded(batch.column("planes"))
        for pair, at, k in zip(batch.column("pair").take(pa.array(row)).to_pylist(), place.tolist(), plane.tolist()):
            held[at, pair] += 1 << k
    want = Counter()
    for at, text in enumerate(texts):
        want.update((at, i * RIGHT.vocab_size() + j) for i, j in swept(*encoded(text)))
    assert held == want


def test_op13_agrees_with_brute_force(spark):
    docs = [tuple(r.values()) for r in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = entry.queries()["op13_pair_bitmaps"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs)
