"""Alignment of two tokenizers over a corpus, counted with inverted bitmaps of documents per pair of ids.

Both encodings of a text are cuts of the same bytes. Two tokens are linked where their bytes overlap, and each stretch
between neighbouring cuts of either encoding is one link. Documents are dealt to blocks where they are read. For each
pair of ids a block keeps which of its documents hold the pair and how often, as bit planes: plane k has the documents
whose number of such links has bit k set. A plane is a list of places or, beyond a size, a bitmap. The planes of a pair
ORed and popcounted give its documents; popcounts weighted by plane give its links; as blocks share no document, both
add up over blocks. What is learned of a pair goes back along its postings to the documents.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lithic.sources.shared import scratch_path, stable

#: Documents and links of a block, at most (a longer text is a block of its own), and bytes of texts taken at once.
DOCS, LINKS, BYTES = 8192, 4_000_000, 1 << 20
#: Documents taken at once, at most.
PORTION = 512
#: Bytes of a bitmap over all places of a block; fewer places than that stand as a list of 16-bit integers.
BITMAP = DOCS // 8
#: The mark that stands for a space, and how pieces name bytes.
MARK, BYTE_PIECE = "▁", "<0x{:02X}>"
#: White space that the ranks are not given.
LONG_SPACE = re.compile(r"\s{10000}")
HEADS = "at int, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
WRITTEN = f"kind string, block long, pair long, planes array<binary>, {HEADS}"


class Pair:
    """Two tokenizers: byte-level BPE and a SentencePiece model.

    The former is given twice, as a JSON file and as ranks: both give the same ids, the ranks faster, but only the JSON
    form stands long runs of white space.
    """

    def __init__(self, ranks: str, json: str, model: str):
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.left = tiktoken.Encoding("left", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.json, self.slow = json, None
        self.right = sentencepiece.SentencePieceProcessor(model_file=model)
        left = [b""] * (max(table.values()) + 1)
        for data, i in table.items():
            left[i] = data
        of_byte = {BYTE_PIECE.format(b): bytes([b]) for b in range(256)}
        names = [self.right.id_to_piece(i) for i in range(self.right.vocab_size())]
        right = [
            b"" if self.right.is_control(i) else of_byte[x] if self.right.is_byte(i) else x.replace(MARK, " ").encode()
            for i, x in enumerate(names)
        ]
        self.bytes = left, right
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        # Every id as text before a comma, and before what ends its side of a group.
        self.shown = [[np.array([f"{i}{end}".encode() for i in range(len(side))]) for end in ends] for side, ends in zip(self.bytes, ((",", "|"), (",", ";")))]

    def encode_left(self, text: str) -> list[int]:
        if LONG_SPACE.search(text):
            if self.slow is None:  # few texts need it
                self.slow = Tokenizer.from_file(self.json)
                self.slow.encode_special_tokens = True  # their strings in a text are ordinary text
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.left.encode_ordinary(text)

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both encodings of each text; none where either has not exactly the text's bytes after a space."""
        out = []
        for text, right in zip(texts, self.right.encode([x or "" for x in texts], num_threads=1)):
            data = b" " + text.encode() if text else b""
            left = self.encode_left(" " + text) if text else []
            same = all(b"".join(map(names.__getitem__, ids)) == data for names, ids in zip(self.bytes, (left, right)))
            out.append((left, right) if same and text else ([], []))
        return out


class Aligned:
    """The links and groups of a list of texts, all worked out at once."""

    def __init__(self, both: Pair, texts: list[str | None]):
        encoded = both.encode(texts)
        self.n = [np.array([len(x[side]) for x in encoded], np.int64) for side in (0, 1)]
        ids = [
            np.fromiter(chain.from_iterable([x[side] for x in encoded]), np.int64, int(self.n[side].sum()))
            for side in (0, 1)
        ]
        ends = [np.cumsum(both.sizes[side][ids[side]]) for side in (0, 1)]
        stop = np.concatenate([[0], np.cumsum(self.n[0])])
        last = np.where(stop > 0, np.concatenate([[0], ends[0]])[stop], 0)[1:]  # where each text ends
        # Which bytes end a token of either side, and how many tokens have ended before each byte.
        cut = [np.zeros(int(last[-1]) + 1, bool) for _ in ends]
        for side in (0, 1):
            cut[side][ends[side]] = True
        before = [np.cumsum(x) - x for x in cut]
        cuts = np.flatnonzero(cut[0] | cut[1])
        self.pairs = ids[0][before[0][cuts]] * len(both.bytes[1]) + ids[1][before[1][cuts]]
        self.n_links = np.diff(np.searchsorted(cuts, last, "right"), prepend=0)
        self.text_of = np.repeat(np.arange(len(texts)), self.n_links)
        both_cut = cut[0] & cut[1]
        self.n_groups = np.diff(np.searchsorted(np.flatnonzero(both_cut), last, "right"), prepend=0)
        group = np.cumsum(both_cut) - both_cut
        self.digests = self._digests(both, ids, [group[x] for x in ends])

    def _digests(self, both: Pair, ids: list[np.ndarray], groups: list[np.ndarray]) -> list[str]:
        # A group has its tokens of A, then those of B: both stand behind those of the groups before.
        upto = [np.cumsum(np.bincount(x, minlength=1)) for x in groups]
        ahead = np.concatenate([[0], upto[1]])
        at = [np.arange(len(ids[0])) + ahead[groups[0]], np.arange(len(ids[1])) + upto[0][groups[1]]]
        line = np.zeros(len(ids[0]) + len(ids[1]), "S8")
        for side in (0, 1):
            closes = np.diff(groups[side], append=-1) != 0
            for kind, end in zip(both.shown[side], (~closes, closes)):
                line[at[side][end]] = kind[ids[side][end]]
        stops = np.cumsum(self.n[0] + self.n[1]).tolist()
        out = []
        for a, b in zip([0, *stops], stops):
            data = line[a:b].tobytes().replace(b"\0", b"")[:-1]
            out.append(hashlib.sha256(data).hexdigest() if data else "")
        return out


def bitmaps(rows: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For ascending (row, place) the compressed set of places of each of ``n`` rows: (offsets, bytes)."""
    counts = np.bincount(rows, minlength=n)
    dense = 2 * counts >= BITMAP
    sizes = np.where(dense, BITMAP, 2 * counts)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(offsets[-1], np.uint8)
    ends = np.cumsum(counts)
    listed = ~dense[rows]
    first = offsets[rows] + 2 * (np.arange(len(rows)) - (ends - counts)[rows])
    for k in (0, 1):
        out[first[listed] + k] = (places[listed] >> 8 * k) & 255
    for row in np.flatnonzero(dense).tolist():
        own = np.zeros(8 * BITMAP, bool)
        own[places[ends[row] - counts[row] : ends[row]]] = True
        out[offsets[row] : offsets[row + 1]] = np.packbits(own, bitorder="little")
    return offsets, out


def places_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (row, place) that such sets hold."""
    sizes = np.diff(offsets)
    listed = np.flatnonzero(sizes != BITMAP)
    counts = sizes[listed] // 2
    first = np.repeat(offsets[listed] - 2 * (np.cumsum(counts) - counts), counts) + 2 * np.arange(counts.sum())
    places = data[first].astype(np.int64) | data[first + 1].astype(np.int64) << 8
    rows, found = [np.repeat(listed, counts)], [places]
    for row in np.flatnonzero(sizes == BITMAP).tolist():
        held = np.flatnonzero(np.unpackbits(data[offsets[row] : offsets[row + 1]], bitorder="little"))
        rows.append(np.full(len(held), row))
        found.append(held)
    return np.concatenate(rows), np.concatenate(found)


class Block:
    """Documents on their way to a block: what is known of each, and how often it holds each pair."""

    def __init__(self) -> None:
        self.heads, self.keys, self.counts, self.links = [], [], [], 0

    def add(self, both: Pair, keys: list[int | None], texts: list[str | None]) -> None:
        found, base = Aligned(both, texts), len(self.heads)
        columns = (found.n[0], found.n[1], found.n_groups, found.n_links)
        self.heads += zip(range(base, base + len(keys)), keys, *(x.tolist() for x in columns), found.digests)
        held, counts = np.unique(found.pairs << 16 | (found.text_of + base), return_counts=True)
        self.keys.append(held)
        self.counts.append(counts)
        self.links += len(found.pairs)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row per document, then a row per pair with its planes."""
        schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("pair", pa.int64()), ("planes", pa.list_(pa.binary()))])
        kinds = (pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.string())
        for field in zip((x.split()[0] for x in HEADS.split(", ")), kinds):
            schema = schema.append(pa.field(*field))

        def batch(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        n = len(self.heads)
        own = {f.name: pa.array(x, f.type) for f, x in zip([schema.field(k) for k in range(4, len(schema))], zip(*self.heads))}
        yield batch(n, kind=pa.array(["document"] * n), block=pa.array(np.full(n, block)), **own)
        held, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        self.keys, self.counts = [], []
        order = np.argsort(held, kind="stable")
        held, counts = held[order], counts[order]
        pairs, row = np.unique(held >> 16, return_inverse=True)
        places = held & 0xFFFF
        # Planes of a pair up to its highest, one after the other; lower ones may be empty.
        high = np.zeros(len(pairs), np.int64)
        np.maximum.at(high, row, counts)
        depth = np.ceil(np.log2(high + 1)).astype(np.int64)
        stops = np.concatenate([[0], np.cumsum(depth)])
        lines, at = [], []
        for plane in range(int(depth.max(initial=0))):
            has = np.flatnonzero(counts >> plane & 1)
            lines.append(stops[row[has]] + plane)
            at.append(places[has])
        lines, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lines, at))
        by = np.argsort(lines, kind="stable")
        offsets, data = bitmaps(lines[by], at[by], int(stops[-1]))
        sets = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        planes = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), sets)
        whole = batch(len(pairs), kind=pa.array(["pair"] * len(pairs)), block=pa.array(np.full(len(pairs), block)), pair=pa.array(pairs), planes=planes)
        for k in range(0, len(pairs), 1 << 15):
            yield whole.slice(k, 1 << 15)


def postings(docs: DataFrame, files: tuple[str, str, str], key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """What is known of every document by itself, and the planes of every pair in every block; both are written once.

    The files must be readable by every worker. A task holds the tokenizers as long as it runs.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number, block = Pair(*files), TaskContext.get().partitionId() << 32, Block()
        for keys, texts in portions(batches):
            block.add(both, keys, texts)
            if len(block.heads) >= DOCS - PORTION or block.links >= LINKS:
                yield from block.rows(number)
                number, block = number + 1, Block()
        if block.heads:
            yield from block.rows(number)

    path = scratch_path(docs.sparkSession, "pairs")
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    named.mapInArrow(blocks, WRITTEN).write.partitionBy("kind").parquet(path)
    read = docs.sparkSession.read.schema(WRITTEN).parquet(path)
    heads = read.where("kind = 'document'").select("block", *(x.split()[0] for x in HEADS.split(", ")))
    return heads, read.where("kind = 'pair'").select("block", "pair", "planes")


def portions(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Keys and texts of up to ``PORTION`` documents and about ``BYTES``; a longer text comes alone."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for k, value in zip(*(x.to_pylist() for x in batch.columns)):
            if texts and (len(texts) >= PORTION or size + len(value or "") > BYTES):
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(k)
            texts.append(value)
            size += len(value or "")
    if texts:
        yield keys, texts


def expanded(planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, plane) of all that the planes of some rows hold."""
    depth = planes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sets = planes.flatten()
    sizes = pc.binary_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.frombuffer(sets.buffers()[1], np.int32)[sets.offset] if len(sets) else 0
    data = np.frombuffer(sets.buffers()[2], np.uint8)[begin : begin + sizes.sum()] if len(sets) else np.zeros(0, np.uint8)
    line, place = places_of(np.concatenate([[0], np.cumsum(sizes)]), data)
    row = np.repeat(np.arange(len(planes)), depth)
    plane = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
    return row[line], place, plane[line]


def pair_counts(posted: DataFrame, width: int) -> DataFrame:
    """(pair, a, b, documents, links) over the corpus, for the pairs a * ``width`` + b.

    Blocks are counted where they are read; only sums of a task's pairs are shuffled.
    """

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, plane = expanded(batch.column("planes"))
            merged = np.unique(row << 16 | place) >> 16  # the planes of a row, ORed
            documents = np.bincount(merged, minlength=batch.num_rows)
            links = np.zeros(batch.num_rows, np.int64)
            np.add.at(links, row, np.int64(1) << plane)
            columns = [batch.column("pair"), pa.array(documents.astype(np.int64)), pa.array(links)]
            yield pa.RecordBatch.from_arrays(columns, names=["pair", "documents", "links"])

    found = posted.select("pair", "planes").mapInArrow(counted, "pair long, documents long, links long")
    sums = found.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    of = [F.expr(f"cast(pair {op} {width} as int)").alias(name) for op, name in (("div", "a"), ("%", "b"))]
    return sums.select("pair", *of, "documents", "links")


def returned(posted: DataFrame, scores: DataFrame) -> DataFrame:
    """(block, at, n_best, count_sum): the scores (pair, links, best) of all links of a document, along the postings."""

    def of_block(table: pa.Table) -> pa.Table:
        best, total = np.zeros(8 * BITMAP, np.int64), np.zeros(8 * BITMAP, np.int64)
        for batch in table.to_batches():
            row, place, plane = expanded(batch.column("planes"))
            times = np.int64(1) << plane
            np.add.at(total, place, times * batch.column("links").to_numpy(zero_copy_only=False)[row])
            np.add.at(best, place, times * batch.column("best").to_numpy(zero_copy_only=False)[row])
        at = np.flatnonzero(total)
        block = pa.array(np.full(len(at), table.column("block")[0].as_py()))
        columns = [block, pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])]
        return pa.Table.from_arrays(columns, names=["block", "at", "n_best", "count_sum"])

    both = posted.join(scores, "pair").select("block", "planes", "links", F.col("best").cast("long").alias("best"))
    return both.groupBy("block").applyInArrow(of_block, "block long, at int, n_best long, count_sum long")


def align(docs: DataFrame, files: tuple[str, str, str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """How the encodings of every text fit each other, and how common its links are over all texts.

    (``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). ``files`` are the ranks, the JSON form and the model. A is the byte-level encoding
    of a space and the text, B the model's encoding of the text. A group is what lies between two cuts that both have. ``count_sum``
    adds up, over the links of a text, how many links of all texts have the same two ids; ``n_best`` counts those for
    which no other A id is linked with their B id more often, ties included. The digest is of the groups as
    ``a1,a2|b1;a3|b2,b3``.

    Texts that are null or empty, or whose tokens don't give back exactly their bytes, have no tokens: zeros and an empty
    digest. Repeated rows, ids and null ids are documents of their own. Texts are taken whole, however long. An empty
    table gives an empty result; other columns are not looked at.
    """
    heads, posted = postings(docs, files, key, text)
    width = sentencepiece.SentencePieceProcessor(model_file=files[2]).vocab_size()
    counts = stable(pair_counts(posted, width))
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    scores = counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return heads.join(returned(posted, scores), ["block", "at"], "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
