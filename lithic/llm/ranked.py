"""Ranked lexical search with a range-maximum table for every posting list.

The index deals the documents to blocks. A block has its documents in the order of their ids and, per term, the places
of the documents that hold it with their counts. A search works on one block at a time: the impacts of a posting list
get a sparse table, which names the largest impact of any range of the list in two look-ups. The sum of a query's
range maxima bounds the score of every document of an interval. Intervals are taken best bound first, in batches; one is
split at the document of its largest single impact, which is scored, and what remains on both sides gets its own bounds.
It ends when no interval can hold a document that belongs to the block's best. The best of all blocks are ranked last.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lithic.sources.shared import scratch_path, stable

TOP = 50
#: Documents and bytes of text of a block, at most (a longer text is a block of its own).
DOCS, BYTES = 8192, 32 << 20
#: Bytes of a text whose terms are counted at once; terms of the queries that are searched for together.
SLICE, QUERY_TERMS = 1 << 20, 20_000
#: Intervals of a query that are split at once.
BATCH = 256
#: A term's bytes, with A-Z in lower case; all other ASCII bytes separate terms.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Fixed values of the scores: m is 100 - 50 of 100 and 50 of a document's length over the mean.
IMPACT, TF_BY, M_BY = 1_000_000_000, 1000, 20
INDEX = "block long, term binary, places array<int>, counts array<int>, ids array<long>, lengths array<long>"


class Numbers(dict):
    """Numbers of terms in the order in which they come up."""

    def __missing__(self, term: bytes) -> int:
        self[term] = found = len(self)
        return found


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists for about ``SLICE`` bytes each."""
    data = text.encode().translate(TERM_BYTES) if text else b""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Block:
    """Documents on their way to a block of the index."""

    def __init__(self) -> None:
        self.numbers, self.ids, self.found, self.bytes = Numbers(), [], [], 0

    def add(self, key: int | None, text: str | None) -> None:
        parts = [np.fromiter(map(self.numbers.__getitem__, part), np.int64, len(part)) for part in terms(text)]
        self.ids.append(key)
        self.found.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        self.bytes += len(text or "")

    @property
    def full(self) -> bool:
        return len(self.ids) >= DOCS or self.bytes >= BYTES

    def rows(self, block: int) -> pa.RecordBatch:
        """A row with the documents, whose term is null, then a row per term in the order of the terms."""
        key = [(x is None, x or 0) for x in self.ids]
        order = sorted(range(len(key)), key=key.__getitem__)
        found = [self.found[k] for k in order]
        lengths = np.array([len(x) for x in found], np.int64)
        named = sorted(self.numbers)
        rank = np.empty(len(named), np.int64)
        rank[[self.numbers[x] for x in named]] = np.arange(len(named))
        every = rank[np.concatenate(found)] if named else np.zeros(0, np.int64)
        self.found, self.numbers = [], Numbers()
        every *= len(order)
        every += np.repeat(np.arange(len(order)), lengths)
        pairs, counts = np.unique(every, return_counts=True)
        sizes = np.bincount(pairs // max(1, len(order)), minlength=len(named))
        offsets = np.concatenate([[0, 0], np.cumsum(sizes)]).astype(np.int32)
        n = len(named) + 1
        none = np.concatenate([[0], np.full(n, len(order))]).astype(np.int32)
        ids = pa.array([self.ids[k] for k in order], pa.int64())
        columns = [
            pa.array(np.full(n, block)),
            pa.array([None, *named], pa.binary()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array((pairs % max(1, len(order))).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(none), ids),
            pa.ListArray.from_arrays(pa.array(none), pa.array(lengths)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "term", "places", "counts", "ids", "lengths"])


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """The index of all documents, written to ``path`` (a path in the shared folder if none is given).

    Blocks are made where the documents are read, nothing is shuffled. A row per block and term has the places of the
    documents in the block and how often they hold the term; the row without a term has the documents' ids, ascending,
    null last, and how many terms they have. A null or empty text has no term. Rows that share an id are documents of
    their own. Texts are taken whole, however long. An empty table gives an empty index.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            for k, value in zip(*(x.to_pylist() for x in batch.columns)):
                block.add(k, value)
                if block.full:
                    yield from sliced(block.rows(number))
                    number, block = number + 1, Block()
        if block.ids:
            yield from sliced(block.rows(number))

    def sliced(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, rows.num_rows, 1 << 15):
            yield rows.slice(at, 1 << 15)

    path = path or scratch_path(docs.sparkSession, "postings")
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    named.mapInArrow(blocks, INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


class Lists:
    """The posting lists of a block for the terms of some queries, each with its sparse table."""

    def __init__(self, places: list[np.ndarray], impacts: list[np.ndarray], n: int):
        self.n = n
        self.lengths = np.array([len(x) for x in places], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.lengths)])
        self.places, self.impacts = np.concatenate(places), np.concatenate(impacts)
        longest = int(self.lengths.max())
        self.starts = np.zeros((longest.bit_length(), len(places)), np.int64)
        kind = np.int16 if longest <= np.iinfo(np.int16).max else np.int32
        tables, at = [], 0
        for k, own in enumerate(impacts):
            table = np.arange(len(own), dtype=kind)
            for level in range(len(own).bit_length()):
                if level:
                    left, right = table[: -(1 << level - 1)], table[1 << level - 1 :]
                    table = np.where(own[right] > own[left], right, left)
                self.starts[level, k] = at
                tables.append(table)
                at += len(table)
        self.tables = np.concatenate(tables)
        self.log = np.zeros(longest + 2, np.int64)
        for k in range(2, len(self.log)):
            self.log[k] = self.log[k // 2] + 1

    def after(self, lists: np.ndarray) -> np.ndarray:
        """For some lists, the first posting at or after each place, and after all places."""
        held = np.zeros((len(lists), self.n + 1), np.int32)
        for row, k in enumerate(lists.tolist()):
            held[row, self.places[self.base[k] : self.base[k + 1]] + 1] = 1
        return np.cumsum(held, axis=1, dtype=np.int32)

    def largest(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where in all postings the largest impact of [low, high) of each list is; -1 if the range is empty."""
        size = high - low
        level = self.log[size]
        start = self.starts[level, lists]
        a = self.tables[start + np.where(size > 0, low, 0)]
        b = self.tables[start + np.where(size > 0, high - (1 << level), 0)]
        base = self.base[lists]
        best = np.where(self.impacts[base + b] > self.impacts[base + a], b, a) + base
        return np.where(size > 0, best, -1)

    def best(self, lists: np.ndarray, weights: np.ndarray, n: int, top: int, batch: int = BATCH) -> list[tuple[int, int]]:
        """(place, score) of the ``top`` documents of the block for one query: higher scores, then smaller places, first."""
        kept_place, kept_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, last = 0, n  # what a document must reach, and before which place if it just does

        def bounded(lows: np.ndarray, highs: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
            """The intervals with a document, with their ranges in every list, bounds and the places of their largest impacts."""
            at = self.largest(lists[None, :], a, b)
            parts = np.where(at >= 0, self.impacts[at], 0) * weights
            bounds = parts.sum(axis=1)
            rows = np.flatnonzero((bounds > least) | ((bounds == least) & (least > 0) & (lows < last)))
            parts, at = parts[rows], at[rows]
            places = self.places[at[np.arange(len(rows)), parts.argmax(axis=1)]] if len(rows) else np.zeros(0, np.int64)
            return lows[rows], highs[rows], a[rows], b[rows], bounds[rows], places.astype(np.int64)

        after_place, rows_ = self.after(lists), np.arange(len(lists))[None, :]
        whole = np.zeros((1, len(lists)), np.int64)
        open_ = bounded(np.zeros(1, np.int64), np.full(1, n, np.int64), whole, self.lengths[lists][None, :])
        while len(bounds := open_[4]):
            if len(bounds) > batch:
                taken = np.zeros(len(bounds), bool)
                taken[np.argpartition(-bounds, batch)[:batch]] = True
                rest = [x[~taken] for x in open_]
                lows, highs, a, b, _, places = (x[taken] for x in open_)
            else:
                (lows, highs, a, b, _, places), rest = open_, None
            at, after = (after_place[rows_, (places + k)[:, None]].astype(np.int64) for k in (0, 1))
            held = self.impacts[np.minimum(self.base[lists] + at, len(self.impacts) - 1)]
            scores = (np.where(after > at, held, 0) * weights).sum(axis=1)
            kept_place, kept_score = np.concatenate([kept_place, places]), np.concatenate([kept_score, scores])
            order = np.lexsort((kept_place, -kept_score))[:top]
            kept_place, kept_score = kept_place[order], kept_score[order]
            if len(order) == top:
                least, last = int(kept_score[-1]), int(kept_place[-1])
            sides = [np.concatenate(x) for x in ((lows, places + 1), (places, highs), (a, after), (at, b))]
            new = bounded(*sides)
            if rest is not None:
                going = (rest[4] > least) | ((rest[4] == least) & (rest[0] < last))
                new = tuple(np.concatenate([x[going], y]) for x, y in zip(rest, new))
            open_ = new
        found = kept_score > 0
        return list(zip(kept_place[found].tolist(), kept_score[found].tolist()))


def weight(n: int, df: np.ndarray) -> np.ndarray:
    """Of terms that ``df`` of ``n`` documents hold."""
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df.astype(np.float64) + 1))).astype(np.int64)


def impact(counts: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """Of a term's counts in documents of so many terms, without the term's weight."""
    distinct, at = np.unique(lengths, return_inverse=True)
    m = np.array([50 + 50 * x * n // total for x in distinct.tolist()], np.int64)[at]
    return IMPACT * counts.astype(np.int64) // (TF_BY * counts + M_BY * m)


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(item, term): the distinct terms of the rows of each item."""

    @F.pandas_udf("array<binary>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(set(chain.from_iterable(terms(x)))) for x in texts], dtype=object)

    named = queries.where(F.col(key).isNotNull())
    named = named.select(F.col(key).cast("long").alias("item"), found(F.col(text)).alias("terms"))
    return named.select("item", F.explode("terms").alias("term")).distinct()


def found_in_blocks(indexed: DataFrame, items: dict[int, list[bytes]], n: int, total: int, top: int) -> DataFrame:
    """(item, doc, score): the best documents of every block for a bounded number of items."""
    spark = indexed.sparkSession
    names = sorted(set(chain.from_iterable(items.values())))
    wanted = F.broadcast(spark.createDataFrame([(x,) for x in names], "term binary"))  # QUERY_TERMS at most
    met = stable(indexed.join(wanted, "term", "left_semi").select(indexed.columns))
    sums = met.groupBy("term").agg(F.sum(F.size("places")).alias("df")).collect()
    weights = dict(zip((bytes(r.term) for r in sums), weight(n, np.array([r.df for r in sums])).tolist()))

    def best(table: pa.Table) -> pa.Table:
        head = [x is None for x in table.column("term").to_pylist()].index(True)
        ids, lengths = (table.column(c)[head].values for c in ("ids", "lengths"))
        lengths = lengths.to_numpy(zero_copy_only=False)
        places, impacts, numbers = [], [], {}
        for k, term in enumerate(table.column("term").to_pylist()):
            if term is not None:
                numbers[term] = len(places)
                at, counts = (table.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("places", "counts"))
                places.append(at)
                impacts.append(impact(counts, lengths[at], n, total))
        out: list[tuple[int, int, int]] = []
        if places:
            lists = Lists(places, impacts, len(ids))
            for item, own in items.items():
                held = [x for x in own if x in numbers]
                if held:
                    by = np.array([numbers[x] for x in held], np.int64)
                    out += [(item, *x) for x in lists.best(by, np.array([weights[x] for x in held], np.int64), len(ids), top)]
        columns = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
        columns[1] = ids.take(columns[1])
        return pa.Table.from_arrays(columns, names=["item", "doc", "score"])

    blocks = met.unionByName(indexed.where("term is null"))
    return blocks.groupBy("block").applyInArrow(best, "item long, doc long, score long")


def search(
    indexed: DataFrame, queries: DataFrame, key: str = "item_id", text: str = "text", doc: str = "doc_id", top: int = TOP
) -> DataFrame:
    """(``key``, rank, ``doc``, score): the ``top`` documents of every item, higher scores, then smaller ids, first.

    A score sums the impacts of the item's distinct terms in the document, as weight * impact in 64-bit integers.
    Documents without a common term have score 0 and are left out, as are items with a null id; rows that share an id
    are one item. Documents with a null id rank after others of their score; rows that share an id are ranked each.

    The items are searched for in chunks of about ``QUERY_TERMS`` terms, which tasks get whole, with the number of
    documents of each. A block's posting lists of these terms meet in one task, and only its best documents are
    shuffled on. An empty index or no item gives an empty result.
    """
    wanted = stable(query_terms(queries, key, text))
    chunks = -(-wanted.count() // QUERY_TERMS)
    summed = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    heads = indexed.where("term is null").select(F.size(F.filter("lengths", lambda x: x > 0)).alias("n"), summed.alias("total"))
    n, total = heads.agg(F.sum("n"), F.sum("total")).first()
    found = indexed.sparkSession.createDataFrame([], "item long, doc long, score long")
    for chunk in range(chunks if total else 0):
        items: dict[int, list[bytes]] = {}
        for r in wanted.where(F.pmod(F.xxhash64("item"), F.lit(chunks)) == chunk).collect():
            items.setdefault(r.item, []).append(bytes(r.term))
        if items:
            found = found.unionByName(found_in_blocks(indexed, items, n, total, top))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(key), "rank", F.col("doc").alias(doc), "score")
