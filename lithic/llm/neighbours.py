"""Nearest neighbours by largest inner product, with randomly rotated one-bit codes.

A vector is turned by a random rotation and kept as the signs of its coordinates, with its norm and the inner product of
the turned unit vector and its signs. From these the inner product with a query is estimated, and the estimate's error
is bounded (up to ERRORS standard deviations). Vectors whose upper bound reaches the k-th best lower bound are ranked
by their exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.sources.shared import stable

SEED = 11
#: Standard deviations of an estimate's error that count as its bound. Beyond lies a vector in several hundred thousand.
ERRORS = 4.5
#: Queries and candidates that one task compares, and candidates estimated by one matrix product.
QUERIES, CANDIDATES, TILE = 2048, 65536, 2048
#: What single precision may add to the error of an estimate, as a share of the product of the norms.
ROUNDING = 1e-5
#: Pairs reranked at once.
PAIRS = 1 << 16


@lru_cache(maxsize=4)
def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same wherever it is drawn."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each that brings their largest component to 0.5 to 1, and the exponents taken out."""
    exponents = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponents[:, None]), exponents


def codes(vectors: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the turned vectors, their norms, and the inner products of turned unit vectors and unit signs."""
    vectors, exponents = scaled(vectors)  # squares would overflow or vanish otherwise
    norms = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norms[:, None]) @ rotation(vectors.shape[1], seed)
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(turned > 0, axis=1), np.ldexp(norms, exponents), aligned


def nearest(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    packed: np.ndarray,
    norms: np.ndarray,
    aligned: np.ndarray,
    k: int,
    errors: float = ERRORS,
    seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the ``k`` best of these candidates for each query, but for the query's own id."""
    size = vectors.shape[1]
    # Powers of two are taken out of the queries and put back into the scores, which changes no bit of them.
    queries, exponents = scaled(queries)
    lengths = np.linalg.norm(queries, axis=1)
    turned = (queries @ rotation(size, seed)).astype(np.float32)
    best = np.full((len(queries), k), -np.inf)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    # The sign vector's part off the vector itself is as good as random in the remaining dimensions.
    spread = np.sqrt(np.maximum(0.0, 1 - aligned**2)) / aligned / np.sqrt(max(1, size - 1)) * norms
    for at in range(0, len(ids), TILE):
        part = slice(at, at + TILE)
        signs = np.unpackbits(packed[part], axis=1, count=size).astype(np.float32) * 2 - 1
        scale = norms[part] / (aligned[part] * np.sqrt(size))
        about = (turned @ signs.T) * scale
        slack = lengths[:, None] * (errors * spread[part] + ROUNDING * norms[part])
        own = query_ids[:, None] == ids[None, part]
        floor = best[:, -1]
        if about.shape[1] > k:  # the k-th best lower bound of this tile may be above what has been found
            low = np.where(own, -np.inf, about - slack)
            floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
        # Rounding mustn't drop a tie.
        rows, cols = np.nonzero((about + slack >= (floor - 1e-9 * np.abs(floor))[:, None]) & ~own)
        scores = np.empty(len(rows))
        for cut in range(0, len(rows), PAIRS):
            some = slice(cut, cut + PAIRS)
            scores[some] = np.einsum("ij,ij->i", queries[rows[some]], vectors[part][cols[some]])
        keep = scores >= best[rows, -1]
        rows, found, scores = rows[keep], ids[part][cols[keep]], scores[keep]
        merge(best, best_ids, rows, found, scores)
    rows, places = np.nonzero(best > -np.inf)
    return query_ids[rows], best_ids[rows, places], np.ldexp(best[rows, places], exponents[rows])


def merge(best: np.ndarray, best_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
    """Put new (row, id, score) triples among the best of their rows, in place; ties go to the smaller id."""
    touched = np.unique(rows)
    if not len(touched):
        return
    k = best.shape[1]
    rows = np.concatenate([np.repeat(touched, k), rows])
    ids = np.concatenate([best_ids[touched].ravel(), ids])
    scores = np.concatenate([best[touched].ravel(), scores])
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(rows)]])))
    first = place < k
    best[rows[first], place[first]] = scores[first]
    best_ids[rows[first], place[first]] = ids[first]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, size): one row per id of the vectors that take part."""
    given = F.col(vector)
    values = given.cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & given.isNotNull() & ~odd & F.exists(values, lambda x: x != 0))
    rows = rows.select(F.col(key).cast("long").alias("id"), values.alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))


def index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", seed: int = SEED) -> DataFrame:
    """(id, v, size, code, norm, aligned) of every vector that takes part, as written to the shared folder.

    Vectors that are null, empty, zero, or hold a null or non-finite component take no part, nor do rows with a null id.
    Of rows that share an id the smallest vector counts, so repeated rows count once. Very small and very large components
    are told apart as any others, as long as norms are finite in double precision.
    """

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, rows in batch.groupby("size"):
                packed, norms, aligned = codes(np.stack(rows["v"].to_numpy()), seed)
                yield rows.assign(code=[x.tobytes() for x in packed], norm=norms, aligned=aligned)

    schema = "id long, v array<double>, size int, code binary, norm double, aligned double"
    return stable(usable(vectors, key, vector).mapInPandas(coded, schema))


def search(
    indexed: DataFrame,
    queries: Column,
    k: int = 20,
    errors: float = ERRORS,
    seed: int = SEED,
    query_block: int = QUERIES,
    block: int = CANDIDATES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``indexed`` to those of its rows that ``queries`` picks.

    A query meets all rows of its own dimension but itself, in blocks of bounded size: each pair of a query block and a
    candidate block is one group, which returns ``k`` rows per query. The order is by exact inner product in double
    precision, ties to the smaller id. Fewer candidates than ``k`` are all returned; no queries or no candidates give no
    rows.
    """
    n = indexed.agg(F.count("*").alias("n"), F.count(F.when(queries, 1)).alias("q")).first()
    parts, query_parts = max(1, -(-n["n"] // block)), max(1, -(-n["q"] // query_block))
    deal = F.xxhash64("id")
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = (
        indexed.where(queries)
        .select("id", "v", "size", F.pmod(deal, F.lit(query_parts)).cast("int").alias("qb"))
        .withColumn("cb", numbers(parts))
    )
    offered = indexed.withColumn("cb", F.pmod(deal, F.lit(parts)).cast("int")).withColumn("qb", numbers(query_parts))

    def compared(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = nearest(
            left["id"].to_numpy(),
            np.stack(left["v"].to_numpy()),
            right["id"].to_numpy(),
            np.stack(right["v"].to_numpy()),
            np.stack([np.frombuffer(x, np.uint8) for x in right["code"]]),
            right["norm"].to_numpy(),
            right["aligned"].to_numpy(),
            k,
            errors,
            seed,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    group = ["size", "qb", "cb"]
    pairs = asked.groupBy(*group).cogroup(offered.groupBy(*group))
    near = pairs.applyInPandas(compared, "query_id long, vec_id long, score double")
    # A query's rows are k per block of candidates; their best k are taken by a sorted array, not a window.
    best = F.struct((-F.col("score")).alias("s"), F.col("vec_id"), "score")
    top = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(best)), 1, k).alias("best"))
    ranked = top.select("query_id", F.posexplode("best").alias("place", "row"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "row.vec_id", "row.score")
