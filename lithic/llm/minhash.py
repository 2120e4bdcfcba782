"""Near-duplicates by MinHash: minima of universal hashes, banding, verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithic.llm.components import components
from lithic.sources.shared import stable

WIDTH = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: 128 minima in 32 bands of 4. Two sets with similarity 0.75 miss each other in all bands once in 180,000 times.
BANDS, ROWS = 32, 4
#: Minima agree as often as the sets overlap. 5 standard deviations below the threshold nothing more is compared.
ERRORS = 5.0
SEED = 20
#: Words whose hashes a task remembers; only speed depends on it.
CACHE_WORDS = 200_000
#: Shingles hashed at once, members of a bucket that are compared in one go, and bytes of their texts on average.
SHINGLES, BLOCK, BYTES = 1 << 12, 128, 16 << 20


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


@lru_cache(maxsize=4)
def factors(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit factors."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(1)


def shingles(text: str | None, width: int = WIDTH, known: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text; of all its words, if they are fewer."""
    known = WordHashes() if known is None else known
    words = text.encode().lower().split() if text else []  # bytes: A-Z alone get lower, ASCII spaces alone split
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    count, by = len(words) - size + 1, factors(width + 1, SEED + 1)
    mixed = np.full(count, np.uint64(size)) * by[width]
    for k in range(size):
        mixed += hashes[k : k + count] * by[k]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def minima(found: np.ndarray, hashes: int) -> np.ndarray:
    """The smallest value of each hash a * x + b over a set, by its upper 32 bits."""
    a, b = factors(2 * hashes, SEED)[:hashes, None], factors(2 * hashes, SEED)[hashes:, None]
    low = np.full(hashes, np.iinfo(np.uint64).max)
    for at in range(0, len(found), SHINGLES):
        low = np.minimum(low, (found[None, at : at + SHINGLES] * a + b).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def similar(left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def signed(docs: DataFrame, key: str, text: str, width: int, hashes: int) -> DataFrame:
    """id, n (set size), digest (of the set) and signature of every document; the latter two null if the set is empty."""

    @F.pandas_udf("n long, digest binary, signature binary")
    def signatures(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for texts in parts:
            rows = []
            for value in texts:
                found = shingles(value, width, known)
                if len(found):
                    digest = xxhash.xxh3_128_digest(found.tobytes())
                    rows.append((len(found), digest, minima(found, hashes).tobytes()))
                else:
                    rows.append((0, None, None))
            yield pd.DataFrame(rows, columns=["n", "digest", "signature"])

    return docs.select(F.col(key).alias("id"), signatures(F.col(text)).alias("s")).select("id", "s.*")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough; ``texts`` has id and text of all of them."""

    @F.pandas_udf("boolean")
    def linked(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known, last, found = WordHashes(), None, np.zeros(0, np.uint64)
        for lefts, rights in parts:
            out = []
            for left, right in zip(lefts, rights):
                if left != last:  # rows of one smaller document mostly stand together
                    last, found = left, shingles(left, width, known)
                out.append(similar(found, shingles(right, width, known), percent))
            yield pd.Series(out, dtype=bool)

    larger = texts.select(F.col("id").alias("u"), F.col("text").alias("right"))
    smaller = texts.select(F.col("id").alias("v"), F.col("text").alias("left"))
    both = pairs.join(larger, "u").join(smaller, "v")
    return both.where(linked("left", "right")).select("u", "v")


def band_keys(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, band, key): a row per set and band."""
    size = 4 * rows
    keys = [F.xxhash64(F.lit(k), F.substring("signature", size * k + 1, size)) for k in range(bands)]
    return reps.select("id", F.posexplode(F.array(*keys)).alias("band", "key"))


def dealt(reps: DataFrame, texts: DataFrame, buckets: DataFrame, stars: DataFrame) -> DataFrame:
    """Arrays id, root, minor, band, signature and text: a row per pair of blocks of a bucket with several components.

    Blocks are bounded by their members and by the bytes of their texts, so long texts make more blocks, not larger rows.
    A text beyond that is a block of its own, but for those that a hash deals to the same one.
    """
    weights = texts.groupBy("id").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    placed = buckets.join(stars.select(F.col("u").alias("id"), F.col("v").alias("root")), "id", "left")
    placed = placed.withColumn("root", F.coalesce("root", "id"))
    sizes = placed.join(weights, "id").groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    mixed = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root", "bytes")).alias("most"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.count("*").alias("roots"),
    )
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BYTES)).cast("int")
    mixed = mixed.where("roots > 1").select(
        "key",
        "most.root",
        blocks(F.col("n"), F.col("bytes")).alias("wide"),
        blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("high"),
    )
    met = placed.join(mixed.withColumnRenamed("root", "main"), "key").join(reps.select("id", "signature"), "id").join(texts, "id")
    deal, every = F.xxhash64("id"), lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fields = F.struct("id", "root", "minor", "band", "signature", "text").alias("member")
    other = met.withColumn("minor", F.lit(False)).withColumn("j", F.pmod(deal, "wide").cast("int")).withColumn("i", every("high"))
    minor = met.where("root <> main").withColumn("minor", F.lit(True))
    minor = minor.withColumn("i", F.pmod(deal, "high").cast("int")).withColumn("j", every("wide"))
    columns = ["key", "i", "j", fields]
    groups = other.select(*columns).unionByName(minor.select(*columns)).groupBy("key", "i", "j")
    groups = groups.agg(F.collect_list("member").alias("members"))
    return groups.select(*(F.col(f"members.{c}") for c in ("id", "root", "minor", "band", "signature", "text")))


def crossing_links(
    reps: DataFrame, texts: DataFrame, buckets: DataFrame, stars: DataFrame, width: int, percent: int, bands: int, rows: int
) -> DataFrame:
    """Links (u, v) between members of a bucket that are in different components so far.

    ``buckets`` has key, band and id. In a bucket every member outside its largest component meets all members of other
    components. Both are dealt into blocks, each pair of blocks is one task's work, so no task holds a whole bucket. A
    pair is compared in the first band alone in which it meets, by signature and then by its full sets, unless links
    found before join it. Only links become rows, never the pairs that were compared.
    """
    share = percent / 100
    least = max(0.0, share - ERRORS * float(np.sqrt(share * (1 - share) / (bands * rows))))
    groups = dealt(reps, texts, buckets, stars)

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in batch.itertuples(index=False):
                signatures = np.stack([np.frombuffer(x, "<u4") for x in row.signature])
                ids, roots, minors = (np.asarray(x) for x in (row.id, row.root, row.minor))
                found += joined(ids, roots, minors, signatures, row.text, row.band[0], least, width, percent, bands, known)
            yield pd.DataFrame(found, columns=["u", "v"], dtype=np.int64)

    return groups.mapInPandas(linked, "u long, v long").distinct()


def joined(
    ids: np.ndarray,
    roots: np.ndarray,
    minors: np.ndarray,
    signatures: np.ndarray,
    texts: list[str],
    band: int,
    least: float,
    width: int,
    percent: int,
    bands: int,
    known: WordHashes,
) -> list[tuple[int, int]]:
    """Links that join different components of the members, minors against others; likelier pairs are tried first."""
    pairs = []
    others = np.flatnonzero(~minors)
    small = set(ids[minors].tolist())
    both = np.array([x in small for x in ids[others].tolist()], bool)
    for a in np.flatnonzero(minors).tolist():
        same = signatures[others] == signatures[a]
        score = same.mean(axis=1)
        shared = same.reshape(len(others), bands, -1).all(axis=2)
        ok = (score >= least) & shared[:, band] & (shared.argmax(axis=1) == band) & (roots[others] != roots[a])
        ok &= ~both | (ids[others] > ids[a])  # two minors meet twice
        pairs += [(-x, a, b) for x, b in zip(score[ok].tolist(), others[ok].tolist())]
    parent = {r: r for r in roots.tolist()}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    sets: dict[int, np.ndarray] = {}
    found = []
    for _, a, b in sorted(pairs):
        left, right = top(roots[a].item()), top(roots[b].item())
        if left != right:
            for k in (a, b):
                if k not in sets:
                    sets[k] = shingles(texts[k], width, known)
            if similar(sets[a], sets[b], percent):
                parent[max(left, right)] = min(left, right)
                found.append((max(ids[a], ids[b]).item(), min(ids[a], ids[b]).item()))
    return found


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(``key``, n_shingles, component_id, kept) for every row: its class among documents linked by similar shingle sets.

    Documents with equal sets count once: the smallest id stands for them. A set meets others in buckets, one per band
    of its signature. Each member of a bucket is compared with the bucket's smallest id; members that this leaves in
    different components are compared with one another. A link holds only where the full sets,
    taken from the whole texts again, are similar enough; the classes are the components of these links.

    Texts without words (null, empty) have no shingles and are linked with nothing: their component is their own id.
    Rows that share an id are one document, kept or not together. A row with a null id is linked with nothing and has
    neither a component nor a value of kept. An empty table gives an empty result. Other columns are not looked at.
    """
    hashes = bands * rows
    names = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    signs = stable(signed(names, "id", "text", width, hashes))
    full = signs.where("n > 0 and id is not null")
    reps = stable(full.groupBy("digest").agg(F.min("id").alias("id"), F.first("signature").alias("signature")))

    keys = band_keys(reps, bands, rows)
    met = keys.groupBy("key").agg(F.min("id").alias("v"), F.count("*").alias("count")).where("count > 1")
    buckets = stable(keys.join(met, "key"))
    pairs = stable(buckets.where("id > v").select(F.col("id").alias("u"), "v").distinct())

    involved = stable(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    texts = stable(names.join(involved, "id", "left_semi"))
    links = stable(verified(pairs, texts, width, percent))
    stars = components(links)

    wider = buckets.where("count > 2").select("key", "band", "id")
    more = stable(crossing_links(reps, texts, wider, stars, width, percent, bands, rows))
    if not more.isEmpty():
        stars = components(stars.unionByName(more))

    roots = stars.select(F.col("u").alias("id"), F.col("v").alias("root")).distinct()
    classes = reps.select("id", "digest").join(roots, "id", "left")
    classes = classes.select("digest", F.coalesce("root", "id").alias("component_id"))
    plain = signs.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component_id"))
    linked = full.join(classes, "digest").select("id", "n", "component_id")
    return linked.unionByName(plain).select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
