"""Language identification with a string kernel.

A text is the set of its character n-grams of 1 to ``n`` letters (blended spectrum, presence only). The kernel of two
texts is the number of n-grams they share over the geometric mean of their set sizes. Landmark texts span a Nyström
approximation, in which one kernel ridge regression per language is fitted against the rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithic.sources.shared import stable

UNKNOWN = "und"
LONGEST = 3
#: n-grams are told apart by this many bits of their hash.
BITS = 16
#: Bounds of what is learned from: texts over all languages, and landmarks among them.
MAX_TEXTS, MAX_LANDMARKS = 4000, 400
RIDGE = 1e-4
#: Texts scored by one matrix product, and characters hashed at once.
ROWS, CHARS = 64, 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point that is a letter its lower-case form, else 0."""
    table = np.zeros(0x110000, np.uint64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def grams(text: str, longest: int, bits: int) -> Iterator[np.ndarray]:
    """Hashed n-grams of a whole text, in pieces; what is no letter counts as one gap between letters."""
    table, shift, tail = letters(), np.uint64(64 - bits), np.zeros(1, np.uint64)
    for at in range(0, len(text), CHARS):
        codes = table[np.frombuffer(text[at : at + CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)]
        codes = np.concatenate([tail, codes, np.zeros(1, np.uint64)] if at + CHARS >= len(text) else [tail, codes])
        codes = codes[np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])]
        held = codes
        for n in range(1, longest + 1):
            if n > 1:
                held = held[:-1] * MULTIPLIER + codes[n - 1 :]
            mixed = (held + np.uint64(n)) * MULTIPLIER
            mixed ^= mixed >> np.uint64(29)
            # A gap alone says nothing.
            yield ((mixed * MULTIPLIER) >> shift)[held > 0] if n == 1 else (mixed * MULTIPLIER) >> shift
        tail = codes[-max(1, longest - 1) :]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def presence(texts: Sequence[str], longest: int, bits: int) -> np.ndarray:
    """A row of 0 and 1 per text, a column per hashed n-gram."""
    found = np.zeros((len(texts), 1 << bits), np.uint8)
    for row, text in zip(found, texts):
        for part in grams(text, longest, bits):
            row[part] = 1
    return found


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # of an n-gram for a language: landmarks by their coefficients, summed
    longest: int = LONGEST
    bits: int = BITS

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """A row per text, a column per language; the texts hold letters.

        The kernel matrix of texts and landmarks times the coefficients, where the product of landmarks and coefficients
        has been taken already.
        """
        found = presence(texts, self.longest, self.bits)
        return (found.astype(np.float32) @ self.weights) / np.sqrt(found.sum(axis=1, dtype=np.int64))[:, None]


def scaled(packed: np.ndarray) -> np.ndarray:
    """Rows of bitmaps as vectors whose inner products are the kernel."""
    found = np.unpackbits(packed, axis=1).astype(np.float32)
    return found / np.sqrt(found.sum(axis=1, dtype=np.float32))[:, None]


def solve(
    packed: np.ndarray, languages: np.ndarray, max_landmarks: int = MAX_LANDMARKS, ridge: float = RIDGE
) -> tuple[tuple[str, ...], np.ndarray]:
    """Languages and n-gram weights from rows of bitmaps; landmarks are dealt over the languages in the order of rows.

    The bitmaps are unpacked a block at a time, so the memory is that of the landmarks.
    """
    names = tuple(sorted({str(x) for x in languages}))
    each = max(1, max_landmarks // len(names))
    picked = np.concatenate([np.flatnonzero(languages == x)[:each] for x in names])
    marks = scaled(packed[picked])
    blocks = [scaled(packed[at : at + ROWS]) @ marks.T for at in range(0, len(packed), ROWS)]
    kernel = np.concatenate(blocks).astype(np.float64)
    wanted = (languages[:, None] == np.array(names)).astype(np.float64)
    left = kernel.T @ kernel + len(packed) * ridge * kernel[picked] + 1e-8 * len(packed) * np.eye(len(picked))
    coefficients = np.linalg.solve(left, kernel.T @ wanted).astype(np.float32)
    return names, marks.T @ coefficients


def smallest_hashes(rows: DataFrame, key: str, language: str, counts: dict[str, int], each: int) -> DataFrame:
    """(language, key, _hash): the distinct keys of each language's ``each`` smallest hashes, and few more.

    ``counts`` has the rows of each language. A hash below the share that is wanted, and some, is found without ranking
    all rows; a language that gets too few, as its keys repeat, gets a higher share.
    """
    spark, places = rows.sparkSession, rows.select(language, key, F.xxhash64(key).alias("_hash"))
    share = {x: (each + 6 * each**0.5 + 10) / n for x, n in counts.items()}
    while True:
        limits = [(x, min((1 << 63) - 1, int(min(1.0, y) * (1 << 64)) - (1 << 63))) for x, y in share.items()]
        limits = spark.createDataFrame(limits, "_language string, _limit long")
        met = places.join(F.broadcast(limits), F.col(language) == F.col("_language"))
        near = stable(met.where("_hash <= _limit").select(language, key, "_hash").distinct())
        found = dict(map(tuple, near.groupBy(language).count().collect()))
        short = [x for x, y in share.items() if y < 1 and found.get(x, 0) < each]
        if not short:
            return near
        share |= {x: 4 * share[x] for x in short}


def fit(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    max_texts: int = MAX_TEXTS,
    max_landmarks: int = MAX_LANDMARKS,
    longest: int = LONGEST,
    bits: int = BITS,
) -> LanguageModel:
    """Learn languages from rows where ``learn`` holds and text and language are not null.

    Learns from ``max_texts`` texts at most, dealt evenly over the languages and picked by a hash of the key, whole. What
    reaches the driver of each is a bitmap of ``2 ** bits`` bits, so its size is bounded however long the texts are.
    Without rows to learn from the model knows no language.
    """
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(language).isNotNull())
    known = rows.groupBy(language).count().collect()
    if not known:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), longest, bits)
    each = max(1, max_texts // len(known))
    near = smallest_hashes(rows, key, language, dict(map(tuple, known)), each)
    order = Window.partitionBy(language).orderBy("_hash", key)
    chosen = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= each).select(key)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([np.packbits(presence([x], longest, bits)[0]).tobytes() for x in texts], dtype=object)

    # The keys chosen are max_texts at most.
    picked = rows.join(F.broadcast(chosen), key, "left_semi")
    sample = picked.select(language, F.xxhash64(key).alias("_hash"), packed(F.col(text)).alias("_bits"))
    sample = sample.groupBy(language, "_hash").agg(F.min("_bits").alias("_bits"))  # repeated keys count once
    kept = sorted(r for r in sample.collect() if any(r[2]))
    if not kept:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), longest, bits)
    bitmaps = np.stack([np.frombuffer(r[2], np.uint8) for r in kept])
    names, weights = solve(bitmaps, np.array([r[0] for r in kept]), max_landmarks)
    return LanguageModel(names, weights, longest, bits)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", into: str = "language") -> DataFrame:
    """Add a struct ``into`` of ``lang_pred`` and ``score`` (0 to 1) for each whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if the model knows no language.
    Ties go to the language first in code-point order; equal texts get equal results. A column of the name ``into`` is
    replaced, all others stay.
    """
    # Bounded by 2 ** bits n-grams times the languages.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def named(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        names, best = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        values = texts.to_numpy()
        usable = [k for k, x in enumerate(values) if model.languages and has_letter(x)]
        for at in range(0, len(usable), ROWS):
            block = usable[at : at + ROWS]
            scores = model.scores([values[k] for k in block])
            first = scores.argmax(axis=1)
            names[block] = np.array(model.languages, object)[first]
            best[block] = np.clip(scores[np.arange(len(block)), first], 0, 1)
        return pd.DataFrame({"lang_pred": names, "score": best})

    return docs.withColumn(into, named(F.col(text)))
