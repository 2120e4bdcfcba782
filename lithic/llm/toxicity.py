"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; every other text is unlabelled, toxic or not. With the share of toxic texts
(class prior) p, the risk of a classifier is p * R(positives as positive) plus the risk of the negatives, which is
R(unlabelled as negative) - p * R(positives as negative). The latter can't be below zero; where an estimate is, the
classifier fits the unlabelled texts too closely and the step goes the other way.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of what is learned from.
MAX_TOXIC, MAX_UNLABELLED = 3000, 12000
#: A word counts if this many of these texts hold it, and confirmed and unlabelled texts at rates that lie this many
#: standard errors apart. Rare words, of which long texts are full, tell nothing but noise.
MIN_TEXTS, MIN_ERRORS = 5, 5.0
STEPS, RATE, DECAY = 600, 0.1, 1e-3
#: Slack of the non-negative part before the step is turned, and how much of it is then taken.
SLACK, TURN = 0.0, 1.0
CACHE_WORDS = 300_000
STEMS = (4, 5, 6, 7)
WORD = re.compile(r"\w+")


class Features(dict):
    """32-bit hashes of a word and of its beginnings, which stand for its stem, remembered."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        stems = [f"{word[:n]}-" for n in STEMS if n <= len(word)]
        found = tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in (word, *stems))
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> set[int]:
        """Distinct features of a whole text in lower case."""
        return set().union(*map(self.__getitem__, set(WORD.findall(text.lower())))) if text else set()


def packed(features: set[int]) -> np.ndarray:
    return np.sort(np.fromiter(features, np.uint32, len(features)))


@dataclass(frozen=True)
class ToxicModel:
    weights: dict[int, float]  # by feature
    bias: float

    def score(self, text: str | None, features: Features) -> float:
        margin = self.bias + math.fsum(self.weights[x] for x in features.of(text) & self.weights.keys())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))


def telling(
    toxic: list[np.ndarray], unlabelled: list[np.ndarray], min_texts: int = MIN_TEXTS, min_errors: float = MIN_ERRORS
) -> np.ndarray:
    """Words, as sorted hashes, that confirmed and unlabelled texts hold at clearly different rates."""
    some, n_some = np.unique(np.concatenate([*toxic, np.zeros(0, np.uint32)]), return_counts=True)
    known, n_known = np.unique(np.concatenate([*toxic, *unlabelled, np.zeros(0, np.uint32)]), return_counts=True)
    first = np.zeros(len(known))
    first[np.searchsorted(known, some)] = n_some
    m, n = max(1, len(toxic)), max(1, len(unlabelled))
    joint = n_known / (m + n)
    error = np.sqrt(joint * (1 - joint) * (1 / m + 1 / n)) + 1e-12
    return known[(n_known >= min_texts) & (np.abs(first / m - (n_known - first) / n) >= min_errors * error)]


def train(
    toxic: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = STEPS,
    rate: float = RATE,
    decay: float = DECAY,
    min_texts: int = MIN_TEXTS,
    min_errors: float = MIN_ERRORS,
) -> ToxicModel:
    """A linear classifier with logistic loss, minimising the non-negative risk over all these texts by Adam."""
    known = telling(toxic, unlabelled, min_texts, min_errors)
    size = len(known)
    positive, other = (flat_rows(known, rows) for rows in (toxic, unlabelled))
    weights = np.zeros(size + 1)
    weights[size] = math.log(prior / (1 - prior))  # the last is the bias
    mean, square = np.zeros(size + 1), np.zeros(size + 1)

    def gradient(rows: tuple[np.ndarray, np.ndarray, int], sign: int) -> tuple[float, np.ndarray]:
        """Mean loss of these rows as the class ``sign``, and its gradient."""
        flat, owner, n = rows
        margin = weights[size] + np.bincount(owner, weights[flat], n)
        slope = -sign / (1 + np.exp(np.clip(sign * margin, -30, 30))) / n
        down = np.bincount(flat, slope[owner], size + 1)
        down[size] = slope.sum()
        return float(np.logaddexp(0, -sign * margin).mean()), down

    for step in range(1, steps + 1):
        _, down_right = gradient(positive, 1)
        wrong, down_wrong = gradient(positive, -1)
        loss, down_loss = gradient(other, -1)
        if loss - prior * wrong < -SLACK:
            down = TURN * (prior * down_wrong - down_loss)
        else:
            down = prior * down_right + down_loss - prior * down_wrong
        down[:size] += decay * weights[:size]
        mean = 0.9 * mean + 0.1 * down
        square = 0.999 * square + 0.001 * down * down
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return ToxicModel(dict(zip(known.tolist(), weights[:size].tolist())), float(weights[size]))


def flat_rows(known: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the known features of all rows side by side, the row each belongs to, and the number of rows."""
    kept = [np.flatnonzero(np.isin(known, x, assume_unique=True)) for x in rows]
    owner = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
    return np.concatenate([*kept, np.zeros(0, np.int64)]), owner, len(kept)


def sample(rows: DataFrame, key: str, text: str, most: int) -> list[np.ndarray]:
    """Features of about ``most`` whole texts, picked by a hash of the key; repeated keys count once."""
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(most / n * (1 << 30)))

    @F.pandas_udf("binary")
    def features_of(texts: pd.Series) -> pd.Series:
        features = remembered()
        return pd.Series([packed(features.of(x)).tobytes() for x in texts], dtype=object)

    found = rows.select(F.xxhash64(key).alias("_hash"), features_of(F.col(text)).alias("_features"))
    found = found.groupBy("_hash").agg(F.min("_features").alias("_features")).collect()
    return [np.frombuffer(r[1], np.uint32) for r in sorted(found)]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_unlabelled: int = MAX_UNLABELLED,
) -> ToxicModel:
    """Learn from the confirmed toxic among ``labels`` and from unlabelled ``docs``, of the rows where ``learn`` holds.

    ``learn`` is a condition on ``key``, which both tables have. The class prior is the toxic share of the labels. Learns
    from about ``max_toxic`` and ``max_unlabelled`` whole texts, whose hashed words alone reach the driver. Without a
    confirmed text the model has no weights and scores every text by the prior, 0.01 at least.
    """
    known = labels.where(learn & F.col(toxic).isNotNull()).select(key, toxic)
    share = known.agg(F.avg(F.when(F.col(toxic) == 1, 1.0).otherwise(0.0))).first()[0] or 0.0
    prior = min(0.9, max(0.01, share))
    rows = docs.where(learn).select(key, text)
    confirmed = rows.join(known.where(F.col(toxic) == 1).select(key).distinct(), key, "left_semi")
    some = sample(confirmed, key, text, max_toxic)
    if not some:
        return ToxicModel({}, math.log(prior / (1 - prior)))
    return train(some, sample(rows, key, text, max_unlabelled), prior)


def score(docs: DataFrame, model: ToxicModel, text: str = "text", into: str = "toxic_score") -> DataFrame:
    """Add the score ``into``, the probability (0 to 1) that the whole text is toxic.

    A null or empty text gets the score of a text without words. Equal texts get equal scores. A column of the name
    ``into`` is replaced, all others stay.
    """
    # Bounded by the words of the sample.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        features, model = remembered(), shared.value
        return pd.Series([model.score(x, features) for x in texts], dtype=float)

    return docs.withColumn(into, scored(F.col(text)))


@lru_cache(maxsize=1)
def remembered() -> Features:
    """One memory of words per worker."""
    return Features()
