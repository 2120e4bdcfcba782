"""Quality rules: base counts of a text, and compression bands that reject repetitive or incompressible text."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What separates words, and what counts as a symbol.
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

# (bytes from, lowest ratio, highest ratio) of a whole document; the last row that applies counts. Short texts compress
# badly, so both limits fall with the length. Prose lies well inside, at any of these lengths.
DOCUMENT_BANDS = (
    (0, 0.0, float("inf")),
    (64, 0.30, 1.15),
    (128, 0.42, 1.00),
    (256, 0.33, 0.92),
    (512, 0.30, 0.85),
    (1024, 0.25, 0.80),
    (4096, 0.20, 0.74),
    (32768, 0.15, 0.72),
)
CHUNK_BYTES = 2048
CHUNK_BAND = (0.15, 0.78)
MAX_BAD_CHUNKS = 0.3
LEVEL = 3

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, bad_chunks double, kept boolean"
)


def repeat_words(words: Sequence[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` (a power of two) that the text holds twice or more, the first included.

    Windows are numbered exactly, by doubling: the number of a window is that of the pair of its halves.
    """
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    held, distinct = 1, len(number)
    while held < width:
        if distinct == len(ids):
            return 0  # nothing of this width repeats, so nothing wider does
        pairs = ids[:-held] * distinct + ids[held:]
        held *= 2
        if held < width:
            values, ids = np.unique(pairs, return_inverse=True)
            distinct = len(values)
    _, where, times = np.unique(pairs, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[where] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def dup_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def band(size: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


def rate(
    docs: DataFrame,
    text: str = "text",
    into: str = "quality",
    bands: Sequence[tuple[int, float, float]] = DOCUMENT_BANDS,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    level: int = LEVEL,
) -> DataFrame:
    """Add a struct ``into`` with the counts, the compression ratios and the verdict ``kept`` of each whole text.

    ``ratio`` is compressed over plain bytes of the whole text, ``bad_chunks`` the share of its chunks of
    ``chunk_bytes``, the last of which ends with the text, whose own ratio leaves ``chunk_band``: it finds a repetitive or random part that the rest of a long
    text hides. A text is kept if it passes the base rules, its ratio lies in the band of its length and not too many
    of its chunks are bad.

    A text shorter than a chunk has none: its ``bad_chunks`` are 0 and its own ratio alone decides. Texts are taken whole,
    however long. A null text counts as empty; an empty text has no words, no ratio (null) and fails the base rules. Equal rows get
    equal results. A column of the name ``into`` is replaced, all others stay. No table is too small: no rows, no result.
    """
    limits = tuple(sorted(bands))

    @F.pandas_udf(FIELDS)
    def measured(texts: pd.Series) -> pd.DataFrame:
        press = zstandard.ZstdCompressor(level=level)
        rows = []
        for value in texts:
            data = value.encode() if value else b""
            words = data.split()  # bytes are split at exactly SPACE
            repeated = repeat_words(words)
            failed = len(words) < min_words or 100 * repeated > max_repeat_percent * len(words)
            ratio, bad, kept = None, 0.0, False
            if data:
                ratio = len(press.compress(data)) / len(data)
                starts = [*range(0, len(data) - chunk_bytes + 1, chunk_bytes)]
                if starts and len(data) % chunk_bytes:
                    starts.append(len(data) - chunk_bytes)  # the end of the text lies in a chunk too
                if starts:
                    parts = [len(press.compress(data[k : k + chunk_bytes])) / chunk_bytes for k in starts]
                    bad = sum(not chunk_band[0] <= x <= chunk_band[1] for x in parts) / len(parts)
                low, high = band(len(data), limits)
                kept = not failed and low <= ratio <= high and bad <= max_bad_chunks
            spaces = len(data) - len(data.translate(None, SPACE))
            symbols = len(data) - len(data.translate(None, SYMBOLS))
            chars = (len(value) if value else 0) - spaces
            rows.append((len(words), chars, symbols, dup_lines(data), repeated, failed, ratio, bad, kept))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in FIELDS.split(", ")])

    return docs.withColumn(into, measured(F.col(text)))
