"""Sharding by a k-d tree over metadata, split at weighted medians that no task has to see whole.

The root holds all rows. A cell that is to become n shards is cut along its widest dimension so that the bytes on both
sides stand as n // 2 to the rest, down to cells of one shard. The cut is found exactly without sorting or moving rows:
every pass counts bytes per cell and interval of values, and goes on inside the interval where the goal falls. Rows with
one value are told apart by a hash and at last by their place in the written table, so a value that a third of all rows
share is cut like any other. The driver sees sums per cell and interval, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lithic.functions.text import as_column
from lithic.operators.keys import ROW_BITS, assign_keys
from lithic.sources.shared import stable

SEED = 11
#: Sums that the driver takes in a pass, and the intervals of a cell: at least and at most.
SUMS, LEAST, MOST = 1 << 19, 8, 4096
#: Bits of the hash that a double holds exactly; bytes of a text that order it.
HASH_BITS, TEXT_BYTES = 52, 6
#: What tells rows with one value apart, in this order, with the range of each.
TIES = {"_hash": float(1 << HASH_BITS), "_part": float(1 << 31), "_row": float(1 << ROW_BITS)}


@dataclass
class Cut:
    """A cell of the tree on its way to being split: ``at`` has the values of the boundary row found so far."""

    cell: int
    shards: int
    dimension: int
    goal: float
    low: float
    high: float
    below: float = 0.0
    at: list[float] = field(default_factory=list)
    inclusive: bool = False

    @property
    def left(self) -> int:
        return self.shards // 2

    def take(self, bins: Sequence[tuple[float, float, float]]) -> None:
        """Go on inside the interval where the goal falls; ``bins`` are (lowest, highest, weight), ascending."""
        for low, high, weight in bins:
            if self.below + weight >= self.goal or high == bins[-1][1]:
                break
            self.below += weight
        self.low, self.high = low, high
        if low == high:
            self.at.append(low)
            if len(self.at) <= len(TIES):
                self.low, self.high = 0.0, list(TIES.values())[len(self.at) - 1]
            else:  # one row: it goes where its larger part lies
                self.inclusive = self.goal - self.below >= weight / 2

    @property
    def found(self) -> bool:
        return len(self.at) > len(TIES)


def as_number(value: Column, numeric: bool) -> Column:
    """A dimension as a double. Text counts by its first bytes, -1 if null; null and non-finite numbers count as 0."""
    if numeric:
        number = value.cast("double")
        return F.when(F.abs(number) < float("inf"), number).otherwise(0.0)
    head = F.rpad(F.hex(F.substring(value.cast("string").cast("binary"), 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def metadata(docs: DataFrame, key: str, text: str, dimensions: Sequence[Column | str]) -> DataFrame:
    """key, size, text_crc32, dims, what breaks ties, and the root cell of every row, written once."""
    columns = [as_column(c) for c in dimensions]
    kinds = docs.select(*(c.alias(f"d{k}") for k, c in enumerate(columns))).schema
    dims = [as_number(c, isinstance(kind.dataType, NumericType)) for c, kind in zip(columns, kinds)]
    spread = F.xxhash64(F.lit(SEED), F.col(key), F.col(text)).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    written = stable(
        docs.select(
            F.col(key).alias("key"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.array(*dims).alias("dims"),
            spread.cast("double").alias("_hash"),
            F.monotonically_increasing_id().alias("_at"),
            F.lit(0).alias("cell"),
        )
    )
    return written.select(
        "*",
        F.shiftright("_at", ROW_BITS).cast("double").alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).cast("double").alias("_row"),
    ).drop("_at")


def extents(rows: DataFrame, count: int) -> dict[int, tuple[float, list[tuple[float, float]]]]:
    """Bytes of each cell, and its lowest and highest value in each dimension."""
    ends = [f(F.col("dims")[k]).alias(f"{f.__name__}{k}") for k in range(count) for f in (F.min, F.max)]
    found = rows.groupBy("cell").agg(F.sum("size").alias("weight"), *ends).collect()
    return {r.cell: (float(r.weight), [(r[f"min{k}"], r[f"max{k}"]) for k in range(count)]) for r in found}


def begin(cell: int, shards: int, weight: float, ends: list, root: list) -> Cut:
    """A cut of the widest dimension, as a share of the width of all rows; the first of equals."""
    width = [(b - a) / (d - c) if d > c else 0.0 for (a, b), (c, d) in zip(ends, root)]
    widest = width.index(max(width))
    return Cut(cell, shards, widest, weight * (shards // 2) / shards, *ends[widest])


def refine(rows: DataFrame, cuts: list[Cut]) -> None:
    """One pass over the rows for all cuts that are not found yet."""
    spark, bins = rows.sparkSession, max(LEAST, min(MOST, SUMS // len(cuts)))
    names = [*TIES]
    table = [(c.cell, c.dimension, len(c.at), c.low, c.high, c.at) for c in cuts]
    # A row per cell, at most one per shard.
    open_cuts = F.broadcast(spark.createDataFrame(table, "cell int, d int, done int, low double, high double, fixed array<double>"))
    value = F.element_at("dims", F.col("d") + 1)
    steps = [value, *map(F.col, names)]
    joined = rows.join(open_cuts, "cell")
    same = [(F.col("done") <= k) | (step == F.get("fixed", F.lit(k))) for k, step in enumerate(steps)]
    now = F.element_at(F.array(*steps), F.col("done") + 1)
    joined = joined.where(reduce(Column.__and__, same)).withColumn("now", now).where("now between low and high")
    share = F.when(F.col("high") > F.col("low"), (F.col("now") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    place = F.least(F.floor(share * bins), F.lit(bins - 1)).alias("bin")
    sums = joined.groupBy("cell", place).agg(F.min("now").alias("a"), F.max("now").alias("b"), F.sum("size").alias("w"))
    found: dict[int, list] = {}
    for r in sums.collect():
        found.setdefault(r.cell, []).append((r.a, r.b, float(r.w)))
    for cut in cuts:
        cut.take(sorted(found[cut.cell]))


def split(rows: DataFrame, cuts: list[Cut]) -> DataFrame:
    """The rows with their cells of the next level, written."""
    table = [(c.cell, c.dimension, c.left, c.inclusive, c.at) for c in cuts]
    ddl = "cell int, d int, left int, inclusive boolean, at array<double>"
    found = F.broadcast(rows.sparkSession.createDataFrame(table, ddl))
    joined = rows.join(found, "cell", "left")
    steps = [F.element_at("dims", F.col("d") + 1), *map(F.col, TIES)]
    before = F.col("inclusive")
    for k in range(len(steps) - 1, -1, -1):
        bound = F.get("at", F.lit(k))
        before = (steps[k] < bound) | ((steps[k] == bound) & before)
    cell = F.when(F.col("left").isNull() | before, F.col("cell")).otherwise(F.col("cell") + F.col("left"))
    return stable(joined.select(*(c for c in rows.columns if c != "cell"), cell.alias("cell")))


def tree(rows: DataFrame, shards: int, count: int) -> tuple[DataFrame, list[Cut]]:
    """The rows with their shard in ``cell``, and all cuts from the root on."""
    cells, root, all_cuts = {0: shards}, None, []
    while any(n > 1 for n in cells.values()):
        ends = extents(rows.where(F.col("cell").isin([c for c, n in cells.items() if n > 1])) if len(cells) < 64 else rows, count)
        root = root or ends.get(0, (0.0, []))[1]
        cuts = [begin(c, n, *ends[c], root) for c, n in cells.items() if n > 1 and c in ends]
        while todo := [c for c in cuts if not c.found]:
            refine(rows, todo)
        if cuts:
            rows = split(rows, cuts)
        cells = {k: m for c, n in cells.items() for k, m in ((c, n // 2 or 1), (c + n // 2, n - n // 2)) if m} if cuts else {}
        all_cuts += cuts
    return rows, all_cuts


def partition(
    docs: DataFrame,
    dimensions: Sequence[Column | str],
    key: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """(``key``, size, text_crc32, law, shard, slot, grown_shard) for every row: shards of near equal bytes.

    ``dimensions`` are columns of metadata, numbers or text; rows that lie together in them go to one shard. Cells are split
    until there are ``shards`` of them, or until they hold about ``target_bytes``. The law is ``bytes``: a cut is off its
    goal by half of one row's size at most, so a shard is off an equal share by less than the largest size.

    A null text has no bytes and the digest of an empty one; every row counts one byte more, so rows without text are
    dealt out too. Slots are gapless from 0 in each shard. Rows that are alike are rows of their own; equal texts lie in
    one shard unless a cut falls among them. Null ids take part. An empty table gives an empty result. Other columns are
    not looked at.
    """
    if not shards and not target_bytes:
        raise ValueError("give shards or target_bytes")
    rows = metadata(docs, key, text, dimensions)
    if not shards:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    rows, _ = tree(rows, shards, len(dimensions))
    counts = {r.cell: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    starts, before = [], 0
    for cell in sorted(counts):
        starts.append((cell, before))
        before += counts[cell]
    numbered = assign_keys(rows, "_place", ["cell", "_hash", "_part", "_row"], start=-1)
    first = F.broadcast(docs.sparkSession.createDataFrame(starts, "cell int, _start long"))  # a row per shard
    return numbered.join(first, "cell").select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("cell").alias("shard"),
        (F.col("_place") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
