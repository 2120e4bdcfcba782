"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame operations only.

All words of a mix are dealt out in blocks of equal size: first to the sources, by the highest quotients of their
targets, then those of a source to its shards, by the highest quotients of the shards' words. That gives every shard an
integer quota. Within a shard the documents stand in a seeded order, cut into blocks, and the quota takes whole passes
over the shard and then its first blocks. No block is ever a row, so blocks can be as small as the targets ask for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithic.sources.shared import stable

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: The mix as a share of all words, and how often a source may be used at most.
SHARE, MOST = 1.5, 2
#: Words of a block at most, blocks that the smallest target gets at least (of one word each if need be), and words of a
#: shard on average.
BLOCK, LEAST, SHARD = 16, 16, 1_000_000
#: What separates words (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
SEED = 7


def n_words(text: Column | str) -> Column:
    """Words of a whole text; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def twin(text: Column | str) -> Column:
    """A hash by which rows with one key and different texts are told apart."""
    return F.xxhash64(text)


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``sources``, which has source and source_size, a row per source.

    Sources by code point, the null source last, weigh ``weights``, repeating, and share ``share`` of all words. A target
    stops at ``most`` times its source's size; what is over is shared by weight among the others until none is above.
    The sources that stop are the first ones by size over weight, so one pass over them in this order finds the target
    per weight of the rest.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    named = sources.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    ahead = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(ahead), F.lit(0.0))
    # What a unit of weight gets if all sources ahead of this one stop and this one doesn't.
    each = F.greatest(left, F.lit(0.0)) / F.sum("weight").over(onward)
    stops = F.col("most") < F.col("each") * F.col("weight")
    found = named.withColumn("each", each).withColumn("level", F.max(F.when(~stops, F.col("each"))).over(whole))
    target = F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))
    return found.withColumn("target", target).select(*sources.columns, "target")


def apportion(votes: DataFrame, keys: Sequence[str], seats: str, group: Sequence[str] = ()) -> DataFrame:
    """Add ``quota``: ``seats`` of each group dealt out by the highest quotients votes / 1, 3, 5, ... (Sainte-Laguë).

    ``votes`` has ``keys``, ``votes`` and the ``seats`` of the row's group. Every candidate gets outright the seats that
    its share, lowered by what rounding could do over all candidates, surely wins; the quotients of the seats that are
    then in doubt, some three per candidate, are ranked. Ties go to more votes, then to the smaller key.
    """
    of_group = Window.partitionBy(*group)
    share = F.when(F.col("_all") > 0, F.col("votes") / F.col("_all")).otherwise(0.0)
    counted = votes.withColumn("_all", F.sum("votes").over(of_group)).withColumn("_n", F.count("*").over(of_group))
    slack = F.ceil(share * F.col("_n") / 2) + 1
    counted = counted.withColumn("_sure", F.greatest(F.lit(0), F.floor(share * F.col(seats)) - slack).cast("long"))
    counted = counted.withColumn("_last", (F.ceil(share * F.col(seats)) + slack).cast("long"))
    counted = counted.withColumn("_open", F.col(seats) - F.sum("_sure").over(of_group))
    doubt = counted.withColumn("_seat", F.explode(F.sequence(F.col("_sure"), F.col("_last"))))
    best = Window.partitionBy(*group).orderBy(
        (F.col("votes") / (2 * F.col("_seat") + 1)).desc(), F.col("votes").desc(), *keys
    )
    won = doubt.withColumn("_rank", F.row_number().over(best)).withColumn(
        "_won", ((F.col("_rank") <= F.col("_open")) & (F.col("votes") > 0)).cast("long")
    )
    return won.groupBy(*keys).agg((F.first("_sure") + F.sum("_won")).alias("quota"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
    keep_twin: bool = False,
) -> DataFrame:
    """(``key``, size, source_size, target, taken, first) for every row: the words that the mix takes of it.

    ``taken`` counts repeated passes, ``most`` times the size at most; the pass that ends within a document takes its
    ``first`` words (0 if none does). A source takes its target but for about a block per shard; blocks are
    ``block`` words, or fewer where the smallest target asks for it. A text that is null or
    has no word takes no part, with 0 taken; a null source is a source of its own; rows that are alike, also in the key,
    share the outcome of their place in the seeded order; ``keep_twin`` adds the hash of the text. Reruns agree, whatever the partitioning. An empty table gives
    an empty result.
    """
    sized = stable(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            n_words(text).alias("size"),
            twin(text).alias("twin"),
        )
    )
    names = ["unnamed", "name"]
    sized = sized.withColumn("unnamed", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    sizes = sized.groupBy("source", *names).agg(F.sum("size").alias("source_size"))
    per_source = stable(targets(sizes, weights, share, most))
    smallest = per_source.where("target > 0").agg(F.min("target")).first()[0]
    block = max(1, min(block, int((smallest or 0) // LEAST)))
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    votes = per_source.select(*names, F.col("target").alias("votes"), blocks.alias("seats"))
    seats = apportion(votes, names, "seats").withColumnRenamed("quota", "seats")

    # A shard of the largest source is as small as one of any other.
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard))
    order = F.xxhash64(F.lit(seed), F.col("key"), F.col("twin"))
    placed = sized.drop("source").join(per_source, names).withColumn("order", order)
    placed = placed.withColumn("shard", F.pmod(F.col("order"), shards))
    places = [*names, "shard"]
    held = placed.groupBy(*places).agg(F.sum("size").alias("votes")).join(seats, names)
    held = stable(held)
    quotas = apportion(held, places, "seats", names)
    quotas = held.select(*places, F.col("votes").alias("shard_size")).join(quotas, places)

    line = Window.partitionBy(*places).orderBy("order", "key", "twin").rowsBetween(Window.unboundedPreceding, -1)
    laid = placed.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0)))
    words = F.least(F.col("quota") * block, F.col("shard_size") * most)
    passes = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(0)
    rest = words - F.col("passes") * F.col("shard_size")
    first = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return (
        laid.join(quotas, places)
        .withColumn("passes", passes.cast("long"))
        .withColumn("first", first.cast("long"))
        .select(
            F.col("key").alias(key),
            "size",
            "source_size",
            "target",
            (F.col("passes") * F.col("size") + F.col("first")).alias("taken"),
            "first",
            *(["twin"] if keep_twin else []),
        )
    )
