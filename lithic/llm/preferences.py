"""Preference formatting: the longest common prefix of two conversations as a prompt, and what follows as completions.

A pair is kept as rows, one per turn, so no conversation has to fit into one row or task. ``examples`` puts the rows of
each pair together where one text per pair is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithic.operators.keys import assign_keys

# Fixed values of the format that is written.
START, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"
ASSISTANT = "assistant"


def numbered(turns: DataFrame) -> DataFrame:
    """(pair_id, place, role, text): turns (pair_id, turn, role, text) by their place from 0 in the conversation.

    Turns go by their number, then by role and text; a null role is a user's, a null text empty. Rows without a pair id
    or a turn number take no part. All turns are numbered in one order, which splits a long conversation over tasks.
    """
    rows = turns.where("pair_id is not null and turn is not null").select(
        "pair_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    placed = assign_keys(rows, "_n", ["pair_id", "turn", "role", "text"])
    first = placed.groupBy("pair_id").agg(F.min("_n").alias("_first"))
    return placed.join(first, "pair_id").select("pair_id", (F.col("_n") - F.col("_first")).alias("place"), "role", "text")


def plain(text: Column) -> Column:
    """Text in which no mark of the format can stand."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def aligned(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, place, role, head, body, trained): rows of prompt, chosen and rejected for every pair.

    Both tables have pair_id, turn, role and text. The prompt holds the turns that both conversations begin with, once;
    each completion the turns that follow in its own. ``head`` and ``body`` are what is written for a turn. Only the body
    of an assistant's turn in a completion is trained on, all else is masked. Pairs of which a side has no turn are left
    out; of two equal conversations there is only a prompt.
    """
    left, right = numbered(chosen), numbered(rejected)
    both = left.join(right.withColumnsRenamed({"role": "_role", "text": "_text"}), ["pair_id", "place"], "full")
    differs = ~(F.col("role").eqNullSafe(F.col("_role")) & F.col("text").eqNullSafe(F.col("_text")))
    # Places that one side alone has differ, so the prefix ends with the shorter side.
    ends = both.groupBy("pair_id").agg(
        F.min(F.when(differs, F.col("place"))).alias("ends"),
        F.count("role").alias("_left"),
        F.count("_role").alias("_right"),
    )
    ends = ends.where("_left > 0 and _right > 0").select("pair_id", "ends")
    prompt = F.col("ends").isNull() | (F.col("place") < F.col("ends"))
    first = left.join(ends, "pair_id").withColumn("part", F.when(prompt, "prompt").otherwise("chosen"))
    second = right.join(ends, "pair_id").where(~prompt).withColumn("part", F.lit("rejected"))
    return first.unionByName(second).select(
        "pair_id",
        "part",
        "place",
        "role",
        F.concat(F.lit(START), plain(F.col("role")), F.lit(BREAK)).alias("head"),
        F.concat(plain(F.col("text")), F.lit(END)).alias("body"),
        ((F.col("part") != "prompt") & (F.col("role") == ASSISTANT)).alias("trained"),
    )


def examples(rows: DataFrame) -> DataFrame:
    """(pair_id, prompt, chosen, rejected): each pair's texts, the completions as arrays of (text, trained) pieces.

    A pair's turns are gathered into one row here, as a trainer reads it.
    """
    pieces = F.array(
        F.struct(F.col("head").alias("text"), F.lit(False).alias("trained")),
        F.struct(F.col("body").alias("text"), F.col("trained").alias("trained")),
    )
    turn = F.struct("place", pieces.alias("pieces"))

    def of(part: str) -> Column:
        turns = F.array_sort(F.collect_list(F.when(F.col("part") == part, turn)))
        return F.flatten(F.transform(turns, lambda x: x["pieces"])).alias(part)

    joined = rows.groupBy("pair_id").agg(*map(of, ("prompt", "chosen", "rejected")))
    return joined.withColumn("prompt", F.array_join(F.transform("prompt", lambda x: x["text"]), ""))


def with_neighbours_answer(turns: DataFrame, conversation: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns made from conversations: rejected ends with the neighbour's last answer.

    Conversations with an answer of an assistant are numbered by their id from 0. The neighbours are 0 and 1, 2 and 3 and
    so on; where one is left over its neighbour is the one before it. So every answered conversation makes a pair, unless
    it is the only one. Chosen has all of its turns, rejected those before its last answer and then the neighbour's.
    Conversations without an answer make no pair, and rows without an id or a turn number take no part. Repeated rows
    are turns of their own. An empty table gives empty ones; other columns are not looked at.
    """
    named = turns.select(F.col(conversation).alias("pair_id"), "turn", "role", "text")
    named = named.where("pair_id is not null and turn is not null")
    last = F.max(F.struct("turn", "text"))
    answers = named.where(F.col("role") == ASSISTANT).groupBy("pair_id").agg(last.alias("last"))
    placed = assign_keys(answers.select("pair_id", "last.turn", "last.text"), "n", ["pair_id"], start=-1)
    highest = placed.agg(F.max("n")).first()[0] or 0
    lone = (F.col("n") == highest) & (F.col("n") % 2 == 0)
    of = placed.select("pair_id", "turn", F.when(lone, F.col("n") - 1).otherwise(F.col("n").bitwiseXOR(1)).alias("n"))
    ends = of.join(placed.select("n", F.col("text").alias("answer")), "n").select("pair_id", F.col("turn").alias("end"), "answer")
    cut = named.join(ends, "pair_id")
    chosen = cut.select("pair_id", "turn", "role", "text")
    before = cut.where("turn < end").select("pair_id", "turn", "role", "text")
    answer = ends.select("pair_id", F.col("end").alias("turn"), F.lit(ASSISTANT).alias("role"), F.col("answer").alias("text"))
    return chosen, before.unionByName(answer)
