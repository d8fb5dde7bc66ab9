"""Batch plans over packed sequences for training and evaluation jobs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import unit_hash
from textloom.functions.text import int_div
from textloom.operators.ordering import running_total


# Rounds that mix a sequence number, and steps that bring it back below the number of sequences. Each step
# fails for one number in the root of their count, and never more often than there are numbers outside.
ROUNDS = 6
STEPS = 64


def permutation(number: Column, total: int, key: str) -> Column:
    """Place of ``number`` in a keyed permutation of the numbers below ``total``, from itself alone.

    A number is split into a quotient and a remainder, and these are shifted in turn by a hash of the other one, which can be
    undone step by step and so is a permutation of quotients x remainders. Numbers at or above ``total`` go through it again.
    """
    wide = max(1, math.isqrt(max(0, total - 1)) + 1)
    high = -(-total // wide) if total else 1

    def shift(state: Column, i: Column) -> Column:
        left, right = state["left"], state["right"]
        by_right = F.struct(((left + unit_hash(key, i, right)) % high).alias("left"), right.alias("right"))
        by_left = F.struct(left.alias("left"), ((right + unit_hash(key, i, left)) % wide).alias("right"))
        return F.when(i % 2 == 0, by_right).otherwise(by_left)

    def mixed(x: Column) -> Column:
        start = F.struct(int_div(x, wide).alias("left"), (x % wide).alias("right"))
        rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        return F.aggregate(rounds, start, shift, lambda state: state["left"] * wide + state["right"])

    steps = F.sequence(F.lit(1), F.lit(STEPS))
    place = F.aggregate(steps, mixed(number.cast("bigint")), lambda x, _: F.when(x < total, x).otherwise(mixed(x)))
    lost = F.raise_error(F.lit("no place found for a sequence number")).cast("bigint")
    return F.when((place < total) | number.isNull(), place).otherwise(lost)


def epoch_plan(
    sequences: DataFrame,
    batch_size: int,
    world_size: int = 1,
    shuffle: bool = True,
    seed: int = 1337,
    epoch: int = 0,
    seq_id: str = "seq_id",
    total: int | None = None,
) -> DataFrame:
    """Add ``rank``, ``batch_idx`` and ``slot``; sequences of a short last batch are left out.

    The shuffle is a keyed permutation of the sequence numbers, so any worker can find the place of a sequence alone. With ``total``
    the ids are the numbers from 0 to ``total - 1``, as packing gives them, and the plan needs neither a sort nor a
    shuffle of rows. Otherwise the sequences are numbered first, in the order of their ids.
    """
    if total is None:
        total = sequences.count()
        numbered = running_total(sequences.withColumn("_order", F.col(seq_id).cast("bigint")), "_order", out="_n").drop("_order")
    else:
        numbered = sequences.withColumn("_n", F.col(seq_id).cast("bigint"))
    if shuffle:
        numbered = numbered.withColumn("_n", permutation(F.col("_n"), total, f"{seed}:{epoch}"))
    rank = F.col("_n") % world_size
    within = int_div(F.col("_n"), world_size)
    # sequences of this rank: one more for the ranks below the remainder
    share = int_div(F.lit(total) - rank + (world_size - 1), world_size)
    batch = int_div(within, batch_size)
    return (
        numbered.filter((batch + 1) * batch_size <= share)
        .withColumn("rank", rank)
        .withColumn("batch_idx", batch)
        .withColumn("slot", within % batch_size)
        .drop("_n")
    )


def next_token_pairs(tokens: Column) -> tuple[Column, Column]:
    """Inputs without the last token and labels without the first."""
    length = F.size(tokens) - 1
    return F.slice(tokens, 1, length), F.slice(tokens, 2, length)


def batch_cap(token_budget: int, batch_size: int, seq_len: int) -> int:
    return max(1, math.ceil(token_budget / max(1, batch_size * seq_len)))


def within_token_budget(
    batches: DataFrame, token_budget: int, batch_size: int, seq_len: int, batch: str = "batch_idx"
) -> DataFrame:
    """The first batches whose tokens cover the budget; always at least one."""
    return batches.filter(F.col(batch) < batch_cap(token_budget, batch_size, seq_len))
