"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more rows than one task should take, however large the table is.
HOT_ROWS = 1_000_000


def hot_keys(sizes: DataFrame, key: str, task_rows: int = HOT_ROWS) -> DataFrame | None:
    """(key, parts) of the keys with more than ``task_rows`` rows, or None when there are none.

    ``sizes`` is a written table with the row count ``n`` of each key. The counts add up to the rows of
    the table, so there are fewer than rows / task_rows such keys: 100,000 for 10**11 rows.
    """
    hot = sizes.filter(F.col("n") > task_rows).select(key, F.ceil(F.col("n") / task_rows).cast("bigint").alias("_parts"))
    return None if hot.isEmpty() else hot


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def dealt_by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join that deals both sides by the key.

    Spark takes exploded rows for no more than the file they come from, and would send them whole through the driver.
    """
    return df.hint("merge")


def skew_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    hot: DataFrame | None,
    how: str = "inner",
    condition: Column | None = None,
    exploded: bool = False,
) -> DataFrame:
    """Join ``big`` with ``small``, which has a bounded number of rows per key.

    Rows of a hot key are dealt over several tasks, and the few matching rows of ``small`` are copied
    to each of them. All other rows take the ordinary join. ``condition`` filters inner matches.
    ``exploded`` says that ``big`` holds many rows for one of its table; it is then dealt, see ``dealt_by_key``.
    """
    whole = dealt_by_key if exploded else (lambda df: df)
    if hot is None:
        out = whole(big).join(small, key, how)
    else:
        # at most rows / task_rows keys, see hot_keys
        hot = F.broadcast(hot)
        parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
        dealt = big.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*big.columns), parts)).drop("_parts")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
        copied = small.join(hot, key, "left").withColumn("_part", every).drop("_parts")
        out = whole(dealt).join(copied, [key, "_part"], how).drop("_part")
    return out if condition is None else out.filter(condition)


# Rows of a table of a few numbers a row that may be sent to every task.
BROADCAST_ROWS = 2_000_000


def join_narrow(big: DataFrame, small: DataFrame, on: list[str], rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join with a table of a few numbers per key. It goes to every task if it has at most ``rows`` rows; beyond
    that both sides are dealt by the key, and ``small`` is hashed, so that ``big`` is not sorted."""
    return big.join(F.broadcast(small) if small.count() <= rows else small.hint("shuffle_hash"), on)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
