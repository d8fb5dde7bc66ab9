"""Pseudo-random token sequences that stand in for shards in trial runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_ROWS, VAL_ROWS, VAL_SEED_SHIFT = 4096, 512, 10_000


def synthetic_tokens(spark: SparkSession, vocab_size: int, seq_len: int, length: int, seed: int) -> DataFrame:
    """(seq_id, tokens): row ``i`` depends on ``seed + i`` only."""
    start = F.col("id") + F.lit(seed)
    tokens = F.transform(
        F.sequence(F.lit(0), F.lit(seq_len - 1)),
        lambda p: F.pmod(F.xxhash64(start, p), F.lit(vocab_size)).cast("int"),
    )
    return spark.range(length).select(F.col("id").alias("seq_id"), tokens.alias("tokens"))


def synthetic_splits(spark: SparkSession, vocab_size: int, seq_len: int, seed: int) -> tuple[DataFrame, DataFrame]:
    train = synthetic_tokens(spark, vocab_size, seq_len, TRAIN_ROWS, seed)
    return train, synthetic_tokens(spark, vocab_size, seq_len, VAL_ROWS, seed + VAL_SEED_SHIFT)
