"""Encoded preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.config import IGNORE_LABEL
from textloom.operators.bpe_codec import Tokenizer, encode_several
from textloom.operators.chat import masked, pad_batches

SIDES = ("chosen", "rejected")


def encode_pairs(df: DataFrame, tokenizer: Tokenizer, max_seq_len: int) -> DataFrame:
    """Replace the three texts by ids and labels of both sides; prompt labels are masked."""
    texts = ("prompt", *SIDES)
    keep = [F.col(c) for c in df.columns if c not in texts]
    ids = df.select(*keep, encode_several([F.col(c) for c in texts], tokenizer).alias("_ids"))
    ids = ids.select(*keep, *[F.get("_ids", F.lit(i)).alias(c) for i, c in enumerate(texts)])
    columns = []
    for side in SIDES:
        columns.append(F.slice(F.concat("prompt", side), 1, max_seq_len).alias(f"{side}_input_ids"))
        columns.append(F.slice(F.concat(masked(F.col("prompt")), side), 1, max_seq_len).alias(f"{side}_labels"))
    return ids.select(*keep, *columns)


def pad_pair_batches(df: DataFrame, order: str, batch_size: int, pad_id: int = 0, batch: str = "batch_id", shuffle: str | None = None) -> DataFrame:
    """Pad each of the four arrays to its own longest value within the batch."""
    values = {}
    for side in SIDES:
        values[f"{side}_input_ids"] = pad_id
        values[f"{side}_labels"] = IGNORE_LABEL
    return pad_batches(df, order, batch_size, values, batch, shuffle)
