"""Encoded chat examples: ids, masked labels, truncation and padding to the longest of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import IGNORE_LABEL
from textloom.functions import chatml
from textloom.functions.text import int_div
from textloom.operators.batches import permutation
from textloom.operators.bpe_codec import Tokenizer, encode_pieces_nested, pieces
from textloom.operators.ordering import running_total
from textloom.session import materialize


def _int_array(*values: int) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def masked(ids: Column) -> Column:
    return F.transform(ids, lambda _: F.lit(IGNORE_LABEL))


def encode_chat(df: DataFrame, tokenizer: Tokenizer, max_seq_len: int, messages: str = "messages") -> DataFrame:
    """Replace ``messages`` by ``input_ids`` and ``labels``, both cut on the right.

    Row-local: the segments of an example are cut into pieces, encoded in one go and re-joined.
    """
    keep = [F.col(c) for c in df.columns if c != messages]
    special = list(tokenizer.special)
    cut = F.transform(
        chatml.segments(F.col(messages)),
        lambda s: F.struct(pieces(s["text"], special).alias("pieces"), s["trainable"].alias("trainable")),
    )
    cut_df = df.select(*keep, F.explode(F.array(cut)).alias("_cut"))
    encoded = cut_df.select(
        *keep,
        encode_pieces_nested(F.flatten(F.transform("_cut", lambda c: c["pieces"])), tokenizer).alias("_ids"),
        F.flatten(
            F.transform("_cut", lambda c: F.transform(c["pieces"], lambda _: c["trainable"]))
        ).alias("_trainable"),
    )
    labels = F.zip_with("_ids", "_trainable", lambda ids, on: F.when(on, ids).otherwise(masked(ids)))
    has_bos, has_eos = tokenizer.bos_id is not None, tokenizer.eos_id is not None
    first_id = [_int_array(tokenizer.bos_id)] if has_bos else []
    first_label = [_int_array(IGNORE_LABEL)] if has_bos else []
    last = [_int_array(tokenizer.eos_id)] if has_eos else []
    example = F.struct(
        F.slice(F.concat(*first_id, F.flatten("_ids"), *last), 1, max_seq_len).alias("input_ids"),
        F.slice(F.concat(*first_label, F.flatten(labels), *last), 1, max_seq_len).alias("labels"),
    )
    return encoded.select(*keep, F.inline(F.array(example)))


def pad_batches(df: DataFrame, order: str, batch_size: int, pad_values: dict[str, int], batch: str = "batch_id", shuffle: str | None = None) -> DataFrame:
    """Number consecutive batches in ``order``, a unique bigint, and pad every array column to its longest value
    within the batch; the last batch may be short. ``shuffle`` is the key of a permutation of the examples.

    Numbers and longest values come from rows of ids and lengths. The examples themselves are moved
    once, to meet the figures of their batch.
    """
    lengths = df.select(order, *[F.size(c).alias(f"_longest_{c}") for c in pad_values])
    lengths = materialize(lengths, "lengths")
    numbered = running_total(lengths, order, out="_n")
    if shuffle is not None:
        numbered = numbered.withColumn("_n", permutation(F.col("_n"), lengths.count(), shuffle))
    numbered = numbered.withColumn(batch, int_div(F.col("_n"), batch_size))
    # a group holds one batch, whose size is fixed
    longest = [F.max(f"_longest_{c}").alias(f"_longest_{c}") for c in pad_values]
    figures = numbered.groupBy(batch).agg(F.collect_list(order).alias(order), *longest).withColumn(order, F.explode(order))
    padded = {
        c: F.concat(F.col(c), F.array_repeat(F.lit(v), F.col(f"_longest_{c}") - F.size(c)))
        for c, v in pad_values.items()
    }
    return df.join(figures, order).withColumns(padded).drop(*[f"_longest_{c}" for c in pad_values])


def pad_chat_batches(df: DataFrame, order: str, batch_size: int, pad_id: int = 0, batch: str = "batch_id", shuffle: str | None = None) -> DataFrame:
    """Padded ``input_ids``, ``labels`` and the ``attention_mask`` that marks real tokens."""
    with_mask = df.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
    return pad_batches(with_mask, order, batch_size, {"input_ids": pad_id, "labels": IGNORE_LABEL, "attention_mask": 0}, batch, shuffle)
