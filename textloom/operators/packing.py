"""Packing token arrays into fixed-length sequences, splitting them and laying them out in shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.hashing import unit_hash
from textloom.functions.text import int_div
from textloom.operators.ordering import running_total
from textloom.plans.skew import dealt_by_key


def token_offsets(lengths: DataFrame, order: str = "doc_id") -> DataFrame:
    """Add ``offset``, the tokens in all earlier documents, to (order, n_tokens) rows."""
    return running_total(lengths, order, F.col("n_tokens"))


def sequence_count(offsets: DataFrame, seq_len: int, max_sequences: int | None = None) -> int:
    """Full sequences to write. A limit takes effect after the document that reaches it."""
    end = F.col("offset") + F.col("n_tokens")
    total = F.max(end)
    if max_sequences:
        total = F.coalesce(F.min(F.when(int_div(end, seq_len) >= max_sequences, end)), total)
    return (offsets.agg(total).first()[0] or 0) // seq_len


def pack(
    docs: DataFrame,
    seq_len: int,
    order: str = "doc_id",
    tokens: str = "tokens",
    max_sequences: int | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """(seq_id, tokens): the concatenated documents cut every ``seq_len`` tokens.

    Documents may span sequences and a short tail is discarded. With ``max_sequences`` packing
    stops after the document that reaches that number, so a few more sequences may come out.
    ``offsets`` holds (order, n_tokens, offset) of the documents to pack; those of all ``docs`` by
    default. Only these narrow rows are put in order: the token arrays are shuffled once to meet
    their offset, and once more as slices to meet the other slices of their sequence.
    """
    if offsets is None:
        offsets = token_offsets(docs.select(order, F.size(tokens).cast("bigint").alias("n_tokens")), order)
    count = sequence_count(offsets, seq_len, max_sequences)
    cuts = slice_plan(offsets, seq_len, count, order)
    parts = slices(docs, cuts, order, tokens)
    # at most seq_len slices per group, since every slice holds a token
    ordered = F.sort_array(F.collect_list(F.struct("start", "tokens")))
    return parts.groupBy("seq_id").agg(F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens"))


def slice_plan(offsets: DataFrame, seq_len: int, count: int, order: str = "doc_id") -> DataFrame:
    """(order, seq_id, start, from, length): which tokens of a document go where in which sequence. Narrow rows."""
    first = int_div(F.col("offset"), seq_len)
    last = F.least(int_div(F.col("offset") + F.col("n_tokens") - 1, seq_len), F.lit(count - 1))
    used = offsets.filter((F.col("n_tokens") > 0) & (first < F.lit(count)))
    begin = F.greatest(F.col("seq_id") * seq_len, "offset")
    end = F.least((F.col("seq_id") + 1) * seq_len, F.col("offset") + F.col("n_tokens"))
    return used.select(order, "offset", "n_tokens", F.explode(F.sequence(first, last)).alias("seq_id")).select(
        order, "seq_id", (begin - F.col("seq_id") * seq_len).cast("int").alias("start"),
        (begin - F.col("offset")).cast("int").alias("from"), (end - begin).cast("int").alias("length"),
    )


def slices(docs: DataFrame, cuts: DataFrame, order: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """The columns of ``cuts`` other than ``order``, ``from`` and ``length``, and the ``tokens`` of each cut.

    A document's cuts meet it as one list, shorter than the document itself, so its tokens move once and
    are not repeated per cut.
    """
    kept = [c for c in cuts.columns if c not in (order, "from", "length")]
    lists = cuts.groupBy(order).agg(F.collect_list(F.struct(*kept, "from", "length")).alias("_cuts"))
    met = docs.select(order, F.col(tokens).alias("_tokens")).join(dealt_by_key(lists), order)
    part = lambda c: F.struct(*[c[k].alias(k) for k in kept], F.slice("_tokens", c["from"] + 1, c["length"]).alias("tokens"))
    return met.select(F.inline(F.transform("_cuts", part)))


def placed_slices(
    docs: DataFrame,
    offsets: DataFrame,
    seq_len: int,
    count: int,
    shard_sequences: int,
    val_fraction: float = 0.05,
    seed: int = 1337,
    order: str = "doc_id",
) -> DataFrame:
    """(seq_id, start, split, shard_id, seq_in_shard, tokens): slices of the first ``count`` sequences with their
    place in a shard, for a writer that puts them together.

    Split, shard and place are found on narrow rows; token arrays move once to meet their document's cuts
    and once to their shard.
    """
    ids = docs.sparkSession.range(count).withColumnRenamed("id", "seq_id")
    places = place_sequences(ids, shard_sequences, val_fraction, seed)
    return slices(docs, dealt_by_key(slice_plan(offsets, seq_len, count, order)).join(places, "seq_id"), order)


def assembled(parts: DataFrame) -> DataFrame:
    """(seq_id, split, shard_id, seq_in_shard, tokens): whole sequences from ``placed_slices``."""
    ordered = F.sort_array(F.collect_list(F.struct("start", "tokens")))
    whole = F.flatten(F.transform(ordered, lambda p: p["tokens"]))
    return parts.groupBy("seq_id", "split", "shard_id", "seq_in_shard").agg(whole.alias("tokens"))


def split_of(seq_id: Column, val_fraction: float, seed: int) -> Column:
    """``val`` for a seeded share of the sequences, ``train`` for the others."""
    draw = unit_hash(seed, seq_id) % F.lit(1_000_000)
    return F.when(draw < F.lit(round(val_fraction * 1_000_000)), F.lit("val")).otherwise(F.lit("train"))


def place_sequences(
    ids: DataFrame, shard_sequences: int, val_fraction: float = 0.05, seed: int = 1337
) -> DataFrame:
    """(seq_id, split, shard_id, seq_in_shard); validation shards are a quarter the size."""
    split = ids.select("seq_id", split_of(F.col("seq_id"), val_fraction, seed).alias("split"))
    numbered = running_total(split, "seq_id", by=["split"], out="_n")
    size = F.when(F.col("split") == "val", F.lit(max(1, shard_sequences // 4))).otherwise(F.lit(shard_sequences))
    return numbered.select(
        "seq_id", "split", int_div(F.col("_n"), size).alias("shard_id"), (F.col("_n") % size).alias("seq_in_shard")
    )


def assign_shards(
    sequences: DataFrame,
    shard_sequences: int,
    val_fraction: float = 0.05,
    seed: int = 1337,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``, ``shard_id`` and ``seq_in_shard``.

    ``ids`` are the sequence ids when they are known without computing the sequences.
    """
    places = place_sequences(sequences if ids is None else ids, shard_sequences, val_fraction, seed)
    return sequences.join(places, "seq_id")


def shard_statistics(placed: DataFrame) -> DataFrame:
    return placed.groupBy("split", "shard_id").agg(F.count(F.lit(1)).alias("sequences"))
