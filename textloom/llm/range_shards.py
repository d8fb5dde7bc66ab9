"""Shards of near equal bytes: range partitioning by sampled splitters.

Records are ordered by (hash of the text, doc_id), so equal texts lie side by side. Splitters come from
a sample in which a record's chance follows its size: each record draws an exponential waiting time with
its size as rate, and the earliest ones are taken. Quantiles of the sorted sample cut the key space into
ranges. Ranges that still hold more than ``OVERFULL`` times the mean are sampled again and cut further,
also inside a run of equal texts, because the id is part of the key.

Ranges are small enough to be sorted by one task each. Totals per range, a few thousand rows, give the
bytes before each range, and a window inside the range the bytes before each record. The record's middle
then decides its shard, so a shard's bytes differ from the mean by at most one record.

Defined results: a null text has no bytes, size 1 and checksum 0; repeated rows keep one slot each; an
empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.session import materialize

SHARDS = 16
LEAST_RANGES, MOST_RANGES = 256, 16_384
ROWS_PER_RANGE = 500_000
DRAWS_PER_RANGE = 16
OVERFULL = 2.0
LEVELS = 4

Splitter = tuple[int, int]


def range_numbers(keys: np.ndarray, ids: np.ndarray, splitters: list[Splitter]) -> np.ndarray:
    """How many splitters are at or before each (key, id)."""
    cut_keys = np.array([k for k, _ in splitters], np.int64)
    cut_ids = np.array([i for _, i in splitters], np.int64)
    low, high = np.searchsorted(cut_keys, keys, "left"), np.searchsorted(cut_keys, keys, "right")
    out = low.copy()
    tied = np.flatnonzero(low < high)
    for start in np.unique(low[tied]):
        rows = tied[low[tied] == start]
        stop = high[rows[0]]
        out[rows] = start + np.searchsorted(cut_ids[start:stop], ids[rows], "right")
    return out


def with_range(rows: DataFrame, splitters: list[Splitter]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(splitters)  # at most MOST_RANGES at each level

    def number(key: pa.Array, doc_id: pa.Array) -> pa.Array:
        ids = np.asarray(doc_id.fill_null(-(1 << 63)))
        return pa.array(range_numbers(np.asarray(key), ids, shared.value).astype(np.int32))

    number.__annotations__ = {"key": pa.Array, "doc_id": pa.Array, "return": pa.Array}
    return rows.withColumn("range", F.arrow_udf(number, "int")("key", "doc_id"))


def draw(rows: DataFrame, n: int) -> list[Splitter]:
    """``n`` records drawn by size, as sorted keys; bounded by ``MOST_RANGES * DRAWS_PER_RANGE``.

    A record waits less than ``2 n / total`` with a chance near ``2 n * size / total``, so about twice as many
    as are wanted pass that bar and are sorted. If a few records hold most of the bytes fewer may pass; then
    the bar goes up.
    """
    uniform = (F.pmod(F.xxhash64("doc_id", "key", F.lit("draw")), F.lit(1 << 40)) + 1) / float(1 << 40)
    waiting = rows.select("key", "doc_id", (-F.log(uniform) / F.col("size")).alias("wait"))
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    bar = 2.0 * n / total if count else 0.0
    while count > n and waiting.filter(F.col("wait") <= bar).count() < n:
        bar *= 4
    early = waiting.filter(F.col("wait") <= bar) if count > n else waiting
    picked = early.orderBy("wait", "key", "doc_id").limit(n).toArrow()
    ids = picked.column("doc_id").combine_chunks().fill_null(-(1 << 63)).to_pylist()
    return sorted(zip(picked.column("key").to_pylist(), ids))


def quantiles(sample: list[Splitter], parts: int) -> list[Splitter]:
    return [sample[i * len(sample) // parts] for i in range(1, parts) if i * len(sample) // parts < len(sample)]


def ranged(rows: DataFrame, n_rows: int) -> DataFrame:
    """Add the number of the range; no range is overfull unless a single key fills it."""
    parts = int(min(MOST_RANGES, max(LEAST_RANGES, n_rows // ROWS_PER_RANGE)))
    splitters = sorted(set(quantiles(draw(rows, parts * DRAWS_PER_RANGE), parts)))
    for _ in range(LEVELS):
        placed = with_range(rows, splitters)
        totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        mean = totals.agg(F.sum("bytes")).first()[0] / parts
        # the bytes add up to parts * mean, so fewer than parts / OVERFULL ranges can be overfull
        full = {r["range"]: r["bytes"] for r in totals.filter((F.col("bytes") > OVERFULL * mean) & (F.col("n") > 1)).collect()}
        if not full:
            break
        pieces = sum(int(b / mean) + 1 for b in full.values())
        inside = placed.filter(F.col("range").isin(list(full)))
        by_range: dict[int, list[Splitter]] = {}
        for key in draw(inside, pieces * DRAWS_PER_RANGE):
            by_range.setdefault(bisect_right(splitters, key), []).append(key)
        more = {c for r, keys in by_range.items() for c in quantiles(keys, int(full.get(r, 0) / mean) + 1)}
        if more <= set(splitters):
            break  # one key alone fills what is left
        splitters = sorted({*splitters, *more})
    return with_range(rows, splitters)


def shard_documents(docs: DataFrame, shards: int = SHARDS, carry: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, range, shard, slot) for each row of ``docs`` (doc_id, text).

    With ``carry`` a further column ``row`` holds the whole row of ``docs``.
    """
    extra = ["row"] if carry else []
    rows = docs.withColumn("row", F.struct(*docs.columns)) if carry else docs
    rows = rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
        *extra,
    )
    rows = materialize(rows, "sizes")
    n_rows, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("range"), F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"), *extra)
    placed = materialize(ranged(rows, n_rows), "ranged")
    totals = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("range").orderBy("key", "doc_id", "size", "text_crc32")
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("end", F.sum("size").over(up_to)).withColumn("nth", F.row_number().over(inside))
    # one row per range
    numbered = numbered.join(F.broadcast(starts), "range")
    # twice the middle of the record, so that all stays in whole numbers
    middle = (F.col("bytes_before") + F.col("end")) * 2 - F.col("size")
    shard = F.least(F.floor(middle.cast("decimal(38,0)") * shards / (2 * total)), F.lit(shards - 1)).cast("int")
    numbered = numbered.select(
        "doc_id", "size", "text_crc32", "range", shard.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("nth"), *extra
    )
    numbered = materialize(numbered, "numbered")
    first = numbered.groupBy("shard").agg(F.min("nth").alias("first_row"))
    # one row per shard
    out = numbered.join(F.broadcast(first), "shard")
    return out.select("doc_id", "size", "text_crc32", "range", "shard", (F.col("nth") - F.col("first_row")).cast("bigint").alias("slot"), *extra)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the records below ``path``, one folder per shard, rows of a shard in slot order.

    Rows travel with their place, so missing and repeated ids keep their rows. Tasks write whole ranges, so a
    shard is written by many of them. Columns of ``docs`` named ``range``, ``shard`` or ``slot`` give way to those of the place.
    """
    placed = shard_documents(docs, shards, carry=True)
    kept = [F.col("row")[name].alias(name) for name in docs.columns if name not in ("range", "shard", "slot")]
    rows = placed.select(*kept, "range", "shard", "slot")
    spread = rows.repartition("shard", "range").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
