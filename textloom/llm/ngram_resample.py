"""Drawing the documents that look most like a target, by importance weights of hashed n-grams.

A 256-byte table lower-cases A-Z and blanks separators in the UTF-8 bytes, ``bytes.split`` yields the
words, and the crc32 of a run of words is extended by one word at a time: the crc of the shorter run
seeds the next one. Runs of 1 to ``LONGEST`` words fall into ``BUCKETS`` buckets. Bucket counts of all
documents and of all target texts, kept in Counters per task and added up by Spark, give each bucket a
gain; a document's weight is the sum over its runs. Gumbel noise drawn from the document's id turns the
highest scores into a draw without replacement with probabilities proportional to the weights.

The draw needs no sort of all documents. Histograms of the integer scores, with a bounded number of bins,
narrow down the score of the last drawn document, and only documents from there on are numbered. The
counts behind the gains cover all texts; two bucket tables are all that passes through the driver.

Defined results: null texts have no words. A null id draws its noise from an empty string. Equal scores
go to the smaller id (no id first), then to fewer runs; rows equal in all of that take consecutive
places. Every row gives one row; empty tables give none, and an empty target counts zero everywhere.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.ordering import running_total
from textloom.session import materialize

BUCKETS = 10_000
LONGEST = 3
SEED = 42
LEAST_WORDS = 20
PERCENT = 5
HISTOGRAM_BINS = 1 << 14
# words whose hashes are held at once; longer texts go in pieces
PIECE_WORDS = 1 << 18
NORMAL = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
SCORED = "n_features bigint, weight bigint, score bigint, enough boolean"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


def buckets_of(words: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket of every run of 1 to ``longest`` consecutive words joined by a blank."""
    for first in range(0, len(words), PIECE_WORDS):
        piece = words[first : first + PIECE_WORDS + longest - 1]
        starts = min(PIECE_WORDS, len(words) - first)
        crcs = list(map(crc32, piece[:starts]))
        spaced = [b" " + word for word in piece]
        for n in range(1, longest + 1):
            yield np.array(crcs, np.int64) % buckets
            # word n follows the run that starts n words before it
            crcs = list(map(crc32, spaced[n : n + starts], crcs))


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for found in buckets_of(words_of(text)):
                    counter.update(found.tolist())
        arrays = [pa.array(list(part), pa.int64()) for part in (counter.keys(), counter.values())]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    # at most one row per bucket
    rows, out = counted.toArrow(), np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Milli-nats by which a bucket is more frequent in the target, both smoothed by one a bucket."""
    all_s, all_t = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log(((t + 1) * all_s) / ((s + 1) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64
    )


def noise(doc_id: int | None) -> int:
    """Milli-nats of Gumbel noise that belong to an id."""
    h = int(sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    # as a whole number the sum with the weight may be floored part by part
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, enough) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, weights, enough = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words, n, weight = words_of(text), 0, 0
                for found in buckets_of(words):
                    n += len(found)
                    weight += int(shared.value[found].sum())
                features.append(n)
                weights.append(weight)
                enough.append(len(words) >= least_words)
            score = [w + noise(i) for w, i in zip(weights, batch.column(0).to_pylist())]
            longs = [pa.array(c, pa.int64()) for c in (features, weights, score)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(enough, pa.bool_())], ["doc_id", "n_features", "weight", "score", "enough"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, f"doc_id bigint, {SCORED}")


def kth_highest(rows: DataFrame, column: str, k: int, bins: int = HISTOGRAM_BINS) -> int:
    """The k-th highest value of a bigint column that has at least k rows."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) // bins + 1
        at = F.floor((F.col(column) - low) / width).cast("bigint").alias("at")
        inside = rows.filter(F.col(column).between(low, high)).groupBy(at).count()
        # at most ``bins`` rows
        for bin_, n in sorted(inside.collect(), reverse=True):
            if k <= n:
                low, high = low + bin_ * width, min(high, low + (bin_ + 1) * width - 1)
                break
            k -= n
    return low


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of (doc_id, text); rows that are not drawn
    have no rank. ``target`` has a column ``text``."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = materialize(scores(docs, gain, least_words), "scores")
    able = scored.filter("enough")
    k = able.count() * percent // 100
    unranked = F.lit(None).cast("bigint").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, unranked)
    lowest = kth_highest(able, "score", k)
    near = F.col("enough") & (F.col("score") >= lowest)
    groups = able.filter(F.col("score") >= lowest).groupBy(*columns).count().withColumn("falling", -F.col("score"))
    placed = running_total(materialize(groups, "drawn"), "falling", F.col("count"), tie=["doc_id", "n_features", "weight"])
    places = F.explode(F.sequence(F.col("offset") + 1, F.col("offset") + F.col("count")))
    drawn = placed.select(*columns, places.alias("place"))
    ranked = drawn.select(*columns, F.when(F.col("place") <= k, F.col("place")).alias("rank"))
    return scored.filter(~near).select(*columns, unranked).unionByName(ranked)
