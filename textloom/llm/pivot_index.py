"""Exact top-k by inner product over a pivot-distance index.

Vectors are quantised to whole numbers ``floor(64 * x)``. One more component brings all of them to the
same length, so a larger product is a smaller distance, and the triangle inequality gives bounds.

**Index.** Pivots come from a bounded sample. A vector's key is its nearest pivot and its distance to it,
cut into rings. A table of at most ``PIVOTS * RINGS`` rows holds each annulus' count and range of distances.

**Search.** For a query, annuli are sorted by the largest product they can hold: with ``d`` the query's
distance to the pivot, no member is nearer than the distance from ``d`` to the annulus. It expands them in
rounds: first as many as hold k vectors, then the next ``SECOND`` annuli, then all others, each time only
those whose bound reaches the k-th score so far. Annuli behind that bound hold no result, so the search is
exact. Products of whole numbers are exact in double precision.

Defined results: null, empty and non-finite vectors take no part; ties go to the smaller id; rows with
one id are one vector; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.posting_lists import lifted, squared
from textloom.llm.vectors import kth_scores, matrix, ranked, score_lists, usable
from textloom.session import materialize

SCALE = 64
SAMPLE = 8192
PIVOTS, RINGS = 64, 16
SECOND = 24
TOP = 20
# slack of the bounds against rounding of distances
SLACK = 1e-6


def pivots_of(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Far apart points of the sample, each the farthest from those before, then moved to their cells' means."""
    chosen = [0]
    apart = squared(sample, sample[:1])[:, 0]
    while len(chosen) < min(count, len(sample)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, squared(sample, sample[chosen[-1:]])[:, 0])
    points = sample[chosen]
    for _ in range(3):
        cell = squared(sample, points).argmin(axis=1)
        points = np.stack([sample[cell == i].mean(axis=0) if (cell == i).any() else points[i] for i in range(len(points))])
    return points


def _keys(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, length = shared.value
        for batch in batches:
            apart = squared(lifted(matrix(batch.column(1)), length), points)
            pivot = apart.argmin(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            radius = np.sqrt(apart[np.arange(len(pivot)), pivot])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pivot), pa.array(radius)], ["vec_id", "vec", "pivot", "radius"]
            )

    return run


def _annuli(shared):
    """Row-wise: the annuli to expand for a query in the range of ``steps``, above the score so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, length, table, k, first, last = shared.value
        pivot, low, high, count, name = (table[c] for c in ("pivot", "low", "high", "n", "list"))
        for batch in batches:
            q = matrix(batch.column(1))
            least = np.asarray(batch.column(2), np.float64)
            apart = np.sqrt(squared(np.pad(q, ((0, 0), (0, 1))), points))[:, pivot]
            gap = np.maximum(np.maximum(low - apart, apart - high), 0.0)
            bound = ((q**2).sum(axis=1)[:, None] + length - gap**2) / 2
            bound += SLACK * (1 + np.abs(bound))
            order = np.argsort(-bound, axis=1, kind="stable")
            # how many annuli, best first, hold k vectors besides the query
            held = np.cumsum(count[order], axis=1)
            start = 1 + (held < k + 1).sum(axis=1)
            place = np.argsort(order, axis=1, kind="stable")
            lower = 0 if first is None else start + first
            upper = start if first is None else (np.inf if last is None else start + last)
            pick = (place >= np.reshape(lower, (-1, 1))) & (place < np.reshape(upper, (-1, 1))) & (bound >= least[:, None])
            row, which = np.nonzero(pick)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(name[which]), *(batch.column(i).take(pa.array(row)) for i in (1, 2))],
                ["query_id", "list", "q", "least"],
            )

    return run


def search(table: DataFrame, k: int = TOP, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every``, the k others
    with the largest product. ``table`` has ``vec_id`` and ``embedding``."""
    spark = table.sparkSession
    vectors = materialize(usable(table, lambda x: F.floor(x * SCALE).cast("double")), "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    n, length = vectors.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    sample = vectors.orderBy(F.xxhash64("vec_id", F.lit("pivots")), "vec_id").limit(SAMPLE)
    points = pivots_of(lifted(matrix(sample.select("vec").toArrow().column("vec")), length))
    keyed = vectors.mapInArrow(_keys(spark.sparkContext.broadcast((points, length))), "vec_id bigint, vec array<double>, pivot bigint, radius double")
    keyed = materialize(keyed, "keyed")
    widest = keyed.agg(F.max("radius")).first()[0]
    ring = F.least(F.floor(F.col("radius") / (widest / RINGS + 1e-12)), F.lit(RINGS - 1))
    postings = keyed.withColumn("list", F.col("pivot") * RINGS + ring)
    stats = postings.groupBy("list").agg(
        F.first("pivot").alias("pivot"), F.min("radius").alias("low"), F.max("radius").alias("high"), F.count(F.lit(1)).alias("n")
    )
    # at most PIVOTS * RINGS rows
    annuli = {name: np.asarray(column) for name, column in zip(stats.columns, stats.orderBy("list").toArrow().columns)}
    postings = postings.select("list", "vec_id", "vec")
    queries = vectors.filter(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q"))

    best = None
    for first, last in ((None, None), (0, SECOND), (SECOND, None)):
        if best is None:
            asking = queries.withColumn("least", F.lit(float("-inf")))
        else:
            asking = queries.join(kth_scores(best, k), "query_id", "left").na.fill(float("-inf"), ["least"])
        shared = spark.sparkContext.broadcast((points, length, annuli, k, first, last))
        asked = materialize(asking.mapInArrow(_annuli(shared), "query_id bigint, list bigint, q array<double>, least double"), "asked")
        found = score_lists(asked, postings, k)
        best = materialize(ranked(found if best is None else found.unionByName(best.select("query_id", "vec_id", "score")), k), "best")
    return best.select("query_id", "rank", "vec_id", F.col("score").cast("bigint").alias("score"))
