"""Approximate nearest neighbours from balanced posting lists.

Nearness is the largest inner product. Vectors get one more component that brings all of them to the
same length, queries a zero, so the nearest in distance are the largest in product.

**Index.** Centroids come from a bounded sample (``SAMPLE``), halved again and again at the median along
its widest direction, so that lists are balanced. A vector is written to its nearest list and, if it lies
near a border, to further lists whose centroid is at most ``1 + BORDER`` times as far.

The number of lists follows the square root of the number of vectors, on small tables too.

Centroids form a graph of nearest neighbours in memory; a best-first walk finds the nearest ones.

**Search.** A query reads all lists whose centroid is at most ``1 + reach`` times as far as the nearest. The
walk gives the nearest; a centroid that it has not met is left out where its known distances to a few
entries of the graph prove that it lies beyond (triangle inequality), and compared where they do not. ``reach``
is fitted when the index is built, twice, and the larger figure holds: vectors of the sample are queries, their nearest
others in the sample are what is to be found, and ``reach`` is the least ratio that finds the share ``RECALL`` of these; then
``ASKED`` of the queries themselves, which may be longer, shorter or elsewhere than the other vectors, are held against all
vectors, in one pass over the table, and the same share of their true nearest has to lie in reach. The
nearest list is read first, then the others for scores that reach its k-th one. All vectors of these
lists are scored exactly, in double precision.

Every vector is indexed; lists have no cap, large ones are dealt over several groups.

Defined results: null, zero, empty and non-finite vectors take no part; ties go to the smaller id; rows
with one id are one vector; vectors must have one length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.vectors import best_pairs, kth_scores, matrix, ranked, score_lists, usable
from textloom.session import materialize

SAMPLE = 16_384
MOST_LISTS = 2048
NEIGHBOURS, BEAM = 16, 64
REPLICAS, BORDER = 2, 0.05
RECALL, TRIALS, ASKED = 0.96, 1024, 256
# entries whose distances bound those of centroids that a walk has not met
GUIDES = 8
TOP = 20
BATCH = 512


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray  # (lists, d + 1)
    near: np.ndarray  # (lists, NEIGHBOURS) the graph
    entries: np.ndarray  # where walks begin
    length: float  # squared length that all vectors are brought to


def lifted(vectors: np.ndarray, length: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(length - (vectors**2).sum(axis=1), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` equally large parts of ``points``."""
    parts = [np.arange(len(points))]
    while len(parts) < lists:
        parts.sort(key=len)
        part = parts.pop()
        if len(part) < 2:
            parts.append(part)
            break
        inside = points[part] - points[part].mean(axis=0)
        # two steps of the power method from the farthest point: the widest direction
        direction = inside[(inside**2).sum(axis=1).argmax()]
        for _ in range(2):
            direction = inside.T @ (inside @ direction)
            direction = direction / (np.linalg.norm(direction) + 1e-300)
        order = np.argsort(inside @ direction, kind="stable")
        parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return np.stack([points[p].mean(axis=0) for p in parts])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0)


def build(sample: np.ndarray, lists: int, length: float) -> Centroids:
    points = balanced_centroids(lifted(sample, length), lists)
    degree = min(NEIGHBOURS, len(points) - 1)
    near = np.zeros((len(points), max(degree, 1)), np.int64)
    for i in range(0, len(points), 256):
        apart = squared(points[i : i + 256], points)
        apart[np.arange(len(apart)), np.arange(i, i + len(apart))] = np.inf
        if degree:
            near[i : i + 256] = np.argsort(apart, axis=1, kind="stable")[:, :degree]
    entries = np.unique(np.linspace(0, len(points) - 1, max(1, int(len(points) ** 0.5))).astype(np.int64))
    return Centroids(points, near, entries, length)


def walk(index: Centroids, points: np.ndarray, beam: int = BEAM, ratio: float = 0.0) -> np.ndarray:
    """Squared distances (points, lists) of the centroids that a best-first walk has met, else infinity.

    A walk ends when its next open centroid lies beyond the ``beam``-th best and beyond ``1 + ratio`` times
    the nearest distance.
    """
    n, lists = len(points), len(index.points)
    apart = np.full((n, lists), np.inf)
    done = np.zeros((n, lists), bool)
    apart[:, index.entries] = squared(points, index.points[index.entries])
    beam = min(beam, lists)
    active = np.arange(n)
    while len(active):
        seen = apart[active]
        limit = np.partition(seen, beam - 1, axis=1)[:, beam - 1]
        limit = np.maximum(limit, seen.min(axis=1) * (1 + ratio) ** 2)
        open_ones = np.where(done[active], np.inf, seen)
        step = open_ones.argmin(axis=1)
        best = open_ones[np.arange(len(active)), step]
        going = np.isfinite(best) & (best <= limit)
        active, step = active[going], step[going]
        if not len(active):
            break
        done[active, step] = True
        around = index.near[step]
        gap = index.points[around] - points[active][:, None, :]
        apart[active[:, None], around] = np.einsum("ijk,ijk->ij", gap, gap)
    return apart


def within(index: Centroids, points: np.ndarray, ratio: float) -> np.ndarray:
    """Distances (points, lists) of all centroids within ``1 + ratio`` times the nearest that a walk finds;
    others may be infinite."""
    apart = np.sqrt(walk(index, points))
    limit = apart.min(axis=1, keepdims=True) * (1 + ratio)
    open_ones = ~np.isfinite(apart)
    for guide in index.entries[np.linspace(0, len(index.entries) - 1, min(GUIDES, len(index.entries))).astype(int)]:
        to_guide = np.sqrt(((index.points - index.points[guide]) ** 2).sum(axis=1))
        open_ones &= np.abs(apart[:, guide][:, None] - to_guide[None, :]) <= limit + 1e-9 * to_guide.max()
    row, which = np.nonzero(open_ones)
    for start in range(0, len(row), 65_536):
        r, w = row[start : start + 65_536], which[start : start + 65_536]
        gap = index.points[w] - points[r]
        apart[r, w] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return apart


def written(index: Centroids, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances from the centroids, and the lists (vectors, lists) that each vector is written to."""
    apart = np.sqrt(walk(index, lifted(vectors, index.length), ratio=BORDER))
    place = np.argsort(np.argsort(apart, axis=1, kind="stable"), axis=1)
    return apart, (apart <= apart.min(axis=1, keepdims=True) * (1 + BORDER)) & (place < REPLICAS)


def fitted_reach(index: Centroids, sample: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The least ratio by which lists hold the share ``recall`` of the ``k`` nearest in the sample, over at
    most ``TRIALS`` of its vectors as queries."""
    if len(sample) < 2 or len(index.points) < 2:
        return 0.0
    homes = np.concatenate([written(index, sample[i : i + BATCH])[1] for i in range(0, len(sample), BATCH)])
    picked = np.unique(np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int))
    k = min(k, len(sample) - 1)
    needed = []
    for i in range(0, len(picked), 128):
        who = picked[i : i + 128]
        product = sample[who] @ sample.T
        product[np.arange(len(who)), who] = -np.inf
        best = np.argpartition(-product, k - 1, axis=1)[:, :k]
        needed += [np.where(homes[b], r, np.inf).min(axis=1) for b, r in zip(best, list_ratios(index, sample[who]))]
    return float(np.quantile(np.concatenate(needed), recall, method="higher")) + 1e-9


def list_ratios(index: Centroids, queries: np.ndarray) -> np.ndarray:
    """(queries, lists): by how much each centroid lies farther than the nearest one."""
    # a query's further component is zero
    apart = np.sqrt(squared(np.pad(queries, ((0, 0), (0, 1))), index.points))
    return apart / np.maximum(apart.min(axis=1, keepdims=True), 1e-300) - 1


def _nearest_of(shared, k: int):
    """The ``k`` nearest of a few queries in the rows of a partition, and some more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, queries = shared.value
        least = np.full(len(who), -np.inf)
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for start in range(0, batch.num_rows, 8 * BATCH):
                part = slice(start, start + 8 * BATCH)
                row, col, scores = best_pairs(queries, who, matrix(batch.column(1)[part]), ids[part], k, least)
                # whoever has k of them here needs no lower score from later rows
                full = np.bincount(row, minlength=len(who)) >= k
                lowest = np.full(len(who), np.inf)
                np.minimum.at(lowest, row, scores)
                least = np.where(full, np.maximum(least, lowest), least)
                yield pa.RecordBatch.from_arrays([pa.array(who[row]), pa.array(ids[part][col]), pa.array(scores)], ["query_id", "vec_id", "score"])

    return run


def asked_reach(index: Centroids, vectors: DataFrame, asking: DataFrame, k: int, recall: float) -> float:
    """The least ratio by which lists hold the share ``recall`` of the ``k`` nearest among all ``vectors``, over at
    most ``ASKED`` of the queries ``asking`` (query_id, q)."""
    # ASKED rows at most
    few = asking.orderBy(F.xxhash64("query_id", F.lit("asked")), "query_id").limit(ASKED).toArrow()
    if not few.num_rows or len(index.points) < 2:
        return 0.0
    who, queries = np.asarray(few.column("query_id")), matrix(few.column("q"))
    shared = vectors.sparkSession.sparkContext.broadcast((who, queries))
    found = vectors.mapInArrow(_nearest_of(shared, k), "query_id bigint, vec_id bigint, score double")
    # k rows for each of these queries
    best = F.broadcast(ranked(found, k).select("query_id", "vec_id"))
    near = vectors.join(best, "vec_id").select("query_id", "vec").toArrow()
    if not near.num_rows:
        return 0.0
    vecs = matrix(near.column("vec"))
    homes = np.concatenate([written(index, vecs[i : i + BATCH])[1] for i in range(0, len(vecs), BATCH)])
    by = np.argsort(who)
    row = by[np.searchsorted(who[by], np.asarray(near.column("query_id")))]
    needed = np.where(homes, list_ratios(index, queries)[row], np.inf).min(axis=1)
    return float(np.quantile(needed, recall, method="higher")) + 1e-9


def _postings(shared):
    """Row-wise: the lists that a vector is written to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                row, which = np.nonzero(written(shared.value, matrix(part.column(1)))[1])
                kept = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(which), kept.column(1)], ["vec_id", "list", "vec"])

    return run


def _lists_of(shared, ratio: float):
    """Row-wise: the lists that a query reads, and which of them is the nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                # a query's further component is zero
                apart = within(shared.value, np.pad(matrix(part.column(1)), ((0, 0), (0, 1))), ratio)
                row, which = np.nonzero(apart <= apart.min(axis=1, keepdims=True) * (1 + ratio))
                kept, nearest = part.take(pa.array(row)), apart.argmin(axis=1)[row] == which
                yield pa.RecordBatch.from_arrays(
                    [kept.column(0), pa.array(which), pa.array(nearest), kept.column(1)], ["query_id", "list", "nearest", "q"]
                )

    return run


def search(table: DataFrame, k: int = TOP, recall: float = RECALL, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every``, the nearest
    others found. ``table`` has ``vec_id`` and ``embedding``."""
    spark = table.sparkSession
    vectors = usable(table, lambda x: x).filter(F.exists("vec", lambda x: x != 0.0))
    vectors = materialize(vectors, "vectors")
    length = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)
    n, longest = vectors.agg(F.count(F.lit(1)), F.max(length)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    place = F.xxhash64("vec_id", F.lit("sample"))
    # about twice as many as are wanted pass by their hash, so that the sort moves few rows
    early = vectors.filter(F.pmod(place, F.lit(1 << 40)) < int(min(1.0, 2 * SAMPLE / n) * (1 << 40)))
    sample = matrix(early.orderBy(place, "vec_id").limit(SAMPLE).select("vec").toArrow().column("vec"))
    lists = int(max(1, min(MOST_LISTS, n**0.5, len(sample))))
    index = build(sample, lists, longest * (1 + 1e-9))
    asking = vectors.filter(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q"))
    reach = max(fitted_reach(index, sample, k, recall), asked_reach(index, vectors, asking, k, recall))
    shared = spark.sparkContext.broadcast(index)  # MOST_LISTS centroids at most
    postings = vectors.mapInArrow(_postings(shared), "vec_id bigint, list bigint, vec array<double>")
    asked = asking.mapInArrow(_lists_of(shared, reach), "query_id bigint, list bigint, nearest boolean, q array<double>")
    asked, postings = materialize(asked, "asked"), materialize(postings, "postings")
    near = asked.filter("nearest").withColumn("least", F.lit(float("-inf")))
    first = materialize(ranked(score_lists(near, postings, k), k), "first")
    rest = asked.filter("not nearest").join(kth_scores(first, k), "query_id", "left").na.fill(float("-inf"), ["least"])
    return ranked(score_lists(rest, postings, k).unionByName(first.drop("rank")), k)
