"""Helpers of the two vector searches: usable vectors, and scoring lists of vectors for many queries."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# vectors and queries that meet in one group; larger lists are dealt over several groups
GROUP_VECTORS, GROUP_QUERIES = 4096, 512


def usable(table: DataFrame, value: Callable[[Column], Column]) -> DataFrame:
    """(vec_id, vec) with ``value`` of each component as a double; vectors that are null, empty or hold
    null or non-finite components go. Rows with the same ``vec_id`` are one vector, the least of them."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    good = table.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite))
    rows = good.select("vec_id", F.transform("embedding", lambda x: value(x.cast("double"))).alias("vec"))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def best_pairs(
    queries: np.ndarray, who: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, columns and scores of each query's k best: larger inner products, then smaller ids.

    A matrix product, a little off in its last digits, finds what may be among them; those products are
    then added up component by component, so that a pair's score does not depend on the rows around it
    and equal vectors tie exactly. Scores below ``least`` of the query are of no use to it.
    """
    rough = queries @ rows.T
    rough[who[:, None] == ids[None, :]] = -np.inf
    bar = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(rough), -np.inf)
    bar = np.maximum(bar, least)
    size = np.linalg.norm(queries, axis=1) * np.linalg.norm(rows, axis=1).max()
    row, col = np.nonzero((rough >= (bar - 1e-9 * size)[:, None]) & (rough > -np.inf))
    exact = np.zeros(len(row))
    for d in range(queries.shape[1]):
        exact += queries[row, d] * rows[col, d]
    keep = exact >= least[row]
    row, col, exact = row[keep], col[keep], exact[keep]
    by = np.lexsort((ids[col], -exact, row))
    row, col, exact = row[by], col[by], exact[by]
    first = (np.arange(len(row)) - np.searchsorted(row, row)) < k
    return row[first], col[first], exact[first]


def score_lists(asked: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """The best ``k`` (query_id, vec_id, score) within each group of vectors.

    ``asked``: (query_id, list, q, least) with the query's vector and the score that it has no use below;
    ``postings``: (list, vec_id, vec). A list's
    vectors and its queries are dealt over groups of bounded size, so no list is gathered whole.
    """
    sizes = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / GROUP_VECTORS).alias("parts"))
    calls = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).alias("turns"))
    # one row per list; the callers bound the number of lists
    plan = F.broadcast(sizes.join(calls, "list"))
    vectors = postings.join(plan, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1)).alias("turn"), "vec_id", "vec",
    )
    queries = asked.join(plan, "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id"), "turns").alias("turn"), "query_id", "q", "least",
    )
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, who = np.asarray(left.column("vec_id")), np.asarray(right.column("query_id"))
        if not len(ids) or not len(who):
            return schema.empty_table()
        least = np.asarray(right.column("least"))
        row, col, scores = best_pairs(matrix(right.column("q")), who, matrix(left.column("vec")), ids, k, least)
        return pa.table([who[row], ids[col], scores], schema=schema)

    keys = ("list", "part", "turn")
    met = vectors.groupBy(*keys).cogroup(queries.groupBy(*keys))
    return met.applyInArrow(score, "query_id bigint, vec_id bigint, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query; a vector found twice counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def kth_scores(best: DataFrame, k: int) -> DataFrame:
    """(query_id, least): the score of the k-th found so far; minus infinity where fewer are found."""
    enough = F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(float("-inf")))
    return best.groupBy("query_id").agg(enough.alias("least"))
