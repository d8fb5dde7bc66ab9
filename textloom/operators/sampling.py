"""Prefixes of an ordered table: by row count and by byte budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.ordering import running_total


def first_rows(df: DataFrame, order: str, limit: int | None, tie: Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` rows in ``order``, then ``tie``; no limit for None or zero.

    The columns must tell the rows at the cut apart: rows equal in all of them are refused, because
    which of them come first would be left to chance. Only these columns are put in order; the rows
    themselves are filtered during their scan.
    """
    if not limit:
        return df
    keys = [order, *tie]
    ranked = running_total(df.select(*keys), order, out="before", tie=tie)
    last = ranked.filter(F.col("before") == limit - 1).select(F.struct(*keys).alias("last")).first()
    if last is None:
        return df
    cut = F.struct(*[F.lit(last["last"][k]).cast(df.schema[k].dataType).alias(k) for k in keys])
    if df.filter(F.struct(*keys) == cut).limit(2).count() > 1:
        raise ValueError(f"rows at the cut are equal in {', '.join(keys)}: name a tie-breaker")
    inside = F.struct(*keys) <= cut if tie else F.col(order) <= F.lit(last["last"][order])
    return df.filter(inside)


def byte_budget(df: DataFrame, order: str, budget: int, text: str = "text") -> DataFrame:
    """Rows whose preceding UTF-8 bytes stay below ``budget``; the crossing row is kept."""
    sizes = df.select(order, F.octet_length(text).cast("bigint").alias("bytes"))
    return _up_to(df, order, running_total(sizes, order, F.col("bytes"), out="before"), budget)


def _up_to(df: DataFrame, order: str, totals: DataFrame, bound: int) -> DataFrame:
    """Rows up to the last one whose total ``before`` it stays below ``bound``.

    Only the narrow totals are put in order; the rows themselves are filtered during their scan.
    """
    last = totals.filter(F.col("before") < bound).agg(F.max(order)).first()[0]
    return df.filter(F.lit(False)) if last is None else df.filter(F.col(order) <= last)
