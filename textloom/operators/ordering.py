"""Running totals in a global order without a single-task window.

The order column is cut into cells of similar row counts. Totals per cell are few and are summed up
in order; a window inside each cell does the rest. One shuffle, by cell, carries the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELL_ROWS = 200_000
MAX_CELLS = 1 << 16
MAX_LEVELS = 4  # 16 bits of the order column per level cover a bigint


def _cell_of(order: Column, low: Column, width: Column) -> Column:
    # halved before the subtraction so that the widest bigint range cannot overflow
    return F.floor(((F.shiftright(order, 1) - F.shiftright(low, 1)).cast("bigint")) / width).cast("bigint")


def _with_cells(df: DataFrame, order: str, cell_rows: int) -> tuple[DataFrame, list[str]]:
    """Add cell columns; dense stretches of the order column are cut again, level by level."""
    low, high, rows = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    if not rows:
        return df.withColumn("_c0", F.lit(0).cast("bigint")), ["_c0"]
    cells = max(1, min(MAX_CELLS, rows // cell_rows))
    width = ((high >> 1) - (low >> 1)) // cells + 1
    df = df.withColumn("_c0", _cell_of(F.col(order), F.lit(low), F.lit(width)))
    levels = ["_c0"]
    if rows <= 4 * cell_rows:
        return df, levels
    for level in range(1, MAX_LEVELS):
        bounds = df.groupBy(*levels).agg(
            F.count(F.lit(1)).alias("_n"), F.min(order).alias("_low"), F.max(order).alias("_high")
        )
        # fewer than rows / (4 * cell_rows) cells can be this full, so the broadcast is bounded
        dense = bounds.filter((F.col("_n") > 4 * cell_rows) & (F.col("_high") > F.col("_low"))).collect()
        if not dense:
            break
        spec = ", ".join(f"{c} bigint" for c in levels) + ", _low bigint, _width bigint"
        cut = [
            (
                *[row[c] for c in levels],
                row["_low"],
                ((row["_high"] >> 1) - (row["_low"] >> 1)) // min(MAX_CELLS, row["_n"] // cell_rows) + 1,
            )
            for row in dense
        ]
        table = F.broadcast(df.sparkSession.createDataFrame(cut, spec))
        name = f"_c{level}"
        sub = F.coalesce(_cell_of(F.col(order), F.col("_low"), F.col("_width")), F.lit(0))
        df = df.join(table, levels, "left").withColumn(name, sub.cast("bigint")).drop("_low", "_width")
        levels.append(name)
    return df, levels


def running_total(
    df: DataFrame,
    order: str,
    weight: Column | None = None,
    by: Sequence[str] = (),
    out: str = "offset",
    tie: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add ``out``: the total weight of the rows before this one in ``order``, per ``by`` group.

    Without ``weight`` every row counts one, which numbers the rows. ``order`` is a bigint column,
    unique or made so by ``tie``; ``by`` must have few distinct values. ``df`` is read more than
    once, so it should be a table.
    """
    keep = df.columns
    weighted = df.withColumn("_w", (weight if weight is not None else F.lit(1)).cast("bigint"))
    weighted, levels = _with_cells(weighted, order, cell_rows)
    keys = [*by, *levels]
    totals = weighted.groupBy(*keys).agg(F.sum("_w").alias("_cell_total"))
    before_cells = Window.partitionBy(*by).orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("_cell_total").over(before_cells), F.lit(0)).alias("_start"))
    before_rows = Window.partitionBy(*keys).orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_w").over(before_rows), F.lit(0))
    # one row per cell: at most MAX_CELLS plus the cuts of dense cells
    numbered = weighted.withColumn("_inside", inside).join(F.broadcast(starts), keys)
    return numbered.select(*keep, (F.col("_start") + F.col("_inside")).alias(out))
