"""Mixing sources to target weights by pivotal dependent rounding.

Sources, ordered by code point with null last, get the weights 5, 2, 1, 5, 2, 1, ... A source's target
is its weight's share of all words, at most ``MOST`` times the words it has; what it cannot take is
shared out again by weight. In closed form: a source takes ``min(weight * level, MOST * size)`` for the
one level at which the targets add up.

A document of a source is wanted ``target / size`` times. The whole part is taken as it is. The
fractional parts are rounded in pairs: words are moved at random from one document's fraction to the
other's, expected values unchanged, until one of them is 0 or 1. The sum of words stays the same, so a
source ends within one document of its target. Rounding runs inside salted groups of a source; each
group leaves at most one fraction, and these are combined in a tree until one per source is left.

Defined results: a null or empty text has size 0, takes 0 words and takes no part in rounding; rows equal
in id, source and size are taken equally often; a null id is an id like any other; an empty table gives an
empty result. Random numbers are hashes
of the document's id and place, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from textloom.llm import blocks as bl
from textloom.plans.skew import union_all
from textloom.session import materialize

WEIGHTS = (5, 2, 1)
MOST = 3
GROUP_ROWS = 20_000
FAN_IN = 256
WORD = r"[^\x20\x09-\x0D]+"


def with_sizes(docs: DataFrame) -> DataFrame:
    """Add ``size``: the number of words of the text, 0 for null."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from rows of (source, size). One row per source, so the
    windows over all sources see a table of the size of the list of sources."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = totals.withColumn("weight", weight.cast("double"))
    # sources fill up in this order while the level rises
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST
    behind = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = F.sum("source_size").over(Window.partitionBy())
    level = (everything - filled) / behind
    full = level * F.col("weight") > F.col("source_size") * MOST
    ranked = weighed.withColumn("level", F.when(~full, level))
    # the first source that does not fill up sets the level for all behind it
    found = F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    target = F.when(found.isNull(), F.col("source_size") * MOST * 1.0).otherwise(F.col("weight") * found)
    return ranked.withColumn("target", target.cast("double")).select("source", "source_size", "n_docs", "target")


def _unit(keys: np.ndarray, salt: int) -> np.ndarray:
    shift = np.uint64(salt * int(bl.GOLDEN) % (1 << 64))
    return (bl.mix(keys.view(np.uint64) + shift) >> np.uint64(11)).astype(float) * 2.0**-53


def round_pairs(weight: np.ndarray, share: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Round fractions in (0, 1) to 0 or 1, keeping ``sum(weight * share)``.

    Returns the rounded values, the index of the one left over (-1 for none) and its fraction.
    """
    out = np.zeros(len(share), np.int64)
    at, p = -1, 0.0
    for j, (w, q, u) in enumerate(zip(weight.tolist(), share.tolist(), draws.tolist())):
        if at < 0:
            at, p = j, q
            continue
        v = float(weight[at])
        # words that can go from the held one to the new one, and the other way
        over, back = min(v * p, w * (1 - q)), min(v * (1 - p), w * q)
        if u * (over + back) < back:
            full = over == v * p
            p, q = (0.0 if full else p - over / v), (q + over / w if full else 1.0)
            held_done = full
        else:
            full = back == v * (1 - p)
            p, q = (1.0 if full else p + back / v), (q - back / w if full else 0.0)
            held_done = full
        if held_done:
            out[at] = round(p)
            # both can become whole at once
            if 1e-12 < q < 1 - 1e-12:
                at, p = j, q
            else:
                out[j], at = round(q), -1
        else:
            out[j] = round(q)
            if not 1e-12 < p < 1 - 1e-12:
                out[at], at = round(p), -1
    return out, at, p


def _round_group(level: int, schema: pa.Schema):
    def run(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [(c, "ascending") for c in ("place", "doc_id", "size")]))
        draws = _unit(np.asarray(group.column("place"), np.int64), 100 + level)
        weight, share = (np.asarray(group.column(c), float) for c in ("weight", "share"))
        copies, at, rest = round_pairs(weight, share, draws)
        left = np.zeros(len(copies))
        if at >= 0:
            copies[at], left[at] = -1, rest
        columns = {**dict(zip(group.column_names, group.columns)), "share": pa.array(left), "up": pa.array(copies, pa.int32())}
        return pa.table([columns[name] for name in schema.names], schema=schema)

    return run


def decisions(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies) for each distinct (doc_id, source, size).

    ``n`` is the number of such rows; they are taken equally often.
    """
    sized = with_sizes(docs.select("doc_id", "text", "source")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    sized = materialize(sized, "sizes")
    plan = materialize(source_targets(sized.select("source", (F.col("size") * F.col("n")).alias("size"))), "targets")
    # one row per source
    wanted = sized.join(plan, sized.source.eqNullSafe(plan.source)).drop(plan.source)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + 1e-12)
    fraction = F.when(ratio - whole > 1e-12, ratio - whole).otherwise(F.lit(0.0))
    groups = F.ceil(F.col("n_docs") / GROUP_ROWS)
    key = F.xxhash64("doc_id", "size")
    wanted = wanted.select(
        "doc_id", "source", "size", "n", "source_size", "target", whole.alias("whole"),
        F.when(F.col("size") > 0, fraction).otherwise(F.lit(0.0)).alias("share"),
        (F.col("size") * F.col("n")).cast("double").alias("weight"),
        key.alias("place"), F.pmod(F.shiftrightunsigned(key, 20), groups).cast("bigint").alias("cell"),
    )
    groups_of_largest = plan.agg(F.max(F.ceil(F.col("n_docs") / GROUP_ROWS))).first()[0] or 0
    return _rounded(wanted, groups_of_largest)


def _rounded(wanted: DataFrame, groups: int) -> DataFrame:
    """Round level by level; ``groups`` is the number of cells of the largest source."""
    schema = to_arrow_schema(T.StructType([*wanted.schema.fields, T.StructField("up", T.IntegerType())]))
    spec = ", ".join(f"{n} {t}" for n, t in wanted.dtypes) + ", up int"
    done = [wanted.filter("share = 0").withColumn("up", F.lit(0))]
    open_rows, level = wanted.filter("share > 0"), 0
    while True:
        level += 1
        stepped = open_rows.groupBy("source", "cell").applyInArrow(_round_group(level, schema), spec)
        stepped = materialize(stepped, "rounded")
        done.append(stepped.filter("up >= 0"))
        open_rows = stepped.filter("up < 0").drop("up").withColumn("cell", F.floor(F.col("cell") / FAN_IN)).select(wanted.columns)
        if groups <= 1:
            break
        groups = -(-groups // FAN_IN)
    # the last fraction of a source is drawn alone
    chance = F.pmod(F.xxhash64(F.lit("last"), "place"), F.lit(1 << 30)) / float(1 << 30)
    done.append(open_rows.withColumn("up", (chance < F.col("share")).cast("int")))
    copies = (F.col("whole") + F.col("up")).cast("bigint").alias("copies")
    return union_all(done).select("doc_id", "source", "size", "n", "source_size", "target", copies)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each row of ``docs``, which has
    ``doc_id``, ``text`` and ``source``; ``taken`` counts words, repeats included."""
    rows = decisions(docs).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    taken = (F.col("copies") * F.col("size")).cast("bigint")
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", taken.alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each taken document as often as it is taken, with the columns of ``docs``."""
    chosen = materialize(decisions(docs).filter("copies > 0").select("doc_id", "source", "size", "copies"), "chosen")
    keyed = with_sizes(docs.select("doc_id", "source", "text", F.struct("*").alias("row"))).drop("text")
    same = [keyed[c].eqNullSafe(chosen[c]) for c in ("doc_id", "source", "size")]
    rows = keyed.join(chosen, reduce(Column.__and__, same)).select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select("row.*")
