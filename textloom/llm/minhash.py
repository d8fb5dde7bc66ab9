"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A document is the multiset of its runs of five lower-case words (all its words, where it has fewer);
a run's weight is its count. The similarity of two documents is the probability Jaccard index of these
weights, which is the plain Jaccard index when every run occurs once.

**Signature.** Each run is a Poisson process whose rate is its weight: its arrivals come from its hash
alone, and each arrival picks one of ``registers`` registers. A register keeps the run that arrived
first, so two documents agree in a register with the probability of their similarity. A run stops as
soon as its next arrival is later than the latest first arrival of all registers.

**Candidates.** Documents with equal word sequences collapse to the first of them during the map-side
aggregation. The signature is cut into bands. Each bucket first links its members to one leader only, so
a bucket of n rows gives n - 1 pairs. After verification, only members that are still in different
components of the same bucket are compared, without those that have too many runs of their own to
reach the threshold with any document. The join's condition demands similar signatures, by four bits of
each register: six standard deviations below the threshold, so that no link is lost to the estimate.

**Verification** reads the runs of candidate documents again and computes the similarity exactly.
Components come from alternating stars over tables; no links are gathered on the driver.

Documents are told apart by a hash of id and text, so ids may be null or repeated.

Defined results: a null text or one without words is a class of its own; equal word sequences are one
class; rows with one ``doc_id`` but different texts are judged by their texts; class ids are the smallest
``doc_id`` of a class, null if none of its rows has one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import blocks as bl
from textloom.session import materialize


# runs of at most so many documents are rare; see shared_runs
RARE = 3


@dataclass(frozen=True)
class NearDupConfig:
    words: int = 5
    threshold: float = 0.8
    bands: int = 30
    rows: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def most_different(self) -> int:
        """Differing bits, of four per register, that two documents at the threshold pass once in a billion
        pairs: a register differs with probability 1 - threshold, and then each of its bits by chance."""
        miss = 1 - self.threshold
        mean, square = 2 * miss, 5 * miss
        return int(self.registers * mean + 6 * (self.registers * (square - mean**2)) ** 0.5) + 1

    @property
    def bit_words(self) -> list[str]:
        return [f"bits{i}" for i in range(-(-self.registers // 16))]


def weighted_runs(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of word runs, sorted and distinct per text, their counts, the text's number of runs,
    and two hashes of its whole word sequence (both zero without words)."""
    codes, offsets = bl.code_points([text.lower() for text in texts])
    starts, ends = bl.runs(bl.word_characters()[codes], offsets)
    words = bl.run_hashes(codes, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    first, last = bounds[:-1], bounds[1:]
    count = last - first
    n = len(texts)
    text_of = np.repeat(np.arange(n), count)

    place = np.arange(len(words)) - np.repeat(first, count)
    whole = np.zeros((n, 2), np.uint64)
    for j, salt in enumerate((1, 2)):
        mixed = bl.mix(words + bl.mix(place.astype(np.uint64) * bl.GOLDEN + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
        whole[:, j] = sums[last] - sums[first]

    wide = len(words) - size + 1
    grams = np.zeros(max(wide, 0), np.uint64)
    for t in range(size if wide > 0 else 0):
        grams = grams * bl.GOLDEN + words[t : t + wide]
    grams = bl.mix(grams)
    inside = np.flatnonzero(text_of[:wide] == text_of[size - 1 :]) if wide > 0 else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    hashes = np.concatenate([grams[inside], whole[short, 0]])
    owner = np.concatenate([text_of[inside], short])
    order = np.argsort(owner, kind="stable")
    hashes, owner = hashes[order], owner[order]
    edges = np.searchsorted(owner, np.arange(n + 1))
    for s, e in zip(edges[:-1], edges[1:]):
        hashes[s:e].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    return hashes[at], counts, np.bincount(owner[at], minlength=n), whole


def signatures(hashes: np.ndarray, weights: np.ndarray, lengths: np.ndarray, registers: int) -> np.ndarray:
    """ProbMinHash of each text's weighted elements: 32 bits of the winning element per register."""
    n = len(lengths)
    text = np.repeat(np.arange(n), lengths)
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    active = np.arange(len(hashes))
    time = np.zeros(len(hashes))
    step = 0
    while len(active):
        # few elements left: draw several arrivals of each at once
        k = int(np.clip(200_000 // len(active), 1, 64))
        e = hashes[active]
        draw = bl.mix(e[:, None] + (np.arange(step, step + k, dtype=np.uint64) * bl.GOLDEN)[None, :])
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weights[active][:, None]
        arrival = time[active][:, None] + np.cumsum(gap, axis=1)
        register = (bl.mix(draw ^ bl.GOLDEN) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
        key = (text[active][:, None] * registers + register.astype(np.int64)).ravel()
        flat = arrival.ravel()
        np.minimum.at(earliest, key, flat)
        won = flat == earliest[key]
        winner[key[won]] = np.repeat(e, k)[won]
        time[active] = arrival[:, -1]
        latest = earliest.reshape(n, registers).max(axis=1)
        active = active[time[active] < latest[text[active]]]
        step += k
    return (bl.mix(winner) >> np.uint64(32)).astype(np.uint32).view(np.int32).reshape(n, registers)


def packed_bits(sig: np.ndarray, words: int) -> np.ndarray:
    """Four bits of each register, sixteen registers to a 64-bit word: (texts, words)."""
    wide = np.zeros((len(sig), words * 16), np.uint64)
    wide[:, : sig.shape[1]] = sig & 15
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return (wide.reshape(len(sig), words, 16) << shifts).sum(axis=2, dtype=np.uint64).view(np.int64)


def _sign(cfg: NearDupConfig):
    words = cfg.bit_words
    longs = [(name, pa.int64()) for name in ("node", "doc_id", "h1", "h2", *words)]
    schema = pa.schema([*longs, ("sig", pa.list_(pa.int32()))])

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column(0), batch.column(2)
            for start, texts in bl.text_blocks(batch.column(1)):
                hashes, counts, lengths, whole = weighted_runs(texts, cfg.words)
                sig = signatures(hashes, counts, lengths, cfg.registers)
                sig_list = bl.list_array(sig.ravel(), np.where(lengths, cfg.registers, 0), pa.int32())
                if not lengths.all():
                    sig_list = bl.list_array(sig[lengths > 0].ravel(), np.where(lengths, cfg.registers, 0), pa.int32())
                numbers = np.concatenate([whole.view(np.int64), packed_bits(sig, len(words))], axis=1)
                columns = [pa.array(np.ascontiguousarray(column)) for column in numbers.T]
                yield pa.RecordBatch.from_arrays([nodes.slice(start, len(texts)), ids.slice(start, len(texts)), *columns, sig_list], schema=schema)

    return run


def _runs_of(cfg: NearDupConfig):
    schema = pa.schema([("node", pa.int64()), ("runs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])

    @bl.give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in bl.text_blocks(batch.column(1)):
                hashes, counts, lengths, _ = weighted_runs(texts, cfg.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        bl.list_array(hashes.view(np.int64), lengths, pa.int64()),
                        bl.list_array(counts.astype(np.int32), lengths, pa.int32()),
                    ],
                    schema=schema,
                )

    return run


def probability_jaccard(x: np.ndarray, xw: np.ndarray, y: np.ndarray, yw: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum_j max(x_j / x_i, y_j / y_i); elements are distinct."""
    keys, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    wx, wy = np.zeros(len(keys)), np.zeros(len(keys))
    wx[at[: len(x)]], wy[at[len(x) :]] = xw, yw
    common = (wx > 0) & (wy > 0)
    pairs, times = np.unique(np.stack([wx[common], wy[common]]), axis=1, return_counts=True)
    return float(sum(n / np.maximum(wx / a, wy / b).sum() for (a, b), n in zip(pairs.T, times)))


def _similar(threshold: float):
    def at_least(x: pa.Array, xw: pa.Array, y: pa.Array, yw: pa.Array) -> pa.Array:
        sides = [(np.asarray(c.offsets), np.asarray(c.values)) for c in (x, xw, y, yw)]
        out = np.zeros(len(x), bool)
        for i in range(len(x)):
            out[i] = probability_jaccard(*(v[o[i] : o[i + 1]] for o, v in sides)) >= threshold
        return pa.array(out)

    return F.arrow_udf(_annotated(at_least), "boolean")


def _annotated(f):
    """Annotations as objects: the module's are strings, which the UDF's type check would not resolve."""
    f.__annotations__ = {"x": pa.Array, "xw": pa.Array, "y": pa.Array, "yw": pa.Array, "return": pa.Array}
    return f


def run_sets(docs: DataFrame, nodes: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """(node, runs, counts) of the documents named in ``nodes``: the one time that texts are shuffled.

    The list of nodes follows the corpus, so both sides are always dealt by id and never broadcast.
    """
    wanted = docs.select("doc_id", "text").join(nodes.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    wanted = wanted.dropDuplicates(["doc_id"])
    return materialize(wanted.mapInArrow(_runs_of(cfg), "node bigint, runs array<bigint>, counts array<int>"), "runs")


def verified(pairs: DataFrame, sets: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """The pairs (a, b) whose documents reach the threshold."""
    left = sets.select(F.col("node").alias("b"), F.col("runs").alias("y"), F.col("counts").alias("yw"))
    right = sets.select(F.col("node").alias("a"), F.col("runs").alias("x"), F.col("counts").alias("xw"))
    met = pairs.hint("merge").join(left, "b").join(right.hint("merge"), "a")
    return materialize(met.filter(_similar(cfg.threshold)("x", "xw", "y", "yw")).select("a", "b").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b): the smallest node each is connected with.

    Large and small stars alternate until the edges form stars; every step is a grouped minimum and a
    join, and the number of steps follows the logarithm of the longest path.
    """

    def stars(links: DataFrame, large: bool) -> DataFrame:
        """Hang the larger (or the smaller) neighbours of each node on the smallest of them."""
        if large:
            near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            moved = near.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        else:
            least = links.groupBy("b").agg(F.min("a").alias("m"))
            met = links.join(least, "b")
            moved = met.select(F.col("m").alias("a"), F.col("a").alias("b")).union(least.select("m", "b"))
        return moved.filter("a < b").distinct()

    def mark(links: DataFrame) -> tuple:
        return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    links = materialize(links, "links")
    seen = None
    while seen != (seen := mark(links)):
        links = materialize(stars(stars(links, True), False), "links")
    return links.select(F.col("b").alias("node"), F.col("a").alias("root"))


def band_keys(cfg: NearDupConfig) -> Column:
    """Bucket numbers of a signature's bands."""
    keys = (
        f"xxhash64({b}, {', '.join(f'get(sig, {b * cfg.rows + i})' for i in range(cfg.rows))})" for b in range(cfg.bands)
    )
    return F.expr(f"array({', '.join(keys)})")


def buckets(reps: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """(bucket, band, node) for each band of each document."""
    return reps.select("node", F.posexplode(band_keys(cfg)).alias("band", "bucket"))


def _node() -> Column:
    """The number of a document: ids may be missing or repeated, so the text takes part."""
    return F.xxhash64("doc_id", "text")


def near_duplicate_classes(docs: DataFrame, cfg: NearDupConfig = NearDupConfig()) -> DataFrame:
    """(doc_id, class_id) for each row of ``docs``, which has ``doc_id`` and ``text``; see above."""
    return _classes(docs, cfg).select("doc_id", "class_id")


def without_near_duplicates(docs: DataFrame, cfg: NearDupConfig = NearDupConfig()) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: its row with the smallest id, ids before none.

    Rows equal in id and text are one row; texts without words all stay.
    """
    # columns of any name may be there already
    node = "node"
    while node in docs.columns:
        node += "_"
    found = materialize(_classes(docs, cfg), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    first = found.groupBy("root").agg(F.min_by("node", order).alias(node)).select(node)
    kept = docs.withColumn(node, _node()).join(first.hint("merge"), node, "left_semi")
    return kept.dropDuplicates([node]).select(docs.columns)


def _classes(docs: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """(node, doc_id, root, class_id) for each row."""
    docs = docs.select(_node().alias("node"), "text", "doc_id")
    signed = materialize(
        docs.mapInArrow(_sign(cfg), f"node bigint, doc_id bigint, h1 bigint, h2 bigint, {' '.join(f'{w} bigint,' for w in cfg.bit_words)} sig array<int>"),
        "signed",
    )
    filled = signed.filter(F.size("sig") > 0)
    firsts = materialize(filled.groupBy("h1", "h2").agg(F.min("node").alias("node"), F.min("doc_id").alias("first_id")), "firsts")
    same = [filled.node == firsts.node, filled.h1 == firsts.h1, filled.h2 == firsts.h2]
    reps = filled.join(firsts.hint("merge"), same, "left_semi").select("node", "sig", *cfg.bit_words)
    reps = materialize(reps.dropDuplicates(["node"]), "representatives")

    members = led_buckets(buckets(reps, cfg))
    pairs = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    sets = run_sets(docs.select(F.col("node").alias("doc_id"), "text"), members.select("node").distinct(), cfg)
    edges = verified(pairs, sets, cfg)
    linked = components(edges)

    rest = _across(members.filter("n > 2"), linked, reps, sets, cfg)
    if not rest.isEmpty():
        linked = components(edges.unionByName(verified(rest, sets, cfg)))

    # the smallest id of each component, written once per text
    placed = materialize(firsts.join(linked.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node")), "placed_texts")
    named = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    classes = placed.select("h1", "h2", "root").join(named.hint("merge"), "root")
    found = signed.select("node", "doc_id", "h1", "h2", (F.size("sig") > 0).alias("filled")).join(classes, ["h1", "h2"], "left")
    return found.select(
        "node", "doc_id", F.when(F.col("filled"), F.col("root")).otherwise(F.col("node")).alias("root"),
        F.when(F.col("filled"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
    )


def led_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, band, node, n, leader) of the buckets with several members. The leader is the member that meets
    most others over all its buckets: among variants of one text that is the one nearest to all."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(rows.join(sizes.hint("merge"), "bucket"), "shared")
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = shared.join(met.hint("merge"), "node").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("node")).alias("node"))).alias("first"))
    led = shared.join(ranked.select("bucket", (-F.col("first.node")).alias("leader")).hint("merge"), "bucket")
    return materialize(led, "members")


def shared_runs(sets: DataFrame, nodes: DataFrame, cfg: NearDupConfig) -> tuple[DataFrame, DataFrame]:
    """What the runs of ``nodes`` (node, root) say about possible pairs: figures, and pairs by rare runs.

    Figures (node, stats) of documents that can have a partner at all: ``total`` is the number of runs by
    count, ``most`` the largest count, ``many`` the number of distinct runs with a count above one; ``own``
    is a part that only ``RARE`` of the nodes have, ``shared`` the number of the other distinct runs.
    A document is left out when the part that no other node has rules the threshold out by itself.

    Pairs (a, b): nodes of different roots that have a rare run in common. For all other pairs rare runs
    count as runs of their own.
    """
    inside = sets.join(nodes.hint("merge"), "node")
    total = inside.select(
        "node",
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, c: acc + c).alias("total"),
        F.size("counts").alias("distinct"),
        F.array_max("counts").alias("most"),
        F.size(F.filter("counts", lambda c: c > 1)).alias("many"),
    )
    rows = inside.select("node", "root", F.explode(F.arrays_zip("runs", "counts")).alias("r"))
    by_run = rows.groupBy(F.col("r.runs").alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor("node").alias("mixed"),
        F.sum("r.counts").alias("mass"), (F.min("root") != F.max("root")).alias("across"),
    )
    # the lowest, the highest and, of three, the one that is left
    third = F.col("mixed").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    who = F.when(F.col("n") == 1, F.array("low")).when(F.col("n") == 2, F.array("low", "high")).otherwise(F.array("low", third, "high"))
    rare = by_run.filter(F.col("n") <= RARE).withColumn("who", who)
    rare = materialize(rare.select("n", "who", "mass", "across"), "rare")
    alone = F.col("n") == 1
    parts = rare.select(F.explode("who").alias("node"), alone.alias("alone"), F.when(alone, F.col("mass")).otherwise(1).alias("mass"))
    own = parts.groupBy("node").agg(
        F.sum("mass").alias("own"), F.count(F.lit(1)).alias("own_distinct"), F.sum(F.when(F.col("alone"), F.col("mass"))).alias("sole")
    )
    found = total.join(own.hint("merge"), "node", "left").na.fill(0, ["own", "own_distinct", "sole"])
    able = found.filter(F.col("total") - F.col("sole") >= F.col("total") * (cfg.threshold - 1e-9))
    stats = able.select("node", F.struct("total", "own", "most", "many", (F.col("distinct") - F.col("own_distinct")).alias("shared")).alias("stats"))
    met = rare.filter("across").select("who").distinct()
    two = F.array(*[F.struct(F.get("who", F.lit(i)).alias("a"), F.get("who", F.lit(j)).alias("b")) for i, j in ((0, 1), (1, 2), (0, 2))])
    pairs = met.select(F.explode(F.when(F.size("who") == 2, F.slice(two, 1, 1)).otherwise(two)).alias("p")).select("p.a", "p.b").distinct()
    return stats, pairs


def most_similar(x: Column, y: Column) -> Column:
    """The largest similarity that two documents with these figures and without a common rare run can
    have, seen from ``x``.

    A common run i adds x_i / (X + rest), where the rest holds what only y has, by its count in units of
    y_i. Common runs are at most the shared ones of either side; those repeated in y, whose rest may be
    small, weigh at most ``most`` each in x.
    """
    common = x["total"] - x["own"] - F.greatest(x["shared"] - y["shared"], F.lit(0))
    repeated = F.least(common, x["most"] * y["many"])
    return (common - repeated) / (x["total"] + y["own"]) + repeated / x["total"]


def _across(members: DataFrame, linked: DataFrame, reps: DataFrame, sets: DataFrame, cfg: NearDupConfig) -> DataFrame:
    """Pairs that share a bucket, lie in different components, and have similar signatures.

    The bucket's leader has been compared with all members, so one side is a member outside the
    leader's component and neither side is the leader. Documents that cannot have a partner at all are
    taken out first, and pairs whose runs of their own rule out the threshold are not formed, which
    leaves few even where many unlike documents share a bucket.
    """
    placed = members.join(linked.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "placed")
    split = placed.groupBy("bucket").agg(
        F.max(F.when(F.col("node") == F.col("leader"), F.col("root"))).alias("lead_root"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    split = split.filter("low <> high").select("bucket", "lead_root")
    open_rows = materialize(placed.filter("node <> leader").join(split.hint("merge"), "bucket").drop("leader", "n"), "open")
    stats, rare = shared_runs(sets, open_rows.select("node", "root").distinct(), cfg)
    able = materialize(stats, "stats")
    # both ends must be able to have a partner
    ids = able.select("node")
    rare = rare.join(ids.withColumnRenamed("node", "a").hint("merge"), "a", "left_semi")
    rare = materialize(rare.join(ids.withColumnRenamed("node", "b").hint("merge"), "b", "left_semi").select("a", "b"), "rare_pairs")
    signed = able.join(reps, "node").withColumn("keys", band_keys(cfg)).drop("sig")
    rows = open_rows.join(signed.hint("merge"), "node")
    rows = materialize(rows.withColumn("outside", F.col("root") != F.col("lead_root")), "comparable")
    figures = ["node", "root", "outside", "stats", "keys", *cfg.bit_words]
    one = rows.filter("outside").select("bucket", "band", *[F.col(c).alias(f"y_{c}") for c in figures])
    two = rows.select("bucket", *[F.col(c).alias(f"x_{c}") for c in figures])
    apart = (F.col("y_root") != F.col("x_root")) & (~F.col("x_outside") | (F.col("x_node") < F.col("y_node")))
    x_stats, y_stats = F.col("x_stats"), F.col("y_stats")
    possible = F.least(most_similar(x_stats, y_stats), most_similar(y_stats, x_stats)) >= cfg.threshold - 1e-9
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"x_{w}").bitwiseXOR(F.col(f"y_{w}"))) for w in cfg.bit_words])
    # a pair is formed in the first of its common buckets only
    earlier = F.arrays_overlap(F.slice("x_keys", 1, F.col("band")), F.slice("y_keys", 1, F.col("band")))
    met = one.join(two, "bucket").filter(apart & possible & (differ <= cfg.most_different) & ~earlier)
    pairs = met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))
    return materialize(pairs.unionByName(rare).distinct(), "pairs")
