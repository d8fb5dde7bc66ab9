"""Near-duplicate removal: a document goes when it is a near-duplicate of an earlier kept one.

The result equals that of reading the documents one by one in id order against an LSH index of the
documents kept so far, but it is reached in rounds of joins:

1. Documents with equal signatures collapse to the first of them. This is exact, and copies are
   merged by map-side aggregation before any shuffle.
2. Two signatures that reach the threshold differ in few positions, hence share at least a known
   number of bands. So it is enough to look at each document's rarest bands (prefix filtering).
   Bands made common by boilerplate drop out, and so do documents with only bands of their own.
3. Documents whose signatures have too many values of their own to be near any other one leave the
   large buckets at once.
4. In each round the lowest ids of every band bucket ("probes") are compared with the members of
   the bucket. Small buckets are compared completely. A large bucket only meets its first few
   members, so its work is linear in its size, and the near-copies found this way leave.
5. What remains of a large bucket is cut by a further shared value, level by level. Near-duplicates differ
   in few positions, so among the values that not all members share, each pair of them has one in common
   within a short prefix of rare values. Values of one document only form no bucket. So the number of
   jobs follows the levels and not the documents that share boilerplate.

Nothing is capped: rounds go on until every document is decided. After the last cut the number of probes
grows, and the first undecided document is decided in every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.config import DedupConfig
from textloom.functions import hashing
from textloom.plans.skew import HOT_ROWS, hot_keys, key_sizes, skew_join, union_all
from textloom.session import materialize

# Buckets up to this size are compared completely in one round.
SMALL_BUCKET = 64
# Probes per large bucket grow fourfold from round to round up to this number.
MAX_PROBES = 512
# Levels by which large buckets are cut; a level gives a document at most ten buckets for one.
MAX_CUTS = 4


def band_rows(cfg: DedupConfig) -> int:
    if cfg.bands > cfg.permutations:
        raise ValueError("bands must not exceed permutations")
    return max(1, cfg.permutations // cfg.bands)


def min_equal_positions(cfg: DedupConfig) -> int:
    """Fewest equal positions whose share reaches the threshold."""
    return next(n for n in range(cfg.permutations + 2) if n / cfg.permutations >= cfg.threshold)


def shared_bands(cfg: DedupConfig) -> int:
    """Bands that any two near-duplicates surely share: each differing position spoils one."""
    return max(1, cfg.bands - max(0, cfg.permutations - min_equal_positions(cfg)))


def band_slices(sig: Column, cfg: DedupConfig) -> Column:
    """array<struct<band, key>> of a signature."""
    rows = band_rows(cfg)
    return F.transform(
        F.sequence(F.lit(0), F.lit(cfg.bands - 1)),
        lambda b: F.struct(b.alias("band"), F.slice(sig, b * rows + 1, rows).alias("key")),
    )


def _band_key(sig: str, band: int, rows: int) -> str:
    return f"slice({sig}, {band * rows + 1}, {rows})"


def band_buckets(sig: str, cfg: DedupConfig, bands: int | None = None) -> Column:
    """Bucket number of each of the first ``bands`` bands of a signature column."""
    rows = band_rows(cfg)
    keys = (f"xxhash64({b}, {_band_key(sig, b, rows)})" for b in range(bands or cfg.bands))
    return F.expr(f"array({', '.join(keys)})")


def is_near_duplicate(left: str, right: str, cfg: DedupConfig) -> Column:
    """Similarity at or above the threshold, among pairs that share a band."""
    rows = band_rows(cfg)
    shared = (f"{_band_key(left, b, rows)} = {_band_key(right, b, rows)}" for b in range(cfg.bands))
    similar = hashing.equal_positions(left, right, cfg.permutations) >= min_equal_positions(cfg)
    return similar & F.expr(" or ".join(shared))


def signatures(docs: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """Replace ``words`` by the MinHash signature ``sig``. Row-local: no shuffle."""
    hashes = hashing.shingle_hashes(F.col("words"), cfg.shingle_size)
    return docs.withColumn("sig", hashing.affine_signature(hashes, cfg.permutations)).drop("words")


def leader_pairs(signed: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """Each document paired with the first document of every band bucket it falls into.

    This is the star-shaped part of the candidate relation: linear in the documents, where all
    pairs of a bucket would be quadratic in its size.
    """
    members = signed.select("doc_id", "sig", F.explode(band_buckets("sig", cfg)).alias("bucket"))
    first = materialize(
        members.groupBy("bucket").agg(
            F.min_by("sig", "doc_id").alias("leader_sig"),
            F.min("doc_id").alias("leader_id"),
            F.count(F.lit(1)).alias("n"),
        ),
        "leaders",
    )
    hot = hot_keys(first, "bucket")
    first = first.filter("n > 1").drop("n")
    pairs = skew_join(members, first, "bucket", hot, condition=F.col("leader_id") < F.col("doc_id"))
    similarity = hashing.equal_positions("leader_sig", "sig", cfg.permutations) / cfg.permutations
    return pairs.select("leader_id", "doc_id", similarity.alias("similarity")).distinct()


def first_kept_wins(
    signed: DataFrame,
    cfg: DedupConfig = DedupConfig(),
    order: str = "doc_id",
    small_bucket: int = SMALL_BUCKET,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Ids (column ``order``) of the documents that survive; ``signed`` has ``order`` and ``sig``.

    Ids must be unique and give the reading order.
    """
    reps, members = _candidates(signed, cfg, order, small_bucket, hot_rows)
    return _kept(reps, members, cfg, small_bucket, hot_rows).withColumnRenamed("id", order)


def _candidates(
    signed: DataFrame, cfg: DedupConfig, order: str, small_bucket: int, hot_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """The first document of each signature, and the bucket rows through which these can meet."""
    first = signed.groupBy("sig").agg(F.min(order).alias("id"))
    reps = materialize(first, "representatives")
    members = _prefix_members(reps, cfg, hot_rows)
    return reps, None if members is None else _without_loners(members, reps, cfg, small_bucket, hot_rows)


def _kept(reps: DataFrame, members: DataFrame | None, cfg: DedupConfig, small_bucket: int, hot_rows: int) -> DataFrame:
    dropped = []
    probes, cuts = 1, 0
    while members is not None:
        lost, members = _round(members, cfg, probes, small_bucket, hot_rows)
        if lost is not None:
            dropped.append(lost)
        if members is not None and cuts < MAX_CUTS:
            members, cuts = _cut(members, reps, cfg, small_bucket, hot_rows), cuts + 1
        probes = min(probes * 4, MAX_PROBES)
    kept = reps.select("id")
    return kept.join(union_all(dropped), "id", "left_anti") if dropped else kept


def dropped_by(
    signed: DataFrame, cfg: DedupConfig = DedupConfig(), order: str = "doc_id", small_bucket: int = SMALL_BUCKET, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(``order``, kept_id, similarity) of each dropped document: the first kept one that drops it.

    Documents with one signature are dropped by the same document, or by the first of themselves.
    """
    reps, members = _candidates(signed, cfg, order, small_bucket, hot_rows)
    kept = materialize(_kept(reps, members, cfg, small_bucket, hot_rows), "kept")
    cause = kept.select("id", F.col("id").alias("kept_id"), F.lit(1.0).alias("similarity"))
    if members is not None:
        keepers = members.join(kept, "id", "left_semi").select("bucket", F.col("id").alias("kept_id"), F.col("sig").alias("kept_sig"))
        met = members.join(kept, "id", "left_anti").join(keepers, "bucket").filter(F.col("kept_id") < F.col("id"))
        near = met.filter(is_near_duplicate("kept_sig", "sig", cfg))
        equal = hashing.equal_positions("kept_sig", "sig", cfg.permutations) / cfg.permutations
        least = near.select("id", F.struct("kept_id", equal.alias("similarity")).alias("by")).groupBy("id").agg(F.min("by").alias("by"))
        cause = cause.unionByName(least.select("id", "by.kept_id", "by.similarity"))
    by_signature = reps.join(cause, "id").drop("id")
    found = signed.select(order, "sig").join(by_signature, "sig").filter(F.col(order) != F.col("kept_id"))
    return found.select(order, "kept_id", "similarity")


def _without_loners(members: DataFrame, reps: DataFrame, cfg: DedupConfig, small_bucket: int, hot_rows: int) -> DataFrame:
    """Take out of large buckets the documents that cannot have a near-duplicate there.

    Near-duplicates differ in few positions. A document with more values of its own than that, among all
    documents of large buckets, has no partner in them. So boilerplate that puts many unlike documents
    into one bucket costs one grouped count, whatever the size of the bucket.
    """
    sizes = materialize(key_sizes(members, "bucket").filter(F.col("n") > small_bucket), "sizes")
    if sizes.isEmpty():
        return members
    hot = hot_keys(sizes, "bucket", task_rows=hot_rows)
    large = materialize(skew_join(members.select("bucket", "id"), sizes.select("bucket"), "bucket", hot, "left_semi"), "large")
    values = reps.join(large.select("id").distinct(), "id", "left_semi").select("id", F.posexplode("sig").alias("at", "value"))
    by_value = values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).filter("n = 1")
    loners = by_value.groupBy("id").agg(F.count(F.lit(1)).alias("own")).filter(F.col("own") > cfg.permutations - min_equal_positions(cfg))
    gone = large.join(loners.select("id"), "id", "left_semi")
    return materialize(members.join(gone, ["bucket", "id"], "left_anti"), "members")


def _prefix_members(reps: DataFrame, cfg: DedupConfig, hot_rows: int) -> DataFrame | None:
    """(bucket, id, sig) for the rarest bands of each document that meet another document."""
    bands = reps.select("id", F.explode(band_buckets("sig", cfg)).alias("bucket"))
    sizes = materialize(key_sizes(bands, "bucket").filter("n > 1"), "sizes")
    met = skew_join(bands, sizes, "bucket", hot_keys(sizes, "bucket", task_rows=hot_rows))
    prefix = cfg.bands - shared_bands(cfg) + 1
    # a document's bands of its own are rarer than the ones collected here and come first
    rarest = (
        met.groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("n", "bucket"))).alias("bands"))
        .withColumn("take", F.lit(prefix - cfg.bands) + F.size("bands"))
        .filter("take > 0")
        .select("id", F.explode(F.slice("bands", 1, F.col("take"))).alias("b"))
        .select("id", F.col("b.bucket").alias("bucket"))
    )
    members = materialize(rarest.join(reps, "id").select("bucket", "id", "sig"), "members")
    return None if members.isEmpty() else members


def _cut(members: DataFrame, reps: DataFrame, cfg: DedupConfig, small_bucket: int, hot_rows: int) -> DataFrame:
    """Replace large buckets by those of their members that share one more value.

    Values held by all members of a bucket are set aside. Of the others, near-duplicates share all but
    ``differing`` ones, so they meet at one of the ``differing + 1`` rarest values of each. A bucket whose
    common values alone reach the threshold holds near-duplicates only and stays; the first probe clears it.
    A bucket also stays where its parts would take more than half as many comparisons as itself. So rows
    multiply only while comparisons shrink. Returns ``members`` itself when there was nothing to cut.
    """
    differing = cfg.permutations - min_equal_positions(cfg)
    sizes = materialize(key_sizes(members, "bucket").filter(F.col("n") > small_bucket), "sizes")
    if sizes.isEmpty():
        return members
    hot = hot_keys(sizes, "bucket", task_rows=hot_rows)
    large = materialize(skew_join(members.select("bucket", "id", "sig"), sizes.withColumnRenamed("n", "of"), "bucket", hot), "large")
    values = large.select("bucket", "id", "of", F.posexplode("sig").alias("at", "value"))
    values = values.select("bucket", "id", "of", F.xxhash64("bucket", "at", "value").alias("key"))
    counts = materialize(values.groupBy("bucket", "of", "key").agg(F.count(F.lit(1)).alias("n")), "values")
    common = counts.filter("n = of").groupBy("bucket").agg(F.count(F.lit(1)).alias("common"))
    alike = common.filter(F.col("common") >= cfg.permutations - differing).select("bucket")
    others = counts.filter("n < of").join(alike, "bucket", "left_anti").select("key", "n")
    met = skew_join(values.select("bucket", "id", "key"), others, "key", hot_keys(others, "key", task_rows=hot_rows), exploded=True)
    rarest = F.slice(F.sort_array(F.collect_list(F.struct("n", "key"))), 1, differing + 1)
    finer = met.groupBy("bucket", "id").agg(rarest.alias("keys")).select("bucket", "id", F.explode("keys").alias("k"))
    finer = materialize(finer.filter("k.n > 1").select("bucket", "id", F.col("k.key").alias("key")), "finer")
    parts = finer.groupBy("bucket", "key").agg(F.count(F.lit(1)).cast("double").alias("n"))
    parts = parts.groupBy("bucket").agg(F.sum(F.col("n") * F.col("n")).alias("work"))
    costly = sizes.join(parts, "bucket").filter(F.col("work") * 2 > F.col("n").cast("double") * F.col("n")).select("bucket")
    stay = materialize(costly.unionByName(alike).distinct(), "stay")
    if stay.join(sizes, "bucket").count() == sizes.count():
        return members
    cut = finer.join(stay, "bucket", "left_anti").select("id", F.col("key").alias("bucket"))
    small = skew_join(members, sizes.select("bucket"), "bucket", hot, "left_anti")
    kept = skew_join(large, stay, "bucket", hot, "left_semi")
    return materialize(union_all([d.select("bucket", "id", "sig") for d in (cut.join(reps.select("id", "sig"), "id"), small, kept)]), "members")


def link_counts(
    signed: DataFrame, cfg: DedupConfig = DedupConfig(), order: str = "doc_id", small_bucket: int = SMALL_BUCKET, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(``order``, class_id, n_links) of every document: the first document with its signature, and the number of
    documents that are near-duplicates of it.

    Documents with one signature form a class. Classes are compared, with their sizes as multiplicities,
    so copies cost nothing. A pair of classes may meet in several buckets and counts in the first one that
    both have, so pairs are summed up where they are found and never listed.
    """
    reps = materialize(signed.groupBy("sig").agg(F.min(order).alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    links = reps.select("id", F.lit(None).cast("bigint").alias("other"))
    members = _prefix_members(reps.select("id", "sig"), cfg, hot_rows)
    if members is not None:
        for _ in range(MAX_CUTS):
            before, members = members, _cut(members, reps, cfg, small_bucket, hot_rows)
            if members is before:
                break
        lists = members.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
        rows = materialize(members.select("bucket", "id").distinct().join(lists, "id").join(reps, "id"), "members")
        sizes = materialize(key_sizes(rows, "bucket").filter("n > 1"), "sizes")
        # a hot bucket's rows are dealt, and met by all of them
        hot = hot_keys(sizes, "bucket", task_rows=hot_rows)
        rows = skew_join(rows, sizes.select("bucket"), "bucket", hot, "left_semi")
        others = rows.select("bucket", *[F.col(c).alias(f"other_{c}") for c in ("id", "sig", "buckets", "copies")])
        first = F.array_min(F.array_intersect("buckets", "other_buckets")) == F.col("bucket")
        near = is_near_duplicate("sig", "other_sig", cfg) & (F.col("id") != F.col("other_id")) & first
        met = skew_join(rows, others, "bucket", hot, condition=near)
        links = met.groupBy("id").agg(F.sum("other_copies").alias("other"))
    per_class = reps.join(links, "id", "left").select(
        "sig", F.col("id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("other", F.lit(0))).alias("n_links")
    )
    return signed.select(order, "sig").join(per_class, "sig").select(order, "class_id", "n_links")


def _round(
    members: DataFrame, cfg: DedupConfig, probes: int, small_bucket: int, hot_rows: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """One round. Returns the ids dropped in it and the members that remain undecided."""
    sizes = materialize(key_sizes(members, "bucket").filter("n > 1"), "sizes")
    hot = hot_keys(sizes, "bucket", task_rows=hot_rows)
    large = sizes.filter(F.col("n") > small_bucket)
    probed = members.select("bucket", F.col("id").alias("probe"), F.col("sig").alias("probe_sig"))
    all_small = large.isEmpty()
    if not all_small:
        # the rank filter is applied inside the map tasks, so a large bucket sends few rows
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("probe"))
        probed = (
            probed.withColumn("rank", rank)
            .filter(F.col("rank") <= max(small_bucket, probes))
            .join(sizes, "bucket")
            .filter((F.col("n") <= small_bucket) | (F.col("rank") <= probes))
            .drop("rank", "n")
        )
        probed = materialize(probed, "probes")
    earlier = F.col("probe") < F.col("id")
    similar = is_near_duplicate("probe_sig", "sig", cfg)
    pairs = skew_join(members, probed, "bucket", hot, condition=earlier & similar)
    edges = materialize(pairs.select("probe", "id").distinct(), "edges")
    if all_small:
        return _decide(edges, None, hot_rows)[0], None
    last = probed.join(large, "bucket", "left_semi").groupBy("bucket").agg(F.max("probe").alias("last_probe"))
    behind = skew_join(
        members.select("bucket", "id"), last, "bucket", hot, condition=F.col("id") > F.col("last_probe")
    )
    open_ids = materialize(behind.select("id").distinct(), "open")
    dropped, waiting = _decide(edges, open_ids, hot_rows)
    undecided = open_ids.unionByName(waiting.select("id")).distinct()
    if dropped is not None:
        undecided = undecided.join(dropped, "id", "left_anti")
    rest = materialize(members.join(undecided, "id", "left_semi"), "members")
    return dropped, None if rest.isEmpty() else rest


def _decide(
    edges: DataFrame, open_ids: DataFrame | None, hot_rows: int
) -> tuple[DataFrame | None, DataFrame]:
    """Settle what the known edges settle.

    A probe without an undecided earlier neighbour is kept, unless it is open (not yet compared
    with all earlier members of its buckets), and what it reaches is dropped. Repeats until no
    edge is left or only edges behind open documents are. Returns the dropped ids and the edges
    that have to wait.
    """
    dropped = []
    hot = None
    if edges.count() > hot_rows:
        hot = hot_keys(materialize(key_sizes(edges, "probe"), "sizes"), "probe", task_rows=hot_rows)
    while not edges.isEmpty():
        blocked = edges.select(F.col("id").alias("probe"))
        if open_ids is not None:
            blocked = blocked.unionByName(open_ids.select(F.col("id").alias("probe")))
        kept = edges.select("probe").distinct().join(blocked.distinct(), "probe", "left_anti")
        lost = materialize(skew_join(edges, kept, "probe", hot, "left_semi").select("id").distinct(), "dropped")
        if lost.isEmpty():
            break
        dropped.append(lost)
        alive = edges.join(lost, "id", "left_anti")
        lost_probe = lost.withColumnRenamed("id", "probe")
        edges = materialize(skew_join(alive, lost_probe, "probe", hot, "left_anti"), "edges")
    return (union_all(dropped) if dropped else None), edges

