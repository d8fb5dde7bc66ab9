import random
import shutil

import pytest
from pyspark.sql import functions as F

from textloom.config import CorpusConfig, DedupConfig
from textloom.operators import dedup
from textloom.plans import corpus_prep
from textloom.streaming import incremental, signature_store


def one_by_one(rows, cfg):
    """The sequential rule: compare with all kept documents that share a band."""
    width = max(1, cfg.permutations // cfg.bands)
    kept, index, ids = [], {}, []
    for doc, sig in sorted(rows):
        keys = [(b, tuple(sig[b * width : b * width + width])) for b in range(cfg.bands)]
        near = {i for key in keys for i in index.get(key, [])}
        same = lambda i: sum(x == y for x, y in zip(sig, kept[i])) / len(sig)
        if any(same(i) >= cfg.threshold for i in near):
            continue
        for key in keys:
            index.setdefault(key, []).append(len(kept))
        kept.append(sig)
        ids.append(doc)
    return ids


def kept_ids(spark, rows, cfg=DedupConfig(), **options):
    df = spark.createDataFrame(rows, "doc_id bigint, sig array<int>")
    return sorted(r.doc_id for r in dedup.first_kept_wins(df, cfg, **options).collect())


def changed(sig, positions, rng):
    out = list(sig)
    for p in positions:
        out[p] = rng.randrange(10**6, 10**9)
    return out


def test_threshold_is_inclusive(spark):
    rng = random.Random(0)
    base = [rng.randrange(10**6) for _ in range(64)]
    rows = [(1, base), (2, changed(base, range(9), rng)), (3, changed(base, range(20, 30), rng))]
    assert kept_ids(spark, rows) == [1, 3]


def test_chain_keeps_the_far_end(spark):
    rng = random.Random(1)
    a = [rng.randrange(10**6) for _ in range(64)]
    b = changed(a, range(8), rng)
    c = changed(b, range(30, 38), rng)
    d = changed(c, range(50, 58), rng)
    assert kept_ids(spark, [(1, a), (2, b), (3, c), (4, d)]) == one_by_one([(1, a), (2, b), (3, c), (4, d)], DedupConfig()) == [1, 3]


def test_empty_and_identical_signatures(spark):
    rng = random.Random(2)
    sig = [rng.randrange(10**6) for _ in range(64)]
    rows = [(5, [0] * 64), (6, [0] * 64), (7, sig), (9, sig), (8, sig)]
    assert kept_ids(spark, rows) == [5, 7]
    assert kept_ids(spark, []) == []


def family(rng, size, cfg, spread):
    """Relatives of one signature: some near, some only sharing bands."""
    base = [rng.randrange(10**6) for _ in range(cfg.permutations)]
    return [changed(base, rng.sample(range(cfg.permutations), rng.choice(spread)), rng) for _ in range(size)]


@pytest.mark.parametrize("seed,small_bucket,hot_rows", [(1, 64, 100_000), (2, 4, 100_000), (3, 2, 5), (4, 8, 3)])
def test_random_families_equal_the_sequential_rule(spark, seed, small_bucket, hot_rows):
    rng = random.Random(seed)
    cfg = DedupConfig()
    sigs = family(rng, 60, cfg, [1, 4, 6, 9, 12, 20]) + family(rng, 30, cfg, [2, 5, 8])
    sigs += [[rng.randrange(10**6) for _ in range(64)] for _ in range(30)]
    rng.shuffle(sigs)
    rows = list(enumerate(sigs))
    assert kept_ids(spark, rows, cfg, small_bucket=small_bucket, hot_rows=hot_rows) == one_by_one(rows, cfg)


def test_unlike_documents_in_one_hot_bucket(spark):
    """A band shared by everybody, as boilerplate makes it."""
    rng = random.Random(7)
    cfg = DedupConfig()
    shared = [rng.randrange(10**6) for _ in range(32)]
    sigs = [shared + [rng.randrange(10**6) for _ in range(32)] for _ in range(20)]
    sigs += [changed(sigs[i], rng.sample(range(64), 6), rng) for i in range(5)]
    rows = list(enumerate(sigs))
    assert kept_ids(spark, rows, cfg, small_bucket=2, hot_rows=5) == one_by_one(rows, cfg)


@pytest.mark.parametrize("cfg", [DedupConfig(32, 8, 0.5), DedupConfig(20, 6, 0.3), DedupConfig(16, 16, 1.0)])
def test_other_settings(spark, cfg):
    rng = random.Random(11)
    sigs = family(rng, 40, cfg, [1, 3, 5, 8, 10, 13])
    rows = list(enumerate(sigs))
    assert kept_ids(spark, rows, cfg, small_bucket=4) == one_by_one(rows, cfg)


def test_boilerplate_buckets_take_no_more_rounds_when_they_grow(spark, monkeypatch):
    rng = random.Random(21)
    base = [rng.randrange(10**6) for _ in range(64)]
    rounds = []
    whole = dedup._round
    monkeypatch.setattr(dedup, "_round", lambda *a: rounds.append(1) or whole(*a))
    counts = []
    for n in (100, 3000):
        # nine bands in common, otherwise unlike; and one true copy
        rows = [(i, changed(base, range(36, 64), rng)) for i in range(n)]
        rows.append((n, changed(rows[5][1], range(40, 44), rng)))
        rounds.clear()
        assert kept_ids(spark, rows) == list(range(n))
        counts.append(len(rounds))
    assert counts[1] <= counts[0] + 1 <= 3


def test_boilerplate_with_repeating_values_takes_no_more_jobs_when_it_grows(spark, monkeypatch):
    """36 positions in common, and every other value held by about three documents."""
    rng = random.Random(4)
    base = [rng.randrange(10**6) for _ in range(64)]
    tables = []
    whole = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, label: tables.append(label) or whole(df, label))
    counts = []
    for n in (300, 3000):
        sigs = [base[:36] + [p * 10**7 + rng.randrange(n // 3) for p in range(36, 64)] for _ in range(n)]
        sigs += [changed(sigs[9], range(40, 45), rng), changed(sigs[10], range(3, 13), rng)]
        rows = list(enumerate(sigs))
        tables.clear()
        assert kept_ids(spark, rows) == [i for i in range(n + 2) if i != n]
        counts.append(len(tables))
    assert counts[1] <= counts[0] + 2


@pytest.mark.parametrize("small_bucket,hot_rows", [(64, 100_000), (6, 7)])
def test_link_counts_equal_all_pairs(spark, small_bucket, hot_rows):
    cfg = DedupConfig()
    rng = random.Random(small_bucket)
    shared = [rng.randrange(10**6) for _ in range(40)]
    sigs = family(rng, 40, cfg, [1, 4, 6, 9, 12]) + [shared + [rng.randrange(5) for _ in range(24)] for _ in range(30)]
    sigs += [sigs[0], sigs[0], sigs[50], [0] * 64, [0] * 64]
    rows = list(enumerate(sigs))
    near = lambda a, b: sum(x == y for x, y in zip(a, b)) / 64 >= cfg.threshold
    want = {(i, sigs.index(a), sum(near(a, b) for b in sigs) - 1) for i, a in rows}
    df = spark.createDataFrame(rows, "doc_id bigint, sig array<int>")
    got = dedup.link_counts(df, cfg, small_bucket=small_bucket, hot_rows=hot_rows)
    assert {tuple(r) for r in got.collect()} == want
    assert dedup.link_counts(df.limit(0)).collect() == []


def test_dropped_by_names_the_first_kept_document(spark):
    cfg = DedupConfig()
    rng = random.Random(5)
    rows = list(enumerate(family(rng, 30, cfg, [1, 3, 5, 8]) + family(rng, 5, cfg, [1, 2])))
    rows += [(100, rows[0][1]), (101, rows[31][1]), (102, rows[31][1])]
    kept = set(one_by_one(rows, cfg))
    sigs = dict(rows)
    want = {}
    for i, sig in rows:
        if i not in kept:
            near = [(k, sum(x == y for x, y in zip(sig, sigs[k])) / 64) for k in sorted(kept) if k < i]
            want[i] = next((k, s) for k, s in near if s >= cfg.threshold)
    df = spark.createDataFrame(rows, "doc_id bigint, sig array<int>")
    for small in (2, 64):
        got = {r.doc_id: (r.kept_id, r.similarity) for r in dedup.dropped_by(df, cfg, small_bucket=small).collect()}
        assert got == want


def test_more_bands_than_positions_is_refused():
    with pytest.raises(ValueError):
        dedup.band_rows(DedupConfig(permutations=8, bands=16))


def signed_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, sig array<int>")


def feed_index(spark, path, batches, **options):
    """Survivors of several batches, one after the other."""
    index = incremental.KeptIndex(signature_store.SignatureStore(spark, path, **options), DedupConfig())
    kept = []
    for batch_id, rows in enumerate(batches):
        signed = signed_rows(spark, rows)
        got = index.survivors(signed, batch_id)
        ids = sorted(r.doc_id for r in got.collect())
        index.add(signed.filter(F.col("doc_id").isin(ids)), batch_id, max((i for i, _ in rows), default=0))
        kept += ids
    return index, kept


def test_store_in_ranges_with_merges_equals_the_sequential_rule(spark, tmp_path):
    rng = random.Random(8)
    cfg = DedupConfig()
    sigs = family(rng, 40, cfg, [1, 4, 6, 9, 12]) + [[rng.randrange(10**6) for _ in range(64)] for _ in range(20)]
    sigs += [changed(s, rng.sample(range(64), 5), rng) for s in sigs[40:50]]
    rows = list(enumerate(sigs))
    batches = [rows[i : i + 14] for i in range(0, 70, 14)] + [[]]
    index, kept = feed_index(spark, str(tmp_path / "s"), batches, range_rows=16, merge_at=2)
    assert kept == one_by_one(rows, cfg)
    live = index.store.segments()
    assert len([s for s in live if s.table == "buckets"]) <= 3 and max(s.level for s in live) == 2
    assert {s.rows for s in live if s.table == "signatures" and s.level == 2} and max(s.bits for s in live) >= 3
    index.store.remove_unused(1)
    assert index.store.segments() == live and len(index.store.versions()) == 1


def test_lookups_read_only_the_ranges_they_touch(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, [rng.randrange(10**6) for _ in range(64)]) for i in range(200)]
    index, _ = feed_index(spark, str(tmp_path / "s"), [rows], range_rows=20)
    segment = next(s for s in index.store.segments() if s.table == "buckets")
    assert segment.bits == 7 and len(segment.ranges) > 100
    keys = index._bands_of(signed_rows(spark, rows[:1])).select("bucket")
    found = index.store.find("buckets", keys, 1)
    files = {f.split("range=")[1].split("/")[0] for f in found.inputFiles() if "range=" in f}
    assert 0 < len(files) <= 10
    assert {r.id for r in found.collect()} == {0}
    reach = index.in_reach(signed_rows(spark, rows[:1]), 1)
    assert [r.id for r in reach.collect()] == [0] and len([f for f in reach.inputFiles() if "/signatures/" in f]) == 1


def test_a_damaged_store_is_an_error(spark, tmp_path):
    rng = random.Random(10)
    rows = [(i, [rng.randrange(10**6) for _ in range(64)]) for i in range(20)]
    path = tmp_path / "s"
    index, _ = feed_index(spark, str(path), [rows], range_rows=20)
    segment = next(s for s in index.store.segments() if s.table == "buckets")
    shutil.rmtree(path / "buckets" / segment.name / f"range={segment.ranges[0]}")
    with pytest.raises(signature_store.DamagedStore):
        index.store.find("buckets", index._bands_of(signed_rows(spark, rows)).select("bucket"), 1).count()
    shutil.rmtree(path / "manifest")
    with pytest.raises(signature_store.DamagedStore):
        index.in_reach(signed_rows(spark, rows), 1)
    # segments of a batch that never got its manifest are no damage: the batch is done again
    assert index.in_reach(signed_rows(spark, rows), 0) is None


def test_ids_that_go_back_are_refused_or_kept_in_arrival_order(spark, documents, tmp_path):
    docs = documents.select("doc_id", "text", "lang").filter("lang = 'en'").limit(30)
    for ordered in (True, False):
        feed, out, index, state = (str(tmp_path / f"{n}{ordered}") for n in ("feed", "out", "index", "state"))
        run = lambda: incremental.dedup_stream(
            spark.readStream.schema(docs.schema).parquet(feed), out, index, state, ordered=ordered
        ).awaitTermination()
        docs.withColumn("doc_id", F.col("doc_id") + 1000).write.mode("append").parquet(feed)
        run()
        docs.write.mode("append").parquet(feed)
        if ordered:
            with pytest.raises(Exception, match="feed in id order"):
                run()
        else:
            run()
            # the same texts came before
            assert spark.read.parquet(out).filter("doc_id < 1000").count() == 0


def test_stream_equals_batch_and_survives_replay(spark, documents, tmp_path):
    docs = documents.select("doc_id", "text", "lang")
    feed, out, index = (str(tmp_path / n) for n in ("feed", "out", "index"))
    for low, high in ((0, 60), (60, 61), (61, 200)):
        docs.filter((F.col("doc_id") >= low) & (F.col("doc_id") < high)).coalesce(1).write.mode("append").parquet(feed)
    for state in ("s1", "s2"):  # the second run replays every batch over the same folders
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(feed)
        query = incremental.dedup_stream(stream, out, index, str(tmp_path / state))
        query.awaitTermination()
        got = sorted(r.doc_id for r in spark.read.parquet(out).collect())
        assert got == sorted(r.doc_id for r in corpus_prep.unique_ids(docs, CorpusConfig()).collect())


def test_values_of_large_buckets_are_dealt_and_not_sent_through_the_driver(spark, tmp_path):
    rng = random.Random(21)
    shared = [rng.randrange(10**6) for _ in range(40)]
    # one bucket; each two documents share 40 of 64 values, and pairs of neighbours 20 more
    rows = []
    for i in range(3000):
        own = random.Random(i // 2)
        rows.append((1, i, shared + [own.randrange(10**6, 10**9) for _ in range(20)] + [rng.randrange(10**6, 10**9) for _ in range(4)]))
    spark.createDataFrame(rows, "bucket bigint, id bigint, sig array<int>").write.parquet(f"{tmp_path}/members")
    members = spark.read.parquet(f"{tmp_path}/members")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "2m")
    try:
        cut = dedup._cut(members, members.select("id", "sig"), DedupConfig(), dedup.SMALL_BUCKET, dedup.HOT_ROWS)
        by_bucket = cut.groupBy("bucket").agg(F.sort_array(F.collect_set("id")).alias("ids")).select("ids").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert sorted(r.ids for r in by_bucket) == [[i, i + 1] for i in range(0, 3000, 2)]
