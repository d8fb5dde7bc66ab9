import random
import zlib

from textloom.llm import range_shards as rs

SCHEMA = "doc_id bigint, text string, size string, key int, shard int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], SCHEMA)


def check(rows, got, shards=16):
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest, mean = max(r["size"] for r in got), sum(sizes) / shards
    assert all(abs(s - mean) <= largest for s in sizes)


def test_bytes_are_even_despite_a_hot_text(spark):
    rng = random.Random(2)
    rows = [(i, "hot text é" * 3 if i % 3 == 0 else "x" * rng.randrange(0, 90)) for i in range(4000)] + [(9000, None), (9001, None)]
    check(rows, rs.shard_documents(table(spark, rows)).collect())


def test_ranges_are_cut_where_overfull(spark):
    rows = [(i, "same") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(500)]
    placed = rs.shard_documents(table(spark, rows))
    counts = {r["range"]: r["count"] for r in placed.groupBy("range").count().collect()}
    # 3000 equal texts are spread over many ranges
    assert max(counts.values()) < 200
    check(rows, placed.collect())


def test_repeated_and_few_rows(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, None)]
    check(rows, rs.shard_documents(table(spark, rows)).collect())
    assert rs.shard_documents(table(spark, [])).collect() == []
    assert rs.shard_documents(table(spark, [])).columns == rs.shard_documents(table(spark, rows)).columns


def test_ordered_ranges_and_reruns(spark):
    rows = [(i, f"text {i % 700}") for i in range(2000)]
    first = sorted(rs.shard_documents(table(spark, rows)).collect(), key=lambda r: r["doc_id"])
    again = sorted(rs.shard_documents(table(spark, rows[::-1])).collect(), key=lambda r: r["doc_id"])
    assert first == again


def test_one_huge_record(spark):
    rows = [(i, "x" * 10) for i in range(300)] + [(999, "y" * 100_000)]
    check(rows, rs.shard_documents(table(spark, rows)).collect())


def test_written_shards(spark, tmp_path):
    docs = table(spark, [(i, f"t{i}") for i in range(500)]).drop("shard")
    rs.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.select("shard").distinct().count() == 4


def test_range_numbers_search_pairs():
    import numpy as np

    cuts = [(1, 5), (3, 2), (3, 8), (9, 0)]
    keys, ids = np.array([0, 1, 1, 3, 3, 3, 9, 9, 10]), np.array([9, 4, 5, 1, 2, 9, -1, 0, 0])
    want = [sum(c <= (k, i) for c in cuts) for k, i in zip(keys.tolist(), ids.tolist())]
    assert rs.range_numbers(keys, ids, cuts).tolist() == want


def test_written_rows_keep_missing_and_repeated_ids(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i // 6, f"t{i % 50}" if i % 7 else None, f"c{i}") for i in range(400)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, tag string, slot int")
    rs.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]), r[2])
    assert sorted(((r["doc_id"], r["text"], r["tag"]) for r in back), key=key) == sorted(rows, key=key)
    for shard in range(4):
        slots = sorted(r["slot"] for r in back if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_draws_follow_the_sizes_whatever_passes_the_bar(spark):
    # one record holds nearly all bytes, so few others pass the first bar
    rows = spark.createDataFrame([(i, i * 7919, 1) for i in range(500)] + [(1000, -5, 10**7)], "doc_id bigint, key bigint, size bigint")
    got = rs.draw(rows, 100)
    assert len(got) == 100 and (-5, 1000) in got and got == sorted(got)
    assert len(rs.draw(rows, 5000)) == 501
