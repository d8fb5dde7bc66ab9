import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.operators.ordering import running_total
from textloom.operators.packing import assembled, assign_shards, pack, placed_slices, shard_statistics, token_offsets
from textloom.operators.sampling import byte_budget, first_rows
from textloom.sources.tokenshard import arranged


def packed_by_loop(docs, seq_len, limit=None):
    buffer, out = [], []
    for _, tokens in docs:
        buffer += tokens
        while len(buffer) >= seq_len:
            out.append(buffer[:seq_len])
            buffer = buffer[seq_len:]
        if limit and len(out) >= limit:
            break
    return out


def token_docs(seed, ids):
    rng = random.Random(seed)
    return [(i, [rng.randrange(100) for _ in range(rng.choice([0, 1, 3, 7, 40]))]) for i in ids]


@pytest.mark.parametrize("limit", [None, 3, 1000])
@pytest.mark.parametrize("seq_len", [1, 8, 13])
def test_pack_equals_sequential_packing(spark, seq_len, limit):
    docs = token_docs(seq_len, sorted(random.Random(5).sample(range(10_000), 60)))
    df = spark.createDataFrame(docs, "doc_id bigint, tokens array<int>")
    rows = pack(df, seq_len, max_sequences=limit).orderBy("seq_id").collect()
    assert [r.seq_id for r in rows] == list(range(len(rows)))
    assert [list(r.tokens) for r in rows] == packed_by_loop(docs, seq_len, limit)


def test_pack_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, tokens array<int>")
    assert pack(df, 4).count() == 0


@pytest.mark.parametrize("cell_rows", [1, 3, 1000])
def test_running_total_handles_clustered_and_wide_orders(spark, cell_rows):
    ids = [*range(50), *range(10**12, 10**12 + 30), -(2**62), 2**62, *range(777, 7_000_000, 99_999)]
    rows = [(i, (i * 7) % 11, "ab"[i % 2]) for i in ids]
    df = spark.createDataFrame(rows, "id bigint, w bigint, g string")
    got = {r.id: r.t for r in running_total(df, "id", F.col("w"), by=["g"], out="t", cell_rows=cell_rows).collect()}
    expected, seen = {}, {"a": 0, "b": 0}
    for i, w, g in sorted(rows):
        expected[i] = seen[g]
        seen[g] += w
    assert got == expected


def test_byte_budget_keeps_the_crossing_row(spark):
    df = spark.createDataFrame([(1, "aé"), (2, "bb"), (3, "c")], "doc_id bigint, text string")
    kept = lambda budget: [r.doc_id for r in byte_budget(df, "doc_id", budget).orderBy("doc_id").collect()]
    assert kept(0) == []
    assert kept(1) == [1]
    assert kept(3) == [1]
    assert kept(4) == [1, 2]
    assert kept(100) == [1, 2, 3]


def test_first_rows(spark):
    df = spark.range(30_000).withColumnRenamed("id", "doc_id")
    assert first_rows(df, "doc_id", None).count() == 30_000
    assert first_rows(df, "doc_id", 7).agg(F.max("doc_id")).first()[0] == 6
    assert first_rows(df, "doc_id", 20_000).agg(F.max("doc_id"), F.count("*")).first() == (19_999, 20_000)


def test_shards_number_sequences_per_split(spark):
    seqs = spark.range(400).withColumnRenamed("id", "seq_id").withColumn("tokens", F.array(F.lit(1)))
    placed = assign_shards(seqs, 16, val_fraction=0.25)
    rows = placed.orderBy("seq_id").collect()
    seen = {"train": 0, "val": 0}
    for r in rows:
        size = 16 if r.split == "train" else 4
        assert (r.shard_id, r.seq_in_shard) == divmod(seen[r.split], size)
        seen[r.split] += 1
    assert 50 < seen["val"] < 150
    assert shard_statistics(placed).agg(F.sum("sequences")).first()[0] == 400


def test_first_rows_with_ties(spark):
    rows = [(i // 3, i % 3, f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "at bigint, n bigint, text string")
    for limit in (1, 4, 20, 59, 60, 100):
        got = sorted((r["at"], r["n"]) for r in first_rows(df, "at", limit, tie=("n",)).collect())
        assert got == sorted((a, n) for a, n, _ in rows)[:limit]
    with pytest.raises(ValueError, match="tie-breaker"):
        first_rows(df, "at", 4)


def exchanges_with_tokens(df):
    """How many exchanges of the plan carry token arrays."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = re.findall(r"\(\d+\) Exchange\n(?:Output|Input)[^\n]*: \[([^\n]*)\]", text)
    assert nodes
    return sum("tokens#" in columns.replace("n_tokens#", "") for columns in nodes)


def test_token_arrays_move_at_most_twice(spark):
    docs = spark.createDataFrame(token_docs(3, range(300)), "doc_id bigint, tokens array<int>")
    narrow = docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"))
    offsets = token_offsets(narrow)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = placed_slices(docs, offsets, 8, 40, 4)
        assert exchanges_with_tokens(arranged(parts)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_long_document_is_cut_once(spark):
    docs = [(1, [7] * 3), (2, list(range(50_000))), (3, [9] * 5)]
    df = spark.createDataFrame(docs, "doc_id bigint, tokens array<int>")
    rows = pack(df, 16).orderBy("seq_id").collect()
    assert [list(r.tokens) for r in rows] == packed_by_loop(docs, 16)


def test_slices_have_the_places_of_whole_sequences(spark):
    docs = spark.createDataFrame(token_docs(11, range(80)), "doc_id bigint, tokens array<int>")
    offsets = token_offsets(docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens")))
    whole = assign_shards(pack(docs, 8), 8, 0.2)
    count = whole.count()
    key = lambda r: (r.seq_id, r.split, r.shard_id, r.seq_in_shard, list(r.tokens))
    got = assembled(placed_slices(docs, offsets, 8, count, 8, 0.2)).collect()
    assert count > 20 and sorted(map(key, got)) == sorted(map(key, whole.collect()))


def test_exploded_cuts_are_dealt_and_not_sent_through_the_driver(spark, tmp_path):
    # 20 rows of offsets stand for 100,000 cuts, which Spark takes for as small as those rows
    rows = spark.range(20).select(F.col("id").alias("doc_id"), F.sequence(F.lit(0), F.lit(19_999)).alias("tokens"))
    rows.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    token_offsets(docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"))).write.parquet(f"{tmp_path}/offsets")
    offsets = spark.read.parquet(f"{tmp_path}/offsets")
    parts, packed = placed_slices(docs, offsets, 4, 100_000, 512), pack(docs, 4, offsets=offsets)
    for df, joins in ((parts, ["doc_id", "seq_id"]), (packed, ["doc_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastHashJoin \[(doc|seq)_id#", plan)
        assert sorted(re.findall(r"SortMergeJoin \[(doc_id|seq_id)#", plan)) == joins
    found = parts.agg(F.count("*"), F.sum(F.size("tokens")), F.countDistinct("seq_id")).first()
    assert tuple(found) == (100_000, 400_000, 100_000)
    assert tuple(packed.agg(F.count("*"), F.min(F.size("tokens"))).first()) == (100_000, 4)
