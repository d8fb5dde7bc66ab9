import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators.packing import assign_shards
from textloom.sources.synthetic import synthetic_splits, synthetic_tokens
from textloom.sources.tokenshard import (
    TokenShardReader,
    TokenShardWriter,
    lookup,
    read_token_shards,
    read_version,
    scan_token_shards,
    write_token_shards,
)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shards") / "out")
    seqs = spark.range(100).select(
        F.col("id").alias("seq_id"),
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda p: (F.col("id") * 8 + p).cast("int")).alias("tokens"),
    )
    placed = assign_shards(seqs, 12, val_fraction=0.2)
    write_token_shards(placed, path, 8)
    return path, placed.orderBy("seq_id").collect()


def test_files_hold_the_sequences_in_order(written, tmp_path):
    path, rows = written
    from pathlib import Path

    names = sorted(p.name for p in Path(path).iterdir())
    train = [r for r in rows if r.split == "train"]
    assert names[0] == "train_000000.bin" and f"train_{(len(train) - 1) // 12:06d}.bin" in names
    assert not [n for n in names if n.startswith("_")]
    data = np.fromfile(f"{path}/train_000001.bin", dtype="<u2").reshape(-1, 8).tolist()
    assert data == [r.tokens for r in train[12:24]]


def test_read_back_and_lookup(spark, written):
    path, rows = written
    for split in ("train", "val"):
        expected = [r.tokens for r in rows if r.split == split]
        shards = read_token_shards(spark, path, 8, split)
        got = shards.orderBy("global_idx").collect()
        assert [r.tokens for r in got] == expected
        assert [r.global_idx for r in got] == list(range(len(expected)))
        assert lookup(shards, split, 7).first().tokens == expected[7]
    both = read_token_shards(spark, path, 8)
    assert both.count() == 100
    assert both.filter("split = 'val' and global_idx >= 2 and global_idx < 5").count() == 3


def test_reader_length_is_free_and_tails_are_ignored(spark, written):
    path, rows = written
    total = sum(np.fromfile(f, dtype="<u2").size // 5 for f in _files(path, "train"))
    assert read_token_shards(spark, path, 5, "train").count() == total


def _files(path, split):
    from pathlib import Path

    return sorted(Path(path).glob(f"{split}_*.bin"))


def test_filters_prune_files(written):
    from pyspark.sql.datasource import EqualTo

    path, _ = written
    reader = TokenShardReader(path, "train", 8)
    assert sum(len(task.ranges) for task in reader.partitions()) > 1
    list(reader.pushFilters([EqualTo(("global_idx",), 13)]))
    ((only,),) = [task.ranges for task in reader.partitions()]
    assert (only.shard_idx, only.first_local, only.count) == (1, 1, 1)


def test_missing_shards(spark, tmp_path):
    with pytest.raises(Exception, match="no train_"):
        read_token_shards(spark, str(tmp_path), 8, "train").count()


@pytest.mark.parametrize("tokens,message", [([1, 2, 65536], "16 bits"), ([1, 2], "3 tokens")])
def test_bad_sequences_are_refused(spark, tmp_path, tokens, message):
    df = spark.createDataFrame([("train", 0, 0, tokens)], "split string, shard_id long, seq_in_shard long, tokens array<int>")
    with pytest.raises(Exception, match=message):
        write_token_shards(df, str(tmp_path / "x"), 3)
    assert not list((tmp_path / "x").glob("*.bin"))


def test_largest_id_survives(spark, tmp_path):
    df = spark.createDataFrame([("val", 0, 0, [0, 65535])], "split string, shard_id long, seq_in_shard long, tokens array<int>")
    write_token_shards(df, str(tmp_path / "x"), 2)
    assert read_token_shards(spark, str(tmp_path / "x"), 2, "val").first().tokens == [0, 65535]


def test_synthetic_rows_depend_on_seed_plus_index(spark):
    a = {r.seq_id: r.tokens for r in synthetic_tokens(spark, 50, 6, 10, 3).collect()}
    b = {r.seq_id: r.tokens for r in synthetic_tokens(spark, 50, 6, 10, 4).collect()}
    assert a[5] == b[4] and all(0 <= t < 50 for row in a.values() for t in row)
    train, val = synthetic_splits(spark, 50, 6, 3)
    assert (train.count(), val.count()) == (4096, 512)


def test_shards_are_ordered_by_number(spark, tmp_path):
    for shard, value in ((999_999, 1), (1_000_000, 2)):
        np.full(8, value, "<u2").tofile(tmp_path / f"train_{shard:06d}.bin")
    shards = read_token_shards(spark, str(tmp_path), 8)
    assert lookup(shards, "train", 0).first().tokens == [1] * 8
    assert lookup(shards, "train", 1).first().tokens == [2] * 8


def test_an_unfinished_write_is_refused(spark, tmp_path):
    np.full(8, 1, "<u2").tofile(tmp_path / "train_000000.bin")
    (tmp_path / "_unfinished").touch()
    with pytest.raises(Exception, match="did not finish"):
        read_token_shards(spark, str(tmp_path), 8).collect()
    # writing again clears it, and shards of the old run go
    seqs = spark.createDataFrame([(0, [5] * 8)], "seq_id bigint, tokens array<int>")
    np.full(8, 1, "<u2").tofile(tmp_path / "train_000009.bin")
    write_token_shards(assign_shards(seqs, 12, val_fraction=0.0), str(tmp_path), 8)
    assert [r.tokens for r in read_token_shards(spark, str(tmp_path), 8).collect()] == [[5] * 8]


def constant_shards(spark, value, n=10):
    seqs = spark.range(n).select(F.col("id").alias("seq_id"), F.array_repeat(F.lit(value), 8).alias("tokens"))
    return assign_shards(seqs, 4, val_fraction=0.0)


def batch_of(rows):
    names = ["split", "shard_id", "seq_in_shard", "start", "tokens"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def test_a_write_that_breaks_off_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    write_token_shards(constant_shards(spark, 1), path, 8)
    # the tasks end, the driver dies before the switch
    broken = TokenShardWriter(path, 8, overwrite=True)
    broken.write(iter([batch_of([("train", 0, 0, 0, [2] * 8), ("train", 7, 0, 0, [2] * 8)])]))
    assert (tmp_path / f"train_000000-{broken.job}.bin").exists()
    values = lambda: {t for r in read_token_shards(spark, path, 8).collect() for t in r.tokens}
    assert values() == {1} and read_token_shards(spark, path, 8).count() == 10
    # and here during the write of the manifest
    broken = TokenShardWriter(path, 8, overwrite=True)
    message = broken.write(iter([batch_of([("train", 0, 0, 0, [3] * 8)])]))
    with monkeypatch.context() as patch:
        patch.setattr("textloom.sources.tokenshard.json.dumps", lambda x: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            broken.commit([message])
    assert values() == {1}
    write_token_shards(constant_shards(spark, 4, 6), path, 8)
    assert values() == {4} and read_token_shards(spark, path, 8).count() == 6
    # only the new version and the temporary folders of the dead writes are left
    left = [p.name for p in tmp_path.iterdir() if not p.name.startswith("_staging_")]
    assert len(left) == 3 and sum(name.endswith(".bin") for name in left) == 2


def test_a_retried_task_counts_once(spark, tmp_path):
    writer = TokenShardWriter(str(tmp_path), 8, overwrite=True)
    rows = [("train", 0, i, 0, [i] * 8) for i in range(3)]
    writer.write(iter([batch_of(rows)]))
    with pytest.raises(Exception, match="did not finish"):
        read_token_shards(spark, str(tmp_path), 8).count()
    writer.commit([writer.write(iter([batch_of(rows)])), None])
    assert [r.tokens[0] for r in read_token_shards(spark, str(tmp_path), 8).orderBy("global_idx").collect()] == [0, 1, 2]


def test_slices_are_put_together(spark, tmp_path):
    writer = TokenShardWriter(str(tmp_path), 4, overwrite=True)
    slices = [("val", 0, 0, 0, [1]), ("val", 0, 0, 1, [2, 3, 4]), ("val", 0, 1, 0, [5, 6, 7, 8])]
    writer.commit([writer.write(iter([batch_of(slices[:1]), batch_of(slices[1:])]))])
    assert [r.tokens for r in read_token_shards(spark, str(tmp_path), 4).orderBy("global_idx").collect()] == [[1, 2, 3, 4], [5, 6, 7, 8]]
    with pytest.raises(ValueError, match="4 tokens"):
        writer.write(iter([batch_of([slices[0], slices[2]])]))
    with pytest.raises(ValueError, match="not in order"):
        writer.write(iter([batch_of(slices[2:])]))


def test_appending_adds_to_the_manifest(spark, tmp_path):
    path = str(tmp_path)
    write_token_shards(constant_shards(spark, 1), path, 8)
    more = constant_shards(spark, 2, 4).withColumn("shard_id", F.col("shard_id") + 2)
    write_token_shards(more, path, 8, mode="append")
    version = read_version(path)
    assert version.number == 2 and [shard for _, shard, _, _ in version.shards] == [0, 1, 2]
    got = [r.tokens[0] for r in read_token_shards(spark, path, 8).orderBy("global_idx").collect()]
    assert got == [1] * 8 + [2] * 4


def test_lookup_goes_by_the_manifest(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    write_token_shards(constant_shards(spark, 1, 4000), str(tmp_path), 8)
    np.full(8, 9, "<u2").tofile(tmp_path / "train_000000-0123456789ab.bin")  # of a write that broke off
    reader = TokenShardReader(str(tmp_path), None, 8)
    list(reader.pushFilters([EqualTo(("split",), "train"), EqualTo(("global_idx",), 3999)]))
    ((only,),) = [task.ranges for task in reader.partitions()]
    assert (only.shard_idx, only.first_local, only.first_global, only.count) == (999, 3, 3999, 1)
    reader = TokenShardReader(str(tmp_path), "train", 8)
    list(reader.pushFilters([GreaterThanOrEqual(("global_idx",), 6), LessThan(("global_idx",), 13)]))
    ranges = [(r.shard_idx, r.first_local, r.count) for task in reader.partitions() for r in task.ranges]
    assert ranges == [(1, 2, 2), (2, 0, 4), (3, 0, 1)]
    reader = TokenShardReader(str(tmp_path), "train", 8)
    list(reader.pushFilters([EqualTo(("global_idx",), 4000)]))
    assert reader.partitions() == []


WHOLE_WRITE_AND_READ = r"""
import sys
from pathlib import Path
from pyspark.sql import functions as F
from textloom.operators.packing import assign_shards
from textloom.session import local_session
from textloom.sources.tokenshard import scan_token_shards, write_token_shards

spark = local_session("2", shuffle_partitions=2, memory="1g")
seqs = spark.range(20).select(F.col("id").alias("seq_id"), F.array_repeat(F.lit(3), 8).alias("tokens"))
write_token_shards(assign_shards(seqs, 4, val_fraction=0.2), sys.argv[1], 8)
rows = scan_token_shards(spark, sys.argv[1], 8).count()
running = []
for entry in Path("/proc").glob("[0-9]*/cmdline"):
    try:
        command = entry.read_bytes()
        environment = (entry.parent / "environ").read_bytes()
    except OSError:
        continue
    if b"pyspark.daemon\0pyspark.sql.worker." in command and b"TOKENSHARD_TEST=1" in environment:
        running.append(command)
print("ROWS", rows, "DRIVER WORKERS", len(running))
spark.stop()
"""


def test_whole_writes_and_reads_keep_no_workers_on_the_driver(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    environment = os.environ | {"PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")]), "TOKENSHARD_TEST": "1"}
    command = [sys.executable, "-c", WHOLE_WRITE_AND_READ, str(tmp_path / "out")]
    done = subprocess.run(command, env=environment, capture_output=True, text=True, timeout=240)
    assert "ROWS 20 DRIVER WORKERS 0" in done.stdout, done.stdout + done.stderr[-2000:]


def test_a_scan_gives_the_rows_of_a_read(spark, written):
    path, _ = written
    for split in (None, "train", "val"):
        read, scanned = read_token_shards(spark, path, 8, split), scan_token_shards(spark, path, 8, split)
        assert scanned.schema == read.schema
        assert sorted(scanned.collect()) == sorted(read.collect())
    assert scan_token_shards(spark, path, 200, "val").collect() == []
    with pytest.raises(FileNotFoundError, match="no test_"):
        scan_token_shards(spark, path, 8, "test")


def test_a_failed_write_takes_back_the_shards_of_other_tasks(spark, tmp_path):
    path = str(tmp_path)
    first = TokenShardWriter(path, 8, overwrite=True)
    first.write(iter([batch_of([("train", 0, 0, 0, [1] * 8)])]))
    first.abort([])
    assert not list(tmp_path.glob("*.bin"))
    write_token_shards(constant_shards(spark, 1), path, 8)
    later = TokenShardWriter(path, 8, overwrite=True)
    later.write(iter([batch_of([("train", 0, 0, 0, [2] * 8)])]))
    later.abort([])
    assert {t for r in scan_token_shards(spark, path, 8).collect() for t in r.tokens} == {1}
    assert scan_token_shards(spark, path, 8).count() == 10
    with pytest.raises(ValueError, match="mode"):
        write_token_shards(constant_shards(spark, 1), path, 8, mode="ignore")
