"""The ``tokenshard`` format: flat little-endian uint16 files named ``{split}_{shard:06d}.bin``.

Writing: rows (split, shard_id, seq_in_shard, start, tokens), arranged by ``arranged``: whole sequences or
slices of them, ``start`` tokens into their sequence. A task puts whole shards together under a temporary
name and gives each its final one itself. Files that are written over an existing version carry the
write's mark before ``.bin``, so both versions lie side by side until the commit.

The commit writes a manifest of all shards and their token counts and puts it in place by one rename: that
switches the version. Only then are files of the version before removed. A write that breaks off earlier
leaves the version before as it was.

Reading: options ``path``, ``split`` (optional) and ``seq_len``. The reader takes the newest manifest,
or lists the files where there is none, and finds the shards of a range of sequences by bisection in
the running counts; it prunes by filters on split and global index.

Spark plans and commits a Python data source in Python workers of the driver, and each kind of step keeps a
daemon of its own for the whole session. So whole writes and reads (``write_token_shards``, ``scan_token_shards``)
run the same writer and reader as plain tasks, and plan and commit in the calling process; look-ups, which need filters
in the plan, go through the data source.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "tokenshard"
SCHEMA = "split string, shard_idx int, local_idx bigint, global_idx bigint, tokens array<int>"
FILE_NAME = re.compile(r"(?P<split>.+)_(?P<shard>\d{6,})(-[0-9a-f]{12})?\.bin$")
# sorts behind the shard files; the highest number is in force
MANIFEST = re.compile(r"version-(\d{8,})\.json$")
MAX_ID = 65_535
# stands in a folder without a manifest while its first version is written; readers refuse it
UNFINISHED = "_unfinished"
DELETES_AT_ONCE = 64
# what a task of the writer hands on, and one of the reader gets
WRITTEN = "split string, shard_id bigint, file string, tokens bigint"
RANGES = pa.list_(
    pa.struct([("split", pa.string()), ("file", pa.string()), *((name, pa.int64()) for name in ("shard_idx", "first_local", "first_global", "count"))])
)
# sequences per read task and tokens per Arrow batch
TASK_TOKENS = 16 << 20
BATCH_TOKENS = 1 << 20


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Version:
    """The shards of a folder: (split, shard, file name, tokens) ordered by split and shard number."""

    number: int  # 0 where the folder has no manifest
    shards: list[tuple[str, int, str, int]]


def _in_folder(fs: pafs.FileSystem, root: str) -> list[tuple[str, int, str, int]]:
    found = []
    for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        match = FILE_NAME.fullmatch(info.base_name)
        if match:
            found.append((match["split"], int(match["shard"]), info.base_name, info.size // 2))
    return sorted(found)


def read_version(path: str) -> Version:
    """The version in force."""
    fs, root = _filesystem(path)
    names = [info.base_name for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))]
    numbers = [int(match[1]) for match in map(MANIFEST.fullmatch, names) if match]
    if numbers:
        with fs.open_input_file(f"{root}/version-{max(numbers):08d}.json") as source:
            listed = json.loads(source.read())
        return Version(max(numbers), [tuple(entry) for entry in listed["shards"]])
    if UNFINISHED in names:
        raise RuntimeError(f"a write to {path} did not finish: write it again")
    return Version(0, _in_folder(fs, root))


@dataclass
class ShardRange:
    """Consecutive sequences of one file."""

    split: str
    file: str
    shard_idx: int
    first_local: int
    first_global: int
    count: int


@dataclass
class ShardTask(InputPartition):
    """What one task reads: part of a large file, or several small files."""

    ranges: list[ShardRange]


class TokenShardReader(DataSourceReader):
    def __init__(self, path: str, split: str | None, seq_len: int) -> None:
        self.path, self.split, self.seq_len = path, split, seq_len
        self.low, self.high = 0, None
        self.splits: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            column = getattr(item, "attribute", None)
            if column == ("split",) and isinstance(item, EqualTo):
                self._only_splits({item.value})
            elif column == ("split",) and isinstance(item, In):
                self._only_splits(set(item.value))
            elif column == ("global_idx",):
                self._narrow(item)
            yield item  # Spark checks the rows again

    def _only_splits(self, values: set[str]) -> None:
        self.splits = values if self.splits is None else self.splits & values

    def _narrow(self, item: Filter) -> None:
        low, high = None, None
        if isinstance(item, EqualTo):
            low, high = item.value, item.value + 1
        elif isinstance(item, In) and item.value:
            low, high = min(item.value), max(item.value) + 1
        elif isinstance(item, GreaterThan):
            low = item.value + 1
        elif isinstance(item, GreaterThanOrEqual):
            low = item.value
        elif isinstance(item, LessThan):
            high = item.value
        elif isinstance(item, LessThanOrEqual):
            high = item.value + 1
        if low is not None:
            self.low = max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)

    def partitions(self) -> list[InputPartition]:
        _, root = _filesystem(self.path)
        by_split: dict[str, list[tuple[str, int]]] = {}
        for split, _, name, tokens in read_version(self.path).shards:
            if self.split is None or split == self.split:
                by_split.setdefault(split, []).append((f"{root}/{name}", tokens))
        if not by_split:
            raise FileNotFoundError(f"no {self.split or '*'}_*.bin shards in {self.path}")
        step = max(1, TASK_TOKENS // self.seq_len)
        plan: list[ShardTask] = []
        room = 0
        for split, files in by_split.items():
            if self.splits is not None and split not in self.splits:
                continue
            # ends[i]: sequences of the split up to and with its i-th file
            ends = np.cumsum([tokens // self.seq_len for _, tokens in files])
            low, high = self.low, int(ends[-1]) if self.high is None else min(self.high, int(ends[-1]))
            if low >= high:
                continue
            first_file, last_file = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left")
            for i in range(int(first_file), int(last_file) + 1):
                base = int(ends[i - 1]) if i else 0
                stop = min(int(ends[i]), high) - base
                for first in range(max(0, low - base), stop, step):
                    rows = min(step, stop - first)
                    if rows > room:
                        plan.append(ShardTask([]))
                        room = step
                    plan[-1].ranges.append(ShardRange(split, files[i][0], i, first, base + first, rows))
                    room -= rows
        return plan

    def read(self, partition: ShardTask) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        for part in partition.ranges if isinstance(partition, ShardTask) else []:
            yield from self._read_range(fs, part)

    def _read_range(self, fs: pafs.FileSystem, part: ShardRange) -> Iterator[pa.RecordBatch]:
        length = self.seq_len
        step = max(1, BATCH_TOKENS // length)
        with fs.open_input_file(part.file) as source:
            source.seek(part.first_local * length * 2)
            for done in range(0, part.count, step):
                rows = min(step, part.count - done)
                data = np.frombuffer(source.read(rows * length * 2), dtype="<u2").astype(np.int32)
                offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * length)
                counter = np.arange(done, done + rows, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.split] * rows, pa.string()),
                        pa.array(np.full(rows, part.shard_idx, np.int32)),
                        pa.array(part.first_local + counter),
                        pa.array(part.first_global + counter),
                        pa.ListArray.from_arrays(offsets, pa.array(data)),
                    ],
                    names=["split", "shard_idx", "local_idx", "global_idx", "tokens"],
                )


@dataclass
class WrittenShards(WriterCommitMessage):
    shards: list[tuple[str, int, str, int]]


class TokenShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, seq_len: int, overwrite: bool) -> None:
        self.path, self.seq_len, self.overwrite = path, seq_len, overwrite
        self.job = uuid.uuid4().hex[:12]
        fs, root = _filesystem(path)
        # the first version has plain names, later ones must not touch the files in force
        self.first = not _in_folder(fs, root)
        self.tag = "" if self.first else f"-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _filesystem(self.path)
        staging = f"{root}/_staging_{self.job}"
        fs.create_dir(staging, recursive=True)
        if self.first:
            fs.open_output_stream(f"{root}/{UNFINISHED}").close()
        # (temporary file, split, shard, tokens)
        done: list[tuple[str, str, int, int]] = []
        current, temporary, sink, written = None, "", None, 0

        def finish() -> None:
            if sink is not None:
                sink.close()
                if written % self.seq_len:
                    raise ValueError(f"shard {current}: packed sequences must hold {self.seq_len} tokens")
                done.append((temporary, *current, written))

        try:
            for batch in iterator:
                tokens = batch.column("tokens")
                offsets = np.asarray(tokens.offsets)
                ids = np.asarray(tokens.flatten())
                offsets = offsets - offsets[0]
                if len(ids) and (ids.min() < 0 or ids.max() > MAX_ID):
                    raise ValueError("token ids must fit in 16 bits")
                data = ids.astype("<u2")
                shards, places, starts = (np.asarray(batch.column(c)) for c in ("shard_id", "seq_in_shard", "start"))
                lengths = np.diff(offsets)
                if (starts + lengths > self.seq_len).any():
                    raise ValueError(f"packed sequences must hold {self.seq_len} tokens")
                splits = np.asarray(batch.column("split").to_pylist(), object)
                at = places.astype(np.int64) * self.seq_len + starts
                # runs of rows that belong to one shard
                cuts = np.flatnonzero((shards[1:] != shards[:-1]) | (splits[1:] != splits[:-1])) + 1
                for first, last in zip([0, *cuts], [*cuts, len(shards)]):
                    if first == last:
                        continue
                    split, shard = splits[first], int(shards[first])
                    if (split, shard) != current:
                        finish()
                        current, written = (split, shard), 0
                        temporary = f"{staging}/{uuid.uuid4().hex}"
                        sink = fs.open_output_stream(temporary)
                    # each slice begins where the one before ends
                    expected = written + offsets[first:last] - offsets[first]
                    wrong = np.flatnonzero(at[first:last] != expected)
                    if len(wrong) and expected[wrong[0]] % self.seq_len:
                        raise ValueError(f"shard {current}: packed sequences must hold {self.seq_len} tokens")
                    if len(wrong):
                        raise ValueError(f"shard {current} is not in order after {written // self.seq_len} sequences")
                    written += int(offsets[last] - offsets[first])
                    sink.write(data[offsets[first] : offsets[last]].tobytes())
            finish()
        finally:
            if sink is not None and not sink.closed:
                sink.close()
        found = []
        for temporary, split, shard, n in done:
            name = f"{split}_{shard:06d}{self.tag}.bin"
            # attempts of one task write the same bytes, so whichever comes last is right
            fs.move(temporary, f"{root}/{name}")
            found.append((split, shard, name, n))
        return WrittenShards(found)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Switch to the new version by putting its manifest in place, then remove what it does not name."""
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        new = {(split, shard): (split, shard, name, n) for m in messages if m for split, shard, name, n in m.shards}
        present = [info.base_name for info in fs.get_file_info(pafs.FileSelector(root))]
        manifests = [name for name in present if MANIFEST.fullmatch(name)]
        number = max((int(MANIFEST.fullmatch(name)[1]) for name in manifests), default=0) + 1
        if not self.overwrite and not self.first:
            new = {(split, shard): (split, shard, name, n) for split, shard, name, n in read_version(self.path).shards} | new
        shards = sorted(new.values())
        temporary = f"{root}/_staging_{self.job}/manifest"
        fs.create_dir(f"{root}/_staging_{self.job}", recursive=True)
        with fs.open_output_stream(temporary) as sink:
            sink.write(json.dumps({"seq_len": self.seq_len, "shards": shards}).encode())
        fs.move(temporary, f"{root}/version-{number:08d}.json")
        names = {name for _, _, name, _ in shards}
        stale = [name for name in present if FILE_NAME.fullmatch(name) and name not in names]
        stale += manifests + [name for name in present if name == UNFINISHED]
        with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
            list(pool.map(lambda name: fs.delete_file(f"{root}/{name}"), stale))
        self._drop_staging(fs, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Remove what this write left; files that tasks had put in place go, the version in force stays.

        They are found by their mark, whether or not their task's message came; a folder's first version began
        without any.
        """
        fs, root = _filesystem(self.path)
        for _, _, name, _ in _in_folder(fs, root):
            if name.endswith(f"{self.tag}.bin"):
                fs.delete_file(f"{root}/{name}")
        self._drop_staging(fs, root)

    def _drop_staging(self, fs: pafs.FileSystem, root: str) -> None:
        staging = f"{root}/_staging_{self.job}"
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


class TokenShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TokenShardReader:
        return TokenShardReader(self.options["path"], self.options.get("split"), int(self.options["seq_len"]))

    def writer(self, schema: StructType, overwrite: bool) -> TokenShardWriter:
        return TokenShardWriter(self.options["path"], int(self.options["seq_len"]), overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenShardSource)


def arranged(placed: DataFrame) -> DataFrame:
    """Rows of a shard together and in order; the one move of token arrays that writing needs."""
    start = F.col("start") if "start" in placed.columns else F.lit(0)
    rows = placed.select("split", "shard_id", "seq_in_shard", start.cast("int").alias("start"), "tokens")
    return rows.repartition("split", "shard_id").sortWithinPartitions("split", "shard_id", "seq_in_shard", "start")


def _written_rows(writer: TokenShardWriter):
    """The shards that a task has written, as rows of ``WRITTEN``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*writer.write(batches).shards)) or [()] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["split", "shard_id", "file", "tokens"])

    return run


def write_token_shards(placed: DataFrame, path: str, seq_len: int, mode: str = "overwrite") -> None:
    """Write sequences, or slices with their ``start``, by split, shard_id and seq_in_shard; a task handles whole shards."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    writer = TokenShardWriter(path, seq_len, mode == "overwrite")
    try:
        # a row per shard, as the manifest has
        done = arranged(placed).mapInArrow(_written_rows(writer), WRITTEN).collect()
    except BaseException:
        writer.abort([])
        raise
    writer.commit([WrittenShards([tuple(row) for row in done])])


def _sequences(reader: TokenShardReader):
    """The sequences of the ranges that a task gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ranges in batch.column(0).to_pylist():
                yield from reader.read(ShardTask([ShardRange(**part) for part in ranges]))

    return run


def scan_token_shards(spark: SparkSession, path: str, seq_len: int, split: str | None = None) -> DataFrame:
    """All sequences, in the rows of ``read_token_shards``. Filters do not narrow the files that are read."""
    reader = TokenShardReader(path, split, seq_len)
    # as an Arrow table, since rows would be turned into a table by Python workers
    plan = pa.table({"ranges": pa.array([[asdict(part) for part in task.ranges] for task in reader.partitions()], RANGES)})
    return spark.createDataFrame(plan).mapInArrow(_sequences(reader), SCHEMA)


def read_token_shards(spark: SparkSession, path: str, seq_len: int, split: str | None = None) -> DataFrame:
    """The sequences, as a data source that reads only what filters on split and global index leave."""
    register(spark)
    reader = spark.read.format(FORMAT).option("seq_len", str(seq_len))
    if split is not None:
        reader = reader.option("split", split)
    return reader.load(path)


def lookup(shards: DataFrame, split: str, global_idx: int) -> DataFrame:
    """The sequence at a global index of a split; other files are not read."""
    return shards.filter((F.col("split") == split) & (F.col("global_idx") == global_idx))
