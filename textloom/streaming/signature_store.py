"""Signatures of kept documents, laid out for looking up the few that new documents can meet.

Two tables: bucket rows (bucket, id), ten per document, and signatures (id, sig), once per document. Each
batch adds a segment to both. A segment is cut into ranges of a hash (that of the bucket, that of the
id) by its leading bits; the more rows, the more ranges, so that a range has about ``RANGE_ROWS`` rows.
A lookup reads only the ranges that its keys fall into: first the bucket rows of the batch's buckets, then
the signatures of the ids found.

A manifest per version lists the live segments and their ranges. Version N belongs to batch N and is
written last, as one small table whose appearance commits the batch; a replayed batch starts from the
version before it. Segments of one size class are merged once ``MERGE_AT`` of them have come together,
so there are few segments and each row is rewritten a logarithmic number of times. What a version no
longer names is removed by ``remove_unused``.

A store without a manifest is empty only if nothing was ever written to it; a missing manifest beside segments, a
missing range or a missing segment raises an error.
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_ROWS = 4_000_000
MAX_BITS = 14
MERGE_AT = 8
MANIFEST = "table string, name string, rows bigint, bits int, ranges array<int>, level int, last_id bigint"
KEYS = {"buckets": "bucket", "signatures": "id"}


@dataclass(frozen=True)
class Segment:
    table: str
    name: str
    rows: int
    bits: int
    ranges: list[int]
    level: int
    last_id: int


class DamagedStore(RuntimeError):
    """The folder holds parts of a store that do not fit together."""


def range_of(table: str, bits: int) -> Column:
    """Number of the range of a row. Buckets are hashes already, ids are hashed here."""
    key = F.col(KEYS[table])
    spread = key if table == "buckets" else F.xxhash64(key)
    return F.shiftrightunsigned(spread, 64 - bits).cast("int") if bits else F.lit(0)


class SignatureStore:
    def __init__(self, spark: SparkSession, path: str, range_rows: int = RANGE_ROWS, merge_at: int = MERGE_AT) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.range_rows, self.merge_at = range_rows, merge_at
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(place)] if self._fs.exists(place) else []

    def versions(self) -> list[int]:
        """Committed versions: a manifest counts once its writer has marked it as complete."""
        found = (re.fullmatch(r"v(\d+)", name) for name in self._names("manifest"))
        numbers = sorted(int(m[1]) for m in found if m)
        return [n for n in numbers if self._fs.exists(self._path(f"{self.path}/manifest/v{n}/_SUCCESS"))]

    def segments(self, before: int | None = None) -> list[Segment]:
        """Live segments of the last version, or of the last one before batch ``before``."""
        versions = [v for v in self.versions() if before is None or v < before]
        if not versions:
            written = {name for table in KEYS for name in self._names(table)}
            # segments of batches that did not get as far as their manifest are written again by the replay
            stray = {n for n in written if before is None or int(re.sub(r"\D", "", n)) < before}
            if stray:
                raise DamagedStore(f"{self.path} has segments {sorted(stray)[:5]} but no manifest")
            return []
        rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/v{versions[-1]}").collect()
        return [Segment(**row.asDict()) for row in rows]

    def last_id(self, before: int) -> int | None:
        return max((s.last_id for s in self.segments(before)), default=None)

    def read(self, segment: Segment, ranges: list[int] | None = None) -> DataFrame:
        """Rows of a segment, of some of its ranges only if these are given."""
        base = f"{self.path}/{segment.table}/{segment.name}"
        wanted = segment.ranges if ranges is None else sorted(set(segment.ranges) & set(ranges))
        schema = "bucket bigint, id bigint" if segment.table == "buckets" else "id bigint, sig array<int>"
        if not wanted:
            return self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(*[f"{base}/range={r}" for r in wanted])
        except AnalysisException as error:
            raise DamagedStore(f"{base} lacks ranges that its manifest names") from error

    def _touched(self, keys: DataFrame, table: str, bits: int) -> list[int]:
        """Ranges that a column of keys falls into; there are at most 2**MAX_BITS."""
        return [r[0] for r in keys.select(range_of(table, bits)).distinct().collect()]

    def find(self, table: str, keys: DataFrame, before: int) -> DataFrame | None:
        """Rows of a table whose key is in ``keys`` (one column, named as the table's key)."""
        found = None
        touched: dict[int, list[int]] = {}
        for segment in self.segments(before):
            if segment.table != table:
                continue
            if segment.bits not in touched:
                touched[segment.bits] = self._touched(keys, table, segment.bits)
            rows = self.read(segment, touched[segment.bits])
            found = rows if found is None else found.unionByName(rows)
        return None if found is None else found.join(keys.distinct(), KEYS[table], "left_semi")

    def _write(self, rows: DataFrame, table: str, name: str, n: int, level: int, last_id: int) -> Segment:
        bits = min(MAX_BITS, max(0, -(-n // self.range_rows) - 1).bit_length())
        base = f"{self.path}/{table}/{name}"
        # a range is one task's work
        placed = rows.withColumn("range", range_of(table, bits)).repartition(1 << bits, "range")
        placed.sortWithinPartitions("range", KEYS[table]).write.mode("overwrite").partitionBy("range").parquet(base)
        ranges = sorted(int(x.split("=")[1]) for x in self._names(f"{table}/{name}") if x.startswith("range="))
        return Segment(table, name, n, bits, ranges, level, last_id)

    def add(self, batch_id: int, tables: dict[str, tuple[DataFrame, int]], last_id: int) -> None:
        """Add the rows of a batch, given with their number, and commit its version. Nothing of earlier versions is
        changed."""
        live = self.segments(batch_id)
        earlier = max([last_id, *(s.last_id for s in live)])
        for table, (rows, n) in tables.items():
            live.append(self._write(rows, table, f"b{batch_id}", n, 0, earlier))
            level = 0
            while len(same := [s for s in live if s.table == table and s.level == level]) >= self.merge_at:
                whole = self.read(same[0])
                for segment in same[1:]:
                    whole = whole.unionByName(self.read(segment))
                level += 1
                merged = self._write(whole, table, f"l{level}b{batch_id}", sum(s.rows for s in same), level, earlier)
                live = [s for s in live if s not in same] + [merged]
        manifest = self.spark.createDataFrame([asdict(s) for s in live], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/v{batch_id}")

    def remove_unused(self, keep_versions: int = 2) -> None:
        """Delete the manifests before the last few and the segments that only those name."""
        kept = self.versions()[-keep_versions:]
        named = {(s.table, s.name) for v in kept for s in self.segments(v + 1)}
        for table in KEYS:
            for name in self._names(table):
                number = int(name.rpartition("b")[2])
                if kept and number <= kept[-1] and (table, name) not in named:
                    self._fs.delete(self._path(f"{self.path}/{table}/{name}"), True)
        for version in self.versions():
            if version not in kept:
                self._fs.delete(self._path(f"{self.path}/manifest/v{version}"), True)
