"""A levelled store: tables that take a small write per micro-batch.

Each batch adds one sorted segment (level 0) to a table and reads only the
segments whose time range meets what it touches. When ``fanout`` segments of a
level have gathered they are merged by key into one of the next level; one that
``fanout`` of its size would make more than ``segment_bytes`` is final. So a
row is rewritten a few times at most, a batch merges a bounded amount, and what
it reads does not grow with the age of the store.

A manifest, one small JSON file per batch, lists the live segments of all
tables together with the job's counters. It is written last and in one step:
readers see a batch in all tables or in none, and never a half-written date. A
batch that is repeated after a failure writes its manifest again from the one
before it. Segments that no recent manifest names are deleted in the end.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FANOUT = 8
SEGMENT_BYTES = 128 << 20
KEPT_MANIFESTS = 20


@dataclass(frozen=True)
class Table:
    """How the rows of a table merge. ``at``: epoch seconds of a row, its
    segments are sorted and pruned by it; ``merge``: rows of several segments
    to one row per key. Rows carry ``v``, the number of the batch that wrote
    them."""
    name: str
    at: Callable[[], Column]
    merge: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Segment:
    table: str
    path: str      # below the root
    level: int
    low: int       # least and greatest ``at``
    high: int
    rows: int
    size: int      # bytes
    run: str


@dataclass
class Manifest:
    v: int = -1
    run: str = ""
    batch: int = -1
    segments: list[Segment] = field(default_factory=list)
    counters: dict[str, int] = field(default_factory=dict)
    read: int = 0       # bytes of the segments that the batch read
    compacted: int = 0  # bytes of the segments that it merged

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> "Manifest":
        found = json.loads(text)
        return Manifest(**{**found, "segments": [Segment(**s) for s in found["segments"]]})


class Folder:
    """The few file operations that Spark's readers and writers lack, on
    whatever file system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def size(self, name: str) -> int:
        return self.fs.getContentSummary(self._path(name)).getLength()

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file whole: under another name first, then renamed."""
        draft = self._path(f"{name}.draft")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.delete(self._path(name), False)
        self.fs.rename(draft, self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class Levels:
    """The tables below ``root``, for one writer and any number of readers."""

    def __init__(self, spark: SparkSession, root: str, tables: list[Table], fanout: int = FANOUT, segment_bytes: int = SEGMENT_BYTES):
        self.spark, self.root, self.folder = spark, root, Folder(spark, root)
        self.tables = {t.name: t for t in tables}
        self.fanout, self.segment_bytes = fanout, segment_bytes

    # -- reading ------------------------------------------------------------------------

    def latest(self, before: int | None = None) -> Manifest:
        """The last manifest (below number ``before``), an empty one if none."""
        names = [n for n in self.folder.names("manifest") if n.endswith(".json") and (before is None or int(n[:-5]) < before)]
        return Manifest.of(self.folder.read(f"manifest/{names[-1]}")) if names else Manifest()

    def segments(self, manifest: Manifest, table: str, ranges: list[tuple[int, int]] | None = None) -> list[Segment]:
        """The live segments of a table, or those that meet one of the ranges."""
        return [s for s in manifest.segments if s.table == table
                and (ranges is None or any(low <= s.high and s.low <= high for low, high in ranges))]

    def rows(self, segments: list[Segment], schema) -> DataFrame:
        """The rows of segments as they are, sorted ones not merged."""
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{s.path}" for s in segments])

    def read(self, table: str) -> DataFrame:
        """The whole table by the last manifest, one row per key."""
        live = self.segments(self.latest(), table)
        if not live:
            raise ValueError(f"{self.root}: table {table} has no rows yet")
        schema = self.spark.read.parquet(f"{self.root}/{live[0].path}").schema
        return self.tables[table].merge(self.rows(live, schema))

    # -- writing ------------------------------------------------------------------------

    def begin(self, run: str, batch: int) -> Manifest:
        """The manifest that a batch starts from, with the batch's own number:
        the last one, or the one before it if the last is this batch's."""
        last = self.latest()
        if (last.run, last.batch) == (run, batch):
            last = self.latest(before=last.v)
        return Manifest(last.v + 1, run, batch, list(last.segments), dict(last.counters))

    def write(self, manifest: Manifest, table: str, df: DataFrame, level: int = 0, place: int = 0, **counted: Column) -> dict[str, int]:
        """Add a segment of ``df`` to the manifest; returns its ``rows``, and
        what else is to be counted while writing. Columns that begin with an
        underscore are only for counting. ``place`` tells apart the segments
        that one batch writes to a level."""
        path = f"{table}/v={manifest.v}/level={level}" + (f"-{place}" if place else "")
        seen, out = Observation(), df.withColumn("_at", self.tables[table].at())
        out = (out.repartitionByRange("_at") if level else out).sortWithinPartitions("_at")
        (out.observe(seen, F.count(F.lit(1)).alias("rows"), F.min("_at").alias("low"), F.max("_at").alias("high"), *[c.alias(k) for k, c in counted.items()])
         .drop(*[c for c in out.columns if c.startswith("_")]).write.mode("overwrite").parquet(f"{self.root}/{path}"))
        found = dict(seen.get)
        if found.get("rows"):
            manifest.segments.append(Segment(table, path, level, found["low"], found["high"], found["rows"], self.folder.size(path), manifest.run))
        return found

    def compact(self, manifest: Manifest) -> None:
        """Merge the segments of full levels, the oldest ``fanout`` of a level
        at a time."""
        place = 0
        for table in self.tables.values():
            level = 0
            while level <= max((s.level for s in manifest.segments), default=-1):
                here = [s for s in manifest.segments if (s.table, s.level) == (table.name, level) and s.size * self.fanout <= self.segment_bytes]
                if len(here) >= self.fanout:
                    old, place = here[:self.fanout], place + 1
                    schema = self.spark.read.parquet(f"{self.root}/{old[0].path}").schema
                    self.write(manifest, table.name, table.merge(self.rows(old, schema)), level + 1, place)
                    manifest.segments = [s for s in manifest.segments if s not in old]
                    manifest.compacted += sum(s.size for s in old)
                else:
                    level += 1

    def commit(self, manifest: Manifest) -> None:
        """Publish the batch, and delete what only old manifests name."""
        self.compact(manifest)
        self.folder.replace(f"manifest/{manifest.v:012d}.json", manifest.text())
        if manifest.v % self.fanout == 0:
            self.vacuum()

    def vacuum(self, kept: int = KEPT_MANIFESTS) -> int:
        """Delete all but the last manifests, and the segments that none of
        these names; returns how many segments went. A reader that started
        from an older manifest fails and has to read again."""
        names = [n for n in self.folder.names("manifest") if n.endswith(".json")]
        if not names:
            return 0
        live = {s.path for n in names[-kept:] for s in Manifest.of(self.folder.read(f"manifest/{n}")).segments}
        gone = 0
        for table in self.tables:
            for v in self.folder.names(table):
                here = [f"{table}/{v}/{x}" for x in self.folder.names(f"{table}/{v}")] if int(v[2:]) <= int(names[-1][:-5]) else []
                dead = [path for path in here if path not in live]
                for path in [f"{table}/{v}"] if dead and len(dead) == len(here) else dead:
                    self.folder.delete(path)
                gone += len(dead)
        for name in names[:-kept]:
            self.folder.delete(f"manifest/{name}")
        return gone
