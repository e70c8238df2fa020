"""Document-store sink: a PySpark data source that upserts rows by key.

Each partition opens one session with the store and sends its rows in batches;
what it sends is staged, and the driver's commit makes the staged parts of all
tasks visible at once. A task that fails, and a job that is aborted, leave
nothing to be seen; a task that runs again sends its rows again under another
name, and only the attempt that Spark accepts is committed. Documents are
addressed by key: of several commits with one key the last is the document.

The target here is a folder (any file system that pyarrow opens by its URI, or
a path that driver and executors share): JSON lines per task under ``parts``
and one commit file per job. A client for another store replaces ``Target``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from adpulse.session import ship

BATCH_ROWS = 1000


@dataclass
class Staged(WriterCommitMessage):
    part: str
    rows: int


class Target:
    """A folder as the document store."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.root = (fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path))

    def stage(self, part: str, batches: Iterator[list[dict]]) -> int:
        """One session: every batch of documents to a part of its own; nothing
        is left of a session that fails."""
        rows = 0
        self.fs.create_dir(f"{self.root}/parts", recursive=True)
        try:
            with self.fs.open_output_stream(f"{self.root}/parts/{part}") as out:
                for documents in batches:
                    out.write("".join(json.dumps(d, default=_plain, ensure_ascii=False) + "\n" for d in documents).encode())
                    rows += len(documents)
        except BaseException:
            self.drop([part])
            raise
        return rows

    def publish(self, parts: list[str]) -> int:
        """Make staged parts visible, all in one step; returns the commit's number."""
        from pyarrow import fs

        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits"))
        number = 1 + max((int(f.base_name[:12]) for f in found if f.base_name.endswith(".json")), default=-1)
        draft = f"{self.root}/commits/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write("".join(json.dumps({"number": number, "part": p}) + "\n" for p in parts).encode())
        self.fs.move(draft, f"{self.root}/commits/{number:012d}.json")
        return number

    def drop(self, parts: list[str]) -> None:
        for part in parts:
            try:
                self.fs.delete_file(f"{self.root}/parts/{part}")
            except FileNotFoundError:
                pass


def _plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, bytes):
        return value.hex()
    return str(value)


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.batch_rows = options["path"], int(options.get("batch_rows", BATCH_ROWS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        part = f"{uuid.uuid4().hex}-{context.partitionId()}-{context.attemptNumber()}.jsonl"
        batches = (batch.slice(at, self.batch_rows).to_pylist() for batch in iterator for at in range(0, batch.num_rows, self.batch_rows))
        return Staged(part, Target(self.path).stage(part, batches))

    def commit(self, messages: list[Staged | None]) -> None:
        Target(self.path).publish([m.part for m in messages if m is not None and m.rows])

    def abort(self, messages: list[Staged | None]) -> None:
        Target(self.path).drop([m.part for m in messages if m is not None])


class DocumentStore(DataSource):
    """``df.write.format("adpulse_documents").mode("append").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "adpulse_documents"

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        if overwrite:
            raise ValueError("documents are replaced by key; use mode('append')")
        return DocumentWriter(self.options)


def write_documents(df: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Upsert the rows of ``df`` into the document store at ``path``."""
    spark = df.sparkSession
    ship(spark)
    spark.dataSource.register(DocumentStore)
    df.write.format(DocumentStore.name()).mode("append").option("batch_rows", batch_rows).option("path", path).save()


def read_documents(spark: SparkSession, path: str, keys: list[str], schema: str) -> DataFrame:
    """The documents of all commits, the last one of each key."""
    commits = spark.read.schema("number bigint, part string").json(f"{path}/commits")
    rows = spark.read.schema(schema).json(f"{path}/parts").withColumn("_part", F.element_at(F.split(F.input_file_name(), "/"), -1))
    live = rows.join(commits, F.col("_part") == F.col("part")).drop("_part", "part")
    columns = [c for c in rows.columns if c != "_part"]
    return live.groupBy(*keys).agg(F.max_by(F.struct(*columns), "number").alias("_d")).select("_d.*")
