"""Replay of a table as a message stream, in event-time slices (for tests of
the stateful stream operators: watermarks, restarts, late data)."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adpulse.sources.sinks import batch_writer
from adpulse.streaming.jobs import shuffle_partitions
from adpulse.streaming.sources import message_stream


def retried(writer, attempts: int = 2):
    """Run a batch writer several times per batch, as a retried batch would."""
    def write(batch: DataFrame, batch_id: int) -> None:
        for _ in range(attempts):
            writer(batch, batch_id)
    return write


def time_slices(df: DataFrame, ms_col: str, n: int) -> Column:
    """Slice number 0..n-1 of each row by equal ranges of an epoch-ms column."""
    b = df.agg(F.min(ms_col).alias("lo"), F.max(ms_col).alias("hi")).first()
    lo, hi = int(b["lo"]), int(b["hi"])
    return F.expr(f"((`{ms_col}` - {lo}) * {n}) div {hi - lo + 1}")


def stage_slices(messages: DataFrame, slice_col: Column, folder: str,
                 n: int) -> tuple[str, dict[int, int]]:
    """Write ``value`` of each message, partitioned by slice, under
    ``folder/by_slice``; returns that path and the rows per slice (observed
    while writing, no second pass)."""
    path = f"{folder}/by_slice"
    obs = Observation("staged_slices")
    (messages.select("value", slice_col.alias("slice"))
     .observe(obs, *[F.count_if(F.col("slice") == k).alias(f"s{k}") for k in range(n)])
     .write.partitionBy("slice").parquet(path))
    return path, {k: int(obs.get[f"s{k}"]) for k in range(n)}


def append_slice(spark, staged: str, k: int, stream_folder: str, files: int | None = None) -> int:
    """Append slice ``k`` to the stream folder as new text files and return
    how many files were written (one per non-empty partition, observed while
    writing). With ``files`` the rows are dealt round-robin into that many
    partitions, which gives that many files whenever an input split holds at
    least ``files`` rows."""
    df = spark.read.parquet(staged).where(F.col("slice") == k).select("value")
    if files:
        df = df.repartition(files)
    obs = Observation(f"slice_{k}_files")
    (df.withColumn("_part", F.spark_partition_id())
       .observe(obs, F.collect_set("_part").alias("parts"))
       .select("value").write.mode("append").text(stream_folder))
    return len(obs.get["parts"])


def run_slices(spark: SparkSession, messages: DataFrame, n_slices: int,
               build: Callable[[DataFrame], DataFrame], folder: str,
               order: Sequence[int] | None = None, writer=None,
               output_mode: str = "append", sink: str | None = None,
               restart_each_slice: bool = False,
               state_partitions: int | None = None) -> tuple[str, list]:
    """Replay ``messages`` (``value`` + epoch-ms ``timestamp``) as a stream.

    The messages are cut into ``n_slices`` event-time slices and appended to
    the stream folder in ``order``, slice by slice, each as F files
    (F = default parallelism). The file source takes files oldest first, so
    one ``availableNow`` run with ``maxFilesPerTrigger = F`` processes one
    slice per micro-batch: the watermark advances between slices as it would
    between broker batches. A slice that comes out as fewer files is
    processed right after it is appended (it is then the newest data, so its
    batch holds all of it) - a batch never straddles two slices.

    ``restart_each_slice=True`` appends one slice at a time and restarts the
    query from its checkpoint after each, as after a driver failure. Returns
    the sink path and all progress reports.

    ``state_partitions`` (default: the cluster's parallelism) is the number of
    partitions of the stateful operators; it is fixed in the checkpoint when
    the query first starts, so it is set only around that start and the
    session's own ``spark.sql.shuffle.partitions`` is restored afterwards.
    """
    sink = sink or f"{folder}/sink"
    staged, sizes = stage_slices(messages, time_slices(messages, "timestamp", n_slices), folder,
                                 n_slices)
    stream_dir, checkpoint = f"{folder}/stream", f"{folder}/checkpoint"
    seq = list(order) if order is not None else list(range(n_slices))
    files = spark.sparkContext.defaultParallelism
    progress: list = []

    parts = state_partitions or spark.sparkContext.defaultParallelism

    def run(options: dict) -> None:
        out = build(message_stream(spark, "text", stream_dir, options=options))
        with shuffle_partitions(spark, parts):
            query = (out.writeStream.outputMode(output_mode)
                     .option("checkpointLocation", checkpoint)
                     .foreachBatch(writer or batch_writer(sink))
                     .trigger(availableNow=True).start())
        query.awaitTermination()
        progress.extend(query.recentProgress)

    options = {"maxFilesPerTrigger": str(files)}
    pending = False
    for k in seq:
        if not sizes.get(k, 0):
            continue
        written = append_slice(spark, staged, k, stream_dir, files=files)
        pending = True
        if restart_each_slice or written != files:
            run(options)
            pending = False
    if pending:
        run(options)
    return sink, progress
