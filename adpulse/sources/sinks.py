"""Result sinks.

Writes are idempotent, so a retried task, stage or micro-batch leaves exactly
one copy:

* batch results overwrite only their own ``window_date`` partitions
  (dynamic partition overwrite) - rerunning a day rewrites that day;
* micro-batches overwrite their own ``batch_id`` partition, so a batch that is
  replayed after a failure replaces what its first attempt wrote.

Rows written are counted with ``observe`` while writing (no second pass).
A document-store or topic connector is used when its jar is present
(``format``), otherwise parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.columns import epoch_millis, ntz_from_millis


def write_results(results: DataFrame, path: str, fmt: str = "parquet",
                  options: dict | None = None) -> int:
    """Write window results partitioned by window date, replacing only the
    dates present in ``results``. Rows are clustered by date first, large dates
    split, so a date has few files. Returns the number of rows written."""
    obs = Observation("results_written")
    out = (results.withColumn("window_date", F.to_date("window_start")).hint("rebalance", "window_date")
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    (out.write.mode("overwrite").format(fmt).options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_date").save(path))
    return int(obs.get["rows"])


def write_partials(partials: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Store mergeable partials (sketches as binary) partitioned by window
    date, replacing only the dates present. Any coarser rollup can later be
    merged from them without re-reading raw events."""
    obs = Observation("partials_written")
    (partials.withColumn("window_date", F.to_date("window.start")).hint("rebalance", "window_date")
     .observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
     .partitionBy("window_date").save(path))
    return int(obs.get["rows"])


def stored_count(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Rows currently stored at ``path`` (one row, ``stored_rows``)."""
    return spark.read.format(fmt).load(path).agg(F.count(F.lit(1)).alias("stored_rows"))


def batch_writer(path: str, fmt: str = "parquet", options: dict | None = None,
                 counts_path: str | None = None):
    """``foreachBatch`` function writing each micro-batch to ``batch_id=<n>``
    (overwrite of that partition only). With ``counts_path``, the rows written
    per batch are recorded there the same way (the stored-rows counter)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        obs = Observation(f"sink_{batch_id}")
        # the batch's own folder is replaced: a replayed batch leaves one copy
        (batch.observe(obs, F.count(F.lit(1)).alias("rows"))
              .write.mode("overwrite").format(fmt).options(**(options or {}))
              .save(f"{path}/batch_id={batch_id}"))
        if counts_path is not None:
            spark = batch.sparkSession
            rows = int(obs.get["rows"])
            (spark.createDataFrame([(rows,)], "rows bigint")
                  .write.mode("overwrite").parquet(f"{counts_path}/batch_id={batch_id}"))
    return write


def encode_dates(results: DataFrame, col: str = "date") -> DataFrame:
    """Stored form of a timestamp: epoch milliseconds (document-store datetime)."""
    return results.withColumn(col, epoch_millis(col))


def decode_dates(stored: DataFrame, col: str = "date") -> DataFrame:
    return stored.withColumn(col, ntz_from_millis(col))
