"""What a running query reports, kept as a table: the metrics it observes,
rates, and rows that its stateful operators dropped, one row per micro-batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from adpulse.streaming.levels import Folder

FIELDS = ("query string, name string, batch bigint, rows bigint, rows_per_second double, processed_per_second double, "
          "dropped_by_watermark bigint, state_rows bigint, observed map<string,bigint>")


class ProgressLog(StreamingQueryListener):
    """Writes each progress report of the session's queries, or of those with
    one ``name``, to ``root/progress``; a batch that reports again replaces
    its row. The reports of idle triggers have no rows and are left out."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        self.folder, self.name, self.ended = Folder(spark, root), name, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        observed = {f"{metric}.{field}": int(value) for metric, row in (p.observedMetrics or {}).items()
                    for field, value in row.asDict().items() if value is not None}
        if not p.numInputRows and not any(observed.values()):
            return
        states = p.stateOperators or []
        row = {"query": str(p.id), "name": p.name, "batch": p.batchId, "rows": p.numInputRows,
               "rows_per_second": p.inputRowsPerSecond, "processed_per_second": p.processedRowsPerSecond,
               "dropped_by_watermark": sum(s.numRowsDroppedByWatermark for s in states), "state_rows": sum(s.numRowsTotal for s in states), "observed": observed}
        self.folder.replace(f"progress/{p.id}-{p.batchId:012d}.json", json.dumps(row))

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def logged(spark: SparkSession, root: str, start, wait: float = 60.0):
    """Run ``start()``, which starts a query, to its end with a log of its
    progress; returns the query. The log is complete when this returns."""
    log = ProgressLog(spark, root)
    spark.streams.addListener(log)
    try:
        query = start()
        query.awaitTermination()
        log.ended.wait(wait)
        return query
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FIELDS).json(f"{root}/progress")
