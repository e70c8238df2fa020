"""Streaming jobs on impression messages.

The production job (``start_impression_job``) keeps no window open. Each
micro-batch is decoded once and aggregated to mergeable partials (impressions,
bid sum, earliest event, cookie sketch per window, publisher and geo), which
are added to a levelled store (``levels``). The windows that a batch touches are
then merged again from their partials and written as the newest rows of their
keys: the dashboard metrics, and the coarse windows. So a late message adds to
its window however late it comes, the last window of a bounded input needs no
closing, and a batch costs what it touches, however much is stored.

The stateful builders (``fine_stream``, ``coarse_stream``, ...) emit each
window once, when a watermark has passed it; what comes later is dropped and
counted in the query's progress.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from functools import lru_cache
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.columns import bucket_start, duration_seconds, ltz_from_millis, ltz_to_ntz, ntz_from_millis
from adpulse.functions.constants import (CHART_GEO_ORDER, TARGET_PUB_GEO_COUNT, TARGET_RAW_COUNT,
                                         TARGET_STORED_COUNT, UNKNOWN_GEO)
from adpulse.operators import aggregate as agg
from adpulse.operators import metrics as met
from adpulse.sources import codec
from adpulse.sources.impressions import known_geo
from adpulse.streaming.levels import Folder, Levels, Manifest, Table


# -- stateful builders ----------------------------------------------------------------

def impression_stream(messages: DataFrame, strict: bool = True, time_mode: str = "event",
                      delay: str = "0 seconds") -> DataFrame:
    """Decoded known-geo impressions with ``event_time`` and a watermark."""
    if strict:
        decoded = codec.decode_strict(messages, keep=("arrival",))
    else:
        decoded = codec.accepted(codec.decode_permissive(messages, keep=("arrival",)))
    known = known_geo(decoded)
    if time_mode == "event":
        t = ltz_from_millis("timestamp")
    elif time_mode == "arrival":
        t = F.col("arrival")
    else:
        raise ValueError(f"time_mode must be 'event' or 'arrival', not {time_mode!r}")
    return known.withColumn("event_time", t).withWatermark("event_time", delay)


def fine_stream(impressions: DataFrame, window: str, bid_type: str = "double") -> DataFrame:
    return agg.fine_partials(impressions.drop("arrival"), window, time_col="event_time", bid_type=bid_type)


def coarse_stream(partials: DataFrame, window: str, fine_window: str) -> DataFrame:
    return agg.merge_partials(partials, window, fine_window=fine_window)


def share_wide_stream(partials: DataFrame, geos: Sequence[str] = CHART_GEO_ORDER, digits: int | None = None) -> DataFrame:
    """Per-geo bid share in wide form, one row per closed fine window."""
    results = partials.select("window", "geo",
                              (F.col("sum_bids").cast("double") / F.col("imps")).alias("avg_bids"))
    return met.geo_bid_share_wide(results, geos, by=["window"], digits=digits)


def rows_dropped_by_watermark(progress: list) -> int:
    """Sum of ``numRowsDroppedByWatermark`` over all stateful operators and
    batches. It counts rows reaching the operator, i.e. after partial
    aggregation, not input messages."""
    total = 0
    for p in progress:
        for op in (p.get("stateOperators") if isinstance(p, dict) else p.stateOperators) or []:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                      else op.numRowsDroppedByWatermark)
    return total


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Set ``spark.sql.shuffle.partitions`` around a query start (a streaming
    query copies the session conf when it starts and keeps the value in its
    checkpoint); ``None`` leaves the session as it is."""
    if n is None:
        yield
        return
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


@contextmanager
def stateful(spark: SparkSession, partitions: int | None = None):
    """Around the start of a stateful query: RocksDB keeps its state, in so
    many partitions (the cluster's parallelism unless given)."""
    name, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    saved = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        with shuffle_partitions(spark, partitions or spark.sparkContext.defaultParallelism):
            yield
    finally:
        spark.conf.set(name, saved)


def kept(df: DataFrame) -> DataFrame:
    """``df`` cached in as many partitions as its rows need, like any other
    result of adaptive execution, instead of one per shuffle partition. The
    setting is read when a plan is cached."""
    conf, name = df.sparkSession.conf, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    saved = conf.get(name)
    conf.set(name, "true")
    try:
        return df.persist()
    finally:
        conf.set(name, saved)


# -- the production job -----------------------------------------------------------------

COUNTERS = (TARGET_RAW_COUNT, TARGET_PUB_GEO_COUNT, TARGET_STORED_COUNT)
TOTALS = "totals"  # target of the rows of the metrics table that hold the counters
TOTAL_FIELDS = "run:string,batch:bigint,key:string,value:bigint,total:bigint"
SLOTS = 1000  # ranges of time by which a batch chooses the segments it reads


def _seconds(ntz: str) -> Column:
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(ntz))


def _by_key(partials: DataFrame) -> DataFrame:
    """One row per (window, publisher, geo), of the same types; ``v`` is the
    batch that opened it."""
    bids = partials.schema["sum_bids"].dataType  # sums of decimals have more digits
    return partials.groupBy("window", *agg.KEYS).agg(
        F.min("first_ts").alias("first_ts"), F.sum("sum_bids").cast(bids).alias("sum_bids"), F.sum("imps").alias("imps"),
        F.hll_union_agg("uniques_sketch").alias("uniques_sketch"), F.min("v").alias("v"))


def _last_written(*keys: str):
    """Merge that keeps, of the rows of a key, the one written last."""
    def merge(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*keys).agg(F.max_by(F.struct("*"), "v").alias("_r"))
        return last.select("_r.*")
    return merge


def job_levels(spark: SparkSession, root: str, **options) -> Levels:
    """The tables of a job: ``partials`` and ``late`` add up; ``store``,
    ``sliding`` and ``metrics`` hold the rows that were written last."""
    by_group = _last_written("window_start", *agg.KEYS)
    return Levels(spark, root, [
        Table("partials", lambda: _seconds("window.start"), _by_key),
        Table("late", lambda: _seconds("window.start"), _by_key),
        Table("store", lambda: _seconds("window_start"), by_group),
        Table("sliding", lambda: _seconds("window_start"), by_group),
        Table("metrics", lambda: F.col("ts"), _last_written("target", "ts", "report"))], **options)


def read_store(spark: SparkSession, root: str, table: str = "store") -> DataFrame:
    """The coarse (or ``sliding``) windows, one row per key."""
    return job_levels(spark, root).read(table).drop("v", "opened")


def read_partials(spark: SparkSession, root: str, table: str = "partials") -> DataFrame:
    """Merged fine partials of all geos, or those that came ``late``."""
    return job_levels(spark, root).read(table).drop("v")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(target, ts, data) of all five targets that a job has published."""
    return job_levels(spark, root).read("metrics").where(F.col("target") != TOTALS).select("target", "ts", "data")


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """(run, batch, key, value, total): the counters after each batch."""
    totals = job_levels(spark, root).read("metrics").where(F.col("target") == TOTALS)
    return totals.select(F.inline(F.from_json("data", f"array<struct<{TOTAL_FIELDS}>>")))


def _slots(own: DataFrame, low: int, high: int, length: int, margin: int) -> list[tuple[int, int]]:
    """Ranges of time that hold all coarse windows of a batch, with a margin on
    both sides: at most SLOTS, of one coarse window each if that is enough."""
    if high - low < length:  # a live batch: one window or two
        return [(low - low % length - margin, high - high % length + length - 1 + margin)]
    while (high - low) // length >= SLOTS:
        length *= 2
    found = sorted(r.slot for r in own.select(F.floor(_seconds("window.start") / length).alias("slot")).distinct().collect())
    return [(s * length - margin, (s + 1) * length - 1 + margin) for s in found]


def start_impression_job(spark: SparkSession, messages: DataFrame, root: str,
                         fine_window: str, coarse_window: str, trigger: dict | None = None,
                         time_mode: str = "arrival", strict: bool = True, rejects: bool = False,
                         from_start: bool = True, checkpoint: str | None = None,
                         bid_type: str = "double", digits: int | None = None, sliding: bool = False,
                         distinct_within: str | None = None, lateness: str | None = None,
                         levels: dict | None = None):
    """Start the whole job on a message stream; returns its query.

    Windows are of arrival time (broker or batch time), as in the reference,
    or of ``time_mode="event"``; no message is lost in either. Per batch, into
    the levelled tables of ``job_levels``:

    * ``partials``: mergeable partials of all geos;
    * ``metrics`` (``read_metrics``): group counts, per-geo impressions and bid
      shares of the fine windows that the batch touches, the rows stored per
      coarse window, and the batch's ingest report;
    * ``store`` (``read_store``): the coarse windows it touches, finalised, keyed
      by (window_start, publisher, geo);
    * ``sliding`` if asked for: windows of the coarse length that slide by the
      fine one, all that hold a message of the batch;
    * ``totals`` (``read_totals``): running totals of the three counters, where
      a (window, publisher, geo) row counts when it is first written;
    * ``late`` with ``lateness``: partials of windows that ended so long before
      the newest window of the earlier batches began, instead of ``partials``
      (``read_partials(..., "late")``; the counter ``lateCount`` has their sum);
    * ``rejects`` with ``strict=False, rejects=True``: malformed messages with
      their reason. Strict jobs fail on the first malformed message.

    A batch reads the partials of the coarse windows that it touches, nothing
    else. It becomes visible as a whole, by its manifest, and a batch that is
    repeated after a failure replaces what it left. A run is named after its
    checkpoint (``root/_checkpoint`` unless given). With ``from_start`` a run
    under a new checkpoint reads the topic from its start and partials of
    earlier runs no longer count; without it they do (a run that goes on where
    another ended). ``distinct_within`` drops messages whose key came before,
    at most so much earlier by arrival (a producer that sends again).
    ``levels``: ``fanout`` and ``segment_bytes`` of the tables. ``trigger``
    defaults to the 1-second micro-batch; ``stop()`` the query to end the job.
    """
    if time_mode not in ("event", "arrival"):
        raise ValueError(f"time_mode must be 'event' or 'arrival', not {time_mode!r}")
    fine_s, coarse_s = duration_seconds(fine_window), duration_seconds(coarse_window)
    if coarse_s % fine_s:
        raise ValueError(f"{coarse_window!r} is not a multiple of {fine_window!r}")
    checkpoint = checkpoint or f"{root}/_checkpoint"
    if distinct_within is not None:
        messages = messages.withWatermark("arrival", distinct_within).dropDuplicatesWithinWatermark(["key"])
    if strict:
        decoded = codec.decode_strict(messages, keep=("arrival",))
    else:
        decoded = codec.decode_permissive(messages.withColumn("raw", F.col("value")), keep=("key", "arrival", "raw"))
    event_time = ntz_from_millis("timestamp") if time_mode == "event" else ltz_to_ntz("arrival")
    known = F.col("geo") != UNKNOWN_GEO

    def write_own(batch: DataFrame, tables: Levels, manifest: Manifest) -> tuple[dict, DataFrame]:
        """Decode to partials: the only step that reads messages. Returns what
        was counted, and the partials written."""
        good = batch
        if not strict:
            batch = batch.persist() if rejects else batch  # decoded once for both writes
            good = codec.accepted(batch)
        fine = agg.fine_partials(good.withColumn("event_time", event_time), fine_window, time_col="event_time", bid_type=bid_type)
        fine = fine.withColumn("v", F.lit(manifest.v).cast("bigint"))
        newest = manifest.counters.get("newest")
        if lateness is not None and newest is not None:
            fine = kept(fine)
            in_time = _seconds("window.end") > newest - duration_seconds(lateness)
            late = tables.write(manifest, "late", fine.where(~in_time), messages=F.sum("imps"))
            manifest.counters["lateCount"] = manifest.counters.get("lateCount", 0) + (late.get("messages") or 0)
            seen = tables.write(manifest, "partials", fine.where(in_time), messages=F.sum("imps"))
            fine.unpersist()
        else:
            seen = tables.write(manifest, "partials", fine, messages=F.sum("imps"))
        if seen.get("rows"):
            manifest.counters["newest"] = max(seen["high"], seen["high"] if newest is None else newest)
        if rejects and not strict:
            bad = codec.rejects(batch).select("key", "arrival", "reject_reason", F.col("raw").alias("value"))
            bad.write.mode("overwrite").parquet(f"{root}/rejects/run={manifest.run}/batch={manifest.batch}")
            batch.unpersist()
        return seen, written(tables, manifest, "partials", fine)

    def written(tables: Levels, manifest: Manifest, table: str, like: DataFrame) -> DataFrame:
        """What this batch has just written to a table."""
        return tables.rows(tables.segments(manifest, table)[-1:], like.schema)

    def publish(own: DataFrame, tables: Levels, manifest: Manifest, seen: dict) -> tuple[dict[str, int], DataFrame, DataFrame]:
        """Merge what the batch touches; returns the new groups per counter,
        the metrics of the touched windows, and the windows they are read from."""
        margin = coarse_s if sliding else 0
        near = tables.segments(manifest, "partials", _slots(own, seen["low"], seen["high"], coarse_s, margin))
        manifest.read = sum(s.size for s in near)
        coarse_start = bucket_start("window.start", coarse_s)
        touched = own.where(known).select(coarse_start.alias("touched")).distinct()
        between = _seconds("window.start").between(seen["low"] - coarse_s - margin, seen["high"] + coarse_s + margin)
        rows = tables.rows(near, own.schema).where(known & between)
        fine = kept(_by_key(rows.withColumn("touched", coarse_start).join(touched, "touched", "left_semi").drop("touched")))
        at = F.lit(manifest.v).cast("bigint")
        merged = agg.merge_partials(fine, coarse_window, fine_window=fine_window, time_col="window.start",
                                    also={"opened": F.min("v"), "_opened": F.count_if(F.col("v") == at)})
        coarse = agg.finalise(merged, also=["opened", "_opened"]).withColumn("v", at)
        stored = tables.write(manifest, "store", coarse, groups=F.sum("_opened"), new=F.count_if(F.col("opened") == at))
        new = {TARGET_PUB_GEO_COUNT: stored.get("groups") or 0, TARGET_STORED_COUNT: stored.get("new") or 0}
        coarse = coarse.drop("_opened")
        if stored.get("rows"):
            coarse = written(tables, manifest, "store", coarse)
        if sliding:
            wide = agg.merge_partials(rows, coarse_window, fine_window, fine_window, time_col="window.start")
            held = own.where(known).select(F.col("window.start").alias("_t")).select(F.window("_t", coarse_window, fine_window).alias("window")).distinct()
            tables.write(manifest, "sliding", agg.finalise(wide.join(held, "window", "left_semi")).withColumn("v", at))
        metrics = met.window_metrics(agg.averages(fine), digits).unionByName(met.stored_metric(coarse))
        return new, metrics, fine

    @lru_cache(maxsize=1)
    def run_id(spark: SparkSession) -> str:
        return json.loads(Folder(spark, checkpoint).read("metadata"))["id"]

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = job_levels(spark, root, **(levels or {}))
        run = run_id(spark)
        manifest = tables.begin(run, batch_id)
        if from_start and manifest.counters.get("run") != run:
            manifest.segments = [s for s in manifest.segments if s.table not in ("partials", "late", "sliding")]
            manifest.counters = {}
        seen, own = write_own(batch, tables, manifest)
        counters = {**dict.fromkeys(COUNTERS, 0), **manifest.counters, "run": run}
        new, rows, fine = {}, None, None
        if seen.get("rows"):
            new, rows, fine = publish(own, tables, manifest, seen)
        new[TARGET_RAW_COUNT] = seen.get("messages") or 0
        v, ts = F.lit(manifest.v).cast("bigint"), F.lit(counters.get("newest", -fine_s) + fine_s).cast("bigint")
        values = [{"run": run, "batch": batch_id, "key": key, "value": new.get(key, 0), "total": counters[key] + new.get(key, 0)} for key in COUNTERS]
        counters |= {x["key"]: x["total"] for x in values}
        one = spark.range(1).select(ts.alias("ts"), F.lit(new[TARGET_RAW_COUNT]).cast("bigint").alias("value"), F.lit(counters[TARGET_RAW_COUNT]).cast("bigint").alias("total"))
        report = met.report_increment(one).unionByName(one.select(F.lit(TOTALS).alias("target"), "ts", F.lit(json.dumps(values)).alias("data")))
        report = report.withColumn("report", v)  # one row per batch, whatever its time
        if rows is not None:
            report = report.unionByName(rows.withColumn("report", F.lit(-1).cast("bigint")))
        tables.write(manifest, "metrics", report.withColumn("v", v))
        if fine is not None:
            fine.unpersist()
        manifest.counters = counters
        tables.commit(manifest)

    decoded = decoded.observe("ingest", F.count(F.lit(1)).alias("messages"), F.count_if(known).alias("known"))
    return (decoded.writeStream.queryName("impressions").option("checkpointLocation", checkpoint)
            .foreachBatch(process).trigger(**(trigger or {"processingTime": "1 second"})).start())
