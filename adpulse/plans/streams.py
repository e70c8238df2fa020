"""Streaming queries: the impression messages of ``events``, encoded as JSON and
published to a topic in the order in which they arrive, go through the
production job or through a stateful query in several micro-batches, run to
completion; the result is read back from the sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.constants import (EXACT_BID_TYPE, EXACT_SHARE_DIGITS, TARGET_GEO_AVG_BIDS, TARGET_GEO_IMPS,
                                         TARGET_PUB_GEO_COUNT, TARGET_RAW_COUNT, UNKNOWN_GEO)
from adpulse.operators import aggregate as agg
from adpulse.operators import metrics as met
from adpulse.functions.columns import ntz_from_millis
from adpulse.plans.catalog import COARSE, FINE, GAP_WINDOW
from adpulse.session import work_dir
from adpulse.sources import codec
from adpulse.sources.impressions import impression_columns
from adpulse.sources.tables import read_table
from adpulse.sources.sinks import batch_writer
from adpulse.streaming import jobs, progress, state
from adpulse.streaming.sources import message_stream, write_topic

ONCE = {"availableNow": True}
WINDOW_TARGETS = (TARGET_PUB_GEO_COUNT, TARGET_GEO_IMPS, TARGET_GEO_AVG_BIDS)
SLICES = 5  # micro-batches that a query's input makes at least


def arrivals(spark: SparkSession, base: str) -> DataFrame:
    """What messages are made of: the columns of ``events`` that impressions
    read, dealt evenly to all cores however the table is split, with the key
    and the arrival of the message. A third of them arrive an hour after the
    event, a third two hours after it."""
    events = read_table(spark, base, "events").select("event_id", "ts", "user_id", "value", "props")
    delay = F.make_dt_interval(hours=(F.col("event_id") % 3).cast("int"))
    return events.repartition(spark.sparkContext.defaultParallelism).withColumns(
        {"key": F.col("event_id").cast("string"), "arrival": (F.col("ts") + delay).cast("timestamp")})


def messages(arrived: DataFrame) -> DataFrame:
    """Arrivals as messages (key, value, arrival)."""
    return codec.encode_messages(arrived.select("key", "arrival", *impression_columns()), keep=("key", "arrival"))


def publish(arrived: DataFrame, topic: str, order: Column | None = None, slices: int = SLICES) -> str:
    """Append the messages of ``arrived`` to a topic (a folder of files here)
    in ``slices`` steps of equal length by ``order``, the arrival unless given.

    The rows are staged as they come; a step then encodes its own, so each
    message is encoded once. Rows dealt evenly give steps whose files hold about
    the same number of messages, and batches that all cores read."""
    spark, staged = arrived.sparkSession, f"{topic}-staged"
    arrived.withColumn("_at", F.unix_micros("arrival") if order is None else order).write.parquet(staged)
    dealt = spark.read.parquet(staged)
    low, high = dealt.agg(F.min("_at"), F.max("_at")).first()
    if low is None:
        messages(dealt).write.parquet(topic)
        return topic
    step = F.floor((F.col("_at") - low) * slices / (high - low + 1))
    for k in range(slices):
        messages(dealt.where(step == k)).write.mode("append").parquet(topic)
    return topic


def consume(spark: SparkSession, topic: str, batches: int = SLICES) -> DataFrame:
    """The topic as a stream that takes ``batches`` micro-batches at least."""
    files = len(spark.read.parquet(topic).inputFiles())
    return message_stream(spark, "table", topic, batch_limit=max(1, files // batches))


def topic_of(spark: SparkSession, base: str, name: str, only: Column | None = None, **how) -> str:
    arrived = arrivals(spark, base)
    return publish(arrived if only is None else arrived.where(only), f"{work_dir(spark, name)}/topic", **how)


def run(query) -> None:
    query.awaitTermination()


def start(source: DataFrame, root: str, **options):
    options = {"time_mode": "event", "bid_type": EXACT_BID_TYPE, "digits": EXACT_SHARE_DIGITS, "trigger": ONCE} | options
    return jobs.start_impression_job(source.sparkSession, source, root, FINE, COARSE, **options)


def run_job(spark: SparkSession, base: str, name: str, **options) -> str:
    """The production job on ``events``, run to completion in several batches."""
    topic = topic_of(spark, base, name)
    root = f"{topic}-job"
    run(start(consume(spark, topic), root, **options))
    return root


def fine_windows(spark: SparkSession, root: str) -> DataFrame:
    """Fine windows of the job's partials."""
    return agg.finalise(jobs.read_partials(spark, root).where(F.col("geo") != UNKNOWN_GEO))


def q_stream_fine_agg(spark, base):
    return fine_windows(spark, run_job(spark, base, "stream-fine"))


def q_stream_coarse_agg(spark, base):
    return jobs.read_store(spark, run_job(spark, base, "stream-coarse"))


def q_stream_share_wide(spark, base):
    results = fine_windows(spark, run_job(spark, base, "stream-share"))
    return met.geo_bid_share_wide(results, digits=EXACT_SHARE_DIGITS)


def q_stream_totals(spark, base):
    """The three counters: what the batches added, and the last total."""
    totals = jobs.read_totals(spark, run_job(spark, base, "stream-totals"))
    return totals.groupBy("key").agg(F.sum("value").alias("value"), F.max("total").alias("total"))


def q_stream_arrival_totals(spark, base):
    """Windows of arrival time: every known impression, in the hour in which
    its message arrived."""
    root = run_job(spark, base, "stream-arrival", time_mode="arrival")
    return fine_windows(spark, root).select("window_start", "publisher", "geo", "imps")


def q_stream_sink_idempotent(spark, base):
    """The job again under a new checkpoint, from the start of the topic and in
    other batches: the store holds each coarse window once."""
    topic = topic_of(spark, base, "stream-again")
    root = f"{topic}-job"
    run(start(consume(spark, topic), root))
    run(start(consume(spark, topic, batches=2), root, checkpoint=f"{root}/_checkpoint_2"))
    return jobs.read_store(spark, root)


def q_stream_stored_count(spark, base):
    """Rows in the store, and new rows counted while writing, batch by batch."""
    root = run_job(spark, base, "stream-count")
    stored = jobs.read_store(spark, root).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("stored").alias("counter"), "rows")
    written = jobs.read_totals(spark, root).where("key = 'mongoCount'").agg(F.sum("value").alias("rows")).select(F.lit("written").alias("counter"), "rows")
    return stored.unionByName(written)


def q_stream_late_data(spark, base):
    """A fifth of the messages comes in a later run, after all windows have
    been stored: the store then holds them, too."""
    late = F.col("key").cast("bigint") % 5 == 1
    root = f"{work_dir(spark, 'stream-late')}/job"
    run(start(consume(spark, topic_of(spark, base, "stream-late", ~late)), root))
    run(start(consume(spark, topic_of(spark, base, "stream-late", late)), root, checkpoint=f"{root}/_checkpoint_late", from_start=False))
    return jobs.read_store(spark, root)


def q_stream_fan_out(spark, base):
    """Per-window metrics that the job writes beside the store."""
    root = run_job(spark, base, "stream-fanout")
    return jobs.read_metrics(spark, root).where(F.col("target").isin(*WINDOW_TARGETS))


def q_stream_job_metrics(spark, base):
    """All five targets, as the job publishes them; the ingest reports of the
    batches summed up."""
    every = jobs.read_metrics(spark, run_job(spark, base, "stream-metrics"))
    reports = every.where(F.col("target") == TARGET_RAW_COUNT).groupBy("target").agg(
        F.max("ts").alias("ts"), F.sum(F.col("data").cast("bigint")).cast("string").alias("data"))
    return every.where(F.col("target") != TARGET_RAW_COUNT).unionByName(reports)


def q_stream_topic_roundtrip(spark, base):
    """Messages published to a topic by a stream (a folder of text here) and
    consumed again."""
    topic = topic_of(spark, base, "stream-topic")
    run(write_topic(consume(spark, topic), f"{topic}-ckpt", kind="text", path=f"{topic}-text", trigger=ONCE))
    run(start(message_stream(spark, "text", f"{topic}-text", batch_limit=1), f"{topic}-job"))
    return jobs.read_store(spark, f"{topic}-job")


def q_stream_admission(spark, base):
    """One input in one, five and ten batches: equal stores."""
    topic, out = topic_of(spark, base, "stream-admission", slices=10), None
    for batches in (1, 5, 10):
        root = f"{topic}-job-{batches}"
        query = start(consume(spark, topic, batches), root)
        run(query)
        rows = jobs.read_store(spark, root).select(F.lit(batches).alias("batches"), "window_start", "publisher", "geo", "imps", "uniques", "avg_bids")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_stream_sliding(spark, base):
    """Sliding windows kept by the job while messages come out of order (by
    key, not by time): a late message updates all windows that hold it."""
    topic = topic_of(spark, base, "stream-sliding", order=F.hash("key").cast("bigint"))
    run(start(consume(spark, topic), f"{topic}-job", sliding=True))
    return jobs.read_store(spark, f"{topic}-job", "sliding")


def q_stream_distinct(spark, base):
    """Every message is sent twice, the second time in a later batch: the store
    is that of one copy."""
    twice = arrivals(spark, base).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    topic = publish(twice, f"{work_dir(spark, 'stream-distinct')}/topic", order=F.unix_micros("arrival") + F.col("again") * 3 * 86_400_000_000)
    run(start(consume(spark, topic), f"{topic}-job", distinct_within="4 days"))
    return jobs.read_store(spark, f"{topic}-job")


def q_stream_watermark(spark, base):
    """The stateful form: fine windows in update mode with a watermark that
    lets everything in; a window that several batches update is merged by key,
    the last batch that has it wins."""
    topic = topic_of(spark, base, "stream-state")
    fine = jobs.fine_stream(jobs.impression_stream(consume(spark, topic), delay="40 days"), FINE, bid_type=EXACT_BID_TYPE)

    def write(batch: DataFrame, batch_id: int) -> None:
        agg.finalise(batch).write.mode("overwrite").parquet(f"{topic}-out/batch={batch_id}")

    with jobs.stateful(spark):
        run(fine.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{topic}-ckpt").trigger(**ONCE).start())
    written = spark.read.parquet(f"{topic}-out")
    return written.groupBy("window_start", *agg.KEYS).agg(F.max_by(F.struct(*[c for c in written.columns if c != "batch"]), "batch").alias("r")).select("r.*")


def q_stream_progress(spark, base):
    """What a listener kept of the running job: messages observed in it, beside
    the rows written and stored."""
    topic = topic_of(spark, base, "stream-progress")
    root = f"{topic}-job"
    progress.logged(spark, root, lambda: start(consume(spark, topic), root))
    log = progress.read_progress(spark, root)
    rows = [log.agg(F.sum(F.col("observed")["ingest.messages"]).alias("rows")).select(F.lit("observed").alias("counter"), "rows"),
            log.agg(F.sum(F.col("observed")["ingest.known"]).alias("rows")).select(F.lit("known").alias("counter"), "rows"),
            log.agg(F.sum("dropped_by_watermark").alias("rows")).select(F.lit("dropped").alias("counter"), "rows"),
            jobs.read_totals(spark, root).where("key = 'mongoCount'").agg(F.sum("value").alias("rows")).select(F.lit("written").alias("counter"), "rows"),
            jobs.read_store(spark, root).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("stored").alias("counter"), "rows")]
    return reduce(DataFrame.unionByName, rows)


# -- stateful forms: windows close behind a watermark -----------------------------------

DELAY = "3 hours"  # messages come two hours after their event at most


def closing(spark: SparkSession, base: str) -> DataFrame:
    """One message of ten days after the last event: the watermark then passes
    every window of ``events``; its own window stays open."""
    last = read_table(spark, base, "events").agg(F.max("ts").alias("ts"))
    at = (F.col("ts") + F.expr("INTERVAL 10 days")).cast("timestamp")
    fields = [F.lit("closing").alias(f) for f in codec.IMPRESSION_FIELDS if f not in ("timestamp", "bid", "geo")]
    row = last.select(F.lit("closing").alias("key"), at.alias("arrival"), F.unix_millis(at).alias("timestamp"), *fields,
                      F.lit("NY").alias("geo"), F.lit(0.0).alias("bid"))
    return codec.encode_messages(row, keep=("key", "arrival"))


def closed_partials(spark: SparkSession, base: str, name: str, window: str = FINE) -> tuple[str, DataFrame]:
    """A topic of ``events`` with its closing message, and the stream of its
    fine partials, each published when its window has closed."""
    topic = topic_of(spark, base, name)
    closing(spark, base).write.mode("append").parquet(topic)
    known = jobs.impression_stream(consume(spark, topic), delay=DELAY)
    return topic, jobs.fine_stream(known, window, bid_type=EXACT_BID_TYPE)


def collected(out: DataFrame, topic: str, partitions: int | None = None) -> DataFrame:
    """Run a stateful stream to its end; all that it published, with its batch."""
    spark = out.sparkSession
    with jobs.stateful(spark, partitions):
        run(out.writeStream.outputMode("append").foreachBatch(batch_writer(f"{topic}-out")).option("checkpointLocation", f"{topic}-ckpt")
            .trigger(**ONCE).start())
    return spark.read.schema(f"{schema_text(out)}, batch_id int").parquet(f"{topic}-out")


def schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def q_stream_chained_windows(spark, base):
    """Two chained stateful aggregates: coarse windows over closed fine ones."""
    topic, fine = closed_partials(spark, base, "stream-chained")
    return collected(agg.finalise(jobs.coarse_stream(fine, COARSE, FINE)), topic).drop("batch_id")


def q_stream_group_count_filled(spark, base):
    """Groups per 10-minute window as a stream publishes them, 0 for windows
    without any; up to the last window with events."""
    topic, fine = closed_partials(spark, base, "stream-filled", GAP_WINDOW)
    counts = fine.groupBy("window").agg(F.count(F.lit(1)).alias("value"))
    points = counts.select(F.lit(TARGET_PUB_GEO_COUNT).alias("key"), F.unix_timestamp("window.start").alias("at"), "value", "window")
    out = collected(state.filled(points, GAP_WINDOW), topic, partitions=1)
    last = out.where("value > 0").groupBy("key").agg(F.max("at").alias("last"))
    start = ntz_from_millis(F.col("at") * 1000)
    return out.join(last, "key").where("at <= last").select(
        start.alias("window_start"), (start + F.expr(f"INTERVAL {GAP_WINDOW}")).alias("window_end"), F.col("value").alias("pub_geo_count"))


def last_shown(out: DataFrame, *columns: str) -> DataFrame:
    """Of what a key has published batch by batch, the last."""
    return out.groupBy("key").agg(F.max_by(F.struct(*columns), "batch_id").alias("r")).select("key", "r.*")


def q_stream_latest_n(spark, base):
    """Latest 30 points of each bid-share series, from the 60 that it holds."""
    topic, fine = closed_partials(spark, base, "stream-latest")
    series = met.unpivot_series(jobs.share_wide_stream(fine, digits=EXACT_SHARE_DIGITS), ["window_start", "window_end", "ts"])
    out = collected(state.histories(series.select(F.col("label").alias("key"), F.col("ts").alias("at"), F.col("y").cast("bigint").alias("value"))), topic, partitions=2)
    points = last_shown(out, "points").select(F.col("key").alias("label"), F.inline("points"))
    end = ntz_from_millis(F.col("at") * 1000)
    return points.select((end - F.expr(f"INTERVAL {FINE}")).alias("window_start"), end.alias("window_end"), F.col("at").alias("ts"), "label", F.col("value").cast("int").alias("y"))


def geo_points(fine: DataFrame) -> DataFrame:
    """Impressions per geo and closed window."""
    per_geo = fine.groupBy("window", "geo").agg(F.sum("imps").alias("value"))
    return per_geo.select(F.col("geo").alias("key"), F.unix_timestamp("window.end").alias("at"), "value")


def q_stream_gauges(spark, base):
    """Per geo gauge: the last hourly impressions within the ceiling."""
    topic, fine = closed_partials(spark, base, "stream-gauges")
    shown = last_shown(collected(state.gauges(geo_points(fine)), topic, partitions=2), "at", "value")
    return shown.select(F.col("key").alias("geo"), ntz_from_millis(F.col("at") * 1000).alias("window_end"), F.col("value").alias("imps"), met.gauge_text("value").alias("text"))


def q_stream_counters(spark, base):
    """Per geo counter: running total of impressions, and what its batches added."""
    topic, fine = closed_partials(spark, base, "stream-counters")
    out = collected(state.counters(geo_points(fine)), topic, partitions=2)
    return out.groupBy(F.col("key").alias("geo")).agg(F.sum("value").alias("added"), F.max("total").alias("total"))


def q_stream_late_side(spark, base):
    """Messages in an order that is not that of time: those of windows that
    ended three days before the newest window go to the late table."""
    topic = topic_of(spark, base, "stream-late-side", order=F.col("key").cast("bigint") * 7919 % 10007)
    run(start(consume(spark, topic), f"{topic}-job", lateness="3 days"))
    sides = [jobs.read_partials(spark, f"{topic}-job", table).where(F.col("geo") != UNKNOWN_GEO).groupBy(*agg.KEYS).agg(F.sum("imps").alias("imps"))
             .select(F.lit(side).alias("side"), *agg.KEYS, "imps") for side, table in (("kept", "partials"), ("late", "late"))]
    return sides[0].unionByName(sides[1])


STREAM_QUERIES = {
    "stream_fine_agg": q_stream_fine_agg,
    "stream_coarse_agg": q_stream_coarse_agg,
    "stream_share_wide": q_stream_share_wide,
    "stream_totals": q_stream_totals,
    "stream_arrival_totals": q_stream_arrival_totals,
    "stream_sink_idempotent": q_stream_sink_idempotent,
    "stream_stored_count": q_stream_stored_count,
    "stream_late_data": q_stream_late_data,
    "stream_watermark": q_stream_watermark,
    "stream_fan_out": q_stream_fan_out,
    "stream_job_metrics": q_stream_job_metrics,
    "stream_topic_roundtrip": q_stream_topic_roundtrip,
    "stream_admission": q_stream_admission,
    "stream_sliding": q_stream_sliding,
    "stream_distinct": q_stream_distinct,
    "stream_progress": q_stream_progress,
    "stream_chained_windows": q_stream_chained_windows,
    "stream_group_count_filled": q_stream_group_count_filled,
    "stream_latest_n": q_stream_latest_n,
    "stream_gauges": q_stream_gauges,
    "stream_counters": q_stream_counters,
    "stream_late_side": q_stream_late_side,
}
