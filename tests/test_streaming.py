import pytest
from pyspark.sql import functions as F

from adpulse.operators import aggregate as agg
from adpulse.plans.catalog import COARSE, FINE, impressions
from adpulse.session import work_dir
from adpulse.sources.impressions import known_geo
from adpulse.functions.constants import EXACT_BID_TYPE
from adpulse.sources import codec
from adpulse.sources.sinks import batch_writer
from adpulse.streaming import jobs
from adpulse.streaming.sources import message_stream, topic_sink_options, write_topic
from helpers import SF_SMALL, rows
from replay import retried, run_slices

ONCE = {"availableNow": True}
IMPRESSION = ("timestamp bigint, publisher string, advertiser string, website string, "
              "geo string, bid double, cookie string")
COLS = ("window_start", "window_end", "publisher", "geo", "date", "imps", "uniques", "avg_bids")


def _messages(spark):
    return codec.encode_messages(impressions(spark, SF_SMALL), keep=("timestamp",))


def _fine(src):
    return jobs.fine_stream(jobs.impression_stream(src), FINE, bid_type=EXACT_BID_TYPE)


def _coarse(src):
    return agg.finalise(jobs.coarse_stream(_fine(src), COARSE, FINE))


def _closed_batch(spark, window, base=SF_SMALL):
    imp = known_geo(impressions(spark, base))
    mx = imp.agg(F.max("timestamp")).first()[0]
    res = agg.window_aggregate(imp, window, bid_type=EXACT_BID_TYPE)
    return res.where(F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', window_end) <= {mx}"))


def test_stream_equals_batch_minus_open_window(spark):
    folder = work_dir(spark, "t-coarse")
    sink, progress = run_slices(spark, _messages(spark), 4, _coarse, folder)
    got = spark.read.parquet(sink).drop("batch_id")
    assert rows(got, *COLS) == rows(_closed_batch(spark, COARSE), *COLS)
    assert jobs.rows_dropped_by_watermark(progress) == 0


def test_restart_per_slice_gives_same_result(spark):
    folder = work_dir(spark, "t-restart")
    sink, progress = run_slices(spark, _messages(spark), 3,
                                     lambda s: agg.finalise(_fine(s)), folder,
                                     restart_each_slice=True)
    got = spark.read.parquet(sink).drop("batch_id")
    assert rows(got, *COLS) == rows(_closed_batch(spark, FINE), *COLS)


def test_retried_batches_leave_one_copy(spark):
    folder = work_dir(spark, "t-idem")
    sink = f"{folder}/sink"
    run_slices(spark, _messages(spark), 3, _coarse, folder,
                    writer=retried(batch_writer(sink), attempts=3), sink=sink)
    got = spark.read.parquet(sink).drop("batch_id")
    assert got.count() == _closed_batch(spark, COARSE).count()


def test_late_slice_is_dropped_and_reported(spark):
    folder = work_dir(spark, "t-late")
    sink, progress = run_slices(spark, _messages(spark), 5, _coarse,
                                     folder, order=(0, 2, 3, 4, 1))
    assert jobs.rows_dropped_by_watermark(progress) > 0
    on_time = spark.read.parquet(sink).agg(F.sum("imps")).first()[0]
    assert on_time < _closed_batch(spark, COARSE).agg(F.sum("imps")).first()[0]


def test_arrival_time_windows_count_every_row(spark):
    # arrival mode: windows on the batch time; complete mode totals see every known row
    folder = work_dir(spark, "t-arrival")
    sink = f"{folder}/sink"

    def build(src):
        imp = jobs.impression_stream(src, time_mode="arrival")
        return imp.groupBy("publisher", "geo").agg(F.count(F.lit(1)).alias("imps"))

    run_slices(spark, _messages(spark), 2, build, folder,
               writer=lambda batch, k: batch.write.mode("overwrite").parquet(sink), output_mode="complete", sink=sink)
    got = rows(spark.read.parquet(sink), "publisher", "geo", "imps")
    want = rows(known_geo(impressions(spark, SF_SMALL)).groupBy("publisher", "geo")
                .agg(F.count(F.lit(1)).alias("imps")), "publisher", "geo", "imps")
    assert got == want


def test_strict_stream_fails_on_malformed_message(spark):
    folder = work_dir(spark, "t-strict")
    bad = spark.createDataFrame([('{"timestamp":1}', 1)], "value string, timestamp bigint")
    msgs = _messages(spark).unionByName(bad)
    with pytest.raises(Exception):
        run_slices(spark, msgs, 2, _coarse, folder)


def test_kafka_source_is_optional(spark):
    from adpulse.streaming.sources import message_stream
    try:
        message_stream(spark, "kafka", servers="127.0.0.1:1", topic="t")
    except Exception as e:  # connector jar absent in this image
        assert "kafka" in str(e).lower()


def _job(spark, source, root, **options):
    options = {"time_mode": "event", "bid_type": EXACT_BID_TYPE} | options
    query = jobs.start_impression_job(spark, message_stream(spark, "text", source), root, FINE, COARSE, trigger=ONCE, **options)
    query.awaitTermination()
    return query


def _store(spark, root):
    return jobs.read_store(spark, root)


def _coarse_batch(spark):
    fine = agg.fine_partials(known_geo(impressions(spark, SF_SMALL)), FINE, bid_type=EXACT_BID_TYPE)
    return agg.finalise(agg.merge_partials(fine, COARSE, fine_window=FINE))


def test_whole_job_reads_raw_messages_once(spark):
    folder = work_dir(spark, "t-job")
    msgs = _messages(spark)
    msgs.select("value").write.text(f"{folder}/in")
    root = f"{folder}/job"
    query = _job(spark, f"{folder}/in", root)
    assert sum(p["numInputRows"] for p in query.recentProgress) == msgs.count()
    assert rows(_store(spark, root), *COLS) == rows(_coarse_batch(spark), *COLS)
    totals = {r.key: r.total for r in jobs.read_totals(spark, root).collect()}
    assert len(totals) == 3 and totals["pubGeoCount"] == jobs.read_partials(spark, root).where("geo <> 'unknown'").count()
    assert totals["mongoCount"] == _store(spark, root).count() and totals["rawCount"] == msgs.count()
    targets = {r.target for r in jobs.read_metrics(spark, root).select("target").distinct().collect()}
    assert targets == {"pubGeoCount", "geoImpsCounts", "geoAvgBids", "mongoCount", "rawCount"}


def test_job_over_several_batches_late_messages_and_restarts(spark):
    """Four batches in no order of time, one per restart: every message is in
    the store, once; the counters run on."""
    folder = work_dir(spark, "t-batches")
    root, n = f"{folder}/job", 4
    msgs = _messages(spark)
    part = F.pmod(F.hash("value"), F.lit(n))
    for k in range(n):
        msgs.where(part == k).select("value").write.mode("append").text(f"{folder}/in")
        _job(spark, f"{folder}/in", root)
    assert rows(_store(spark, root), *COLS) == rows(_coarse_batch(spark), *COLS)
    totals = jobs.read_totals(spark, root).where("key = 'rawCount'").orderBy("total").collect()
    assert len(totals) == n and totals[-1].total == msgs.count() == sum(r.value for r in totals)
    reported = jobs.read_metrics(spark, root).where("target = 'rawCount'").agg(F.sum(F.col("data").cast("long"))).first()[0]
    assert reported == msgs.count() // 100 * 100
    # a new checkpoint reads the topic from its start: nothing counts twice, nothing is lost
    _job(spark, f"{folder}/in", root, checkpoint=f"{root}/_again")
    assert rows(_store(spark, root), *COLS) == rows(_coarse_batch(spark), *COLS)
    manifest = jobs.job_levels(spark, root).latest()
    assert manifest.counters["rawCount"] == msgs.count() and sum(s.table == "partials" for s in manifest.segments) == 1


def test_strict_job_fails_and_keeps_the_whole_message(spark):
    folder = work_dir(spark, "t-bad")
    long = '{"timestamp":1,"publisher":"' + "p" * 400 + '"}'
    spark.createDataFrame([(long,)], "value string").write.text(f"{folder}/in")
    with pytest.raises(Exception) as failure:
        _job(spark, f"{folder}/in", f"{folder}/job")
    assert "p" * 400 in str(failure.value)


def test_job_side_output_of_rejects(spark):
    from adpulse.plans.catalog import damaged_messages
    folder = work_dir(spark, "t-rejects")
    damaged_messages(spark, SF_SMALL).select("value").write.text(f"{folder}/in")
    root = f"{folder}/job"
    _job(spark, f"{folder}/in", root, strict=False, rejects=True)
    got = rows(spark.read.parquet(f"{root}/rejects").groupBy("reject_reason").count())
    want = rows(codec.rejects(codec.decode_permissive(damaged_messages(spark, SF_SMALL))).groupBy("reject_reason").count())
    assert got == want and len(got) == 8
    n_bad = sum(n for _, n in got)
    accepted = jobs.read_partials(spark, root).agg(F.sum("imps")).first()[0]
    assert accepted + n_bad == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_topic_sink(spark):
    options = topic_sink_options("broker:9092", "topic")
    assert int(options["kafka.batch.size"]) >= 1024 and options["topic"] == "topic"
    folder = work_dir(spark, "t-topic")
    _messages(spark).select("value").write.text(f"{folder}/in")
    out = message_stream(spark, "text", f"{folder}/in")
    write_topic(out, f"{folder}/ckpt", kind="text", path=f"{folder}/out", trigger=ONCE).awaitTermination()
    assert rows(spark.read.text(f"{folder}/out"), "value") == rows(_messages(spark), "value")


def test_one_second_trigger(spark):
    """The default trigger: batches come by themselves until the job is stopped."""
    folder = work_dir(spark, "t-live")
    _messages(spark).limit(200).select("value").write.text(f"{folder}/in")
    query = jobs.start_impression_job(spark, message_stream(spark, "text", f"{folder}/in"), f"{folder}/job", FINE, COARSE)
    try:
        query.processAllAvailable()
        assert jobs.read_totals(spark, f"{folder}/job").where("key = 'rawCount'").first().total == 200
    finally:
        query.stop()


def test_slices_smaller_than_parallelism(spark):
    """Slices of 3 rows come out as 3 files, not F: each is processed as soon
    as it is appended, so no batch straddles two slices."""
    hour = 3_600_000
    imp = spark.createDataFrame(
        [(t * hour + 1, f"publisher_{t % 2}", "advertiser_0", "w.com", "NY", 0.25, f"c{t}")
         for t in range(9)], IMPRESSION)
    msgs = codec.encode_messages(imp, keep=("timestamp",))
    folder = work_dir(spark, "t-small")
    sink, progress = run_slices(spark, msgs, 3, lambda s: agg.finalise(_fine(s)), folder)
    got = spark.read.parquet(sink).drop("batch_id")
    want = agg.window_aggregate(imp, FINE, bid_type=EXACT_BID_TYPE).where(F.col("window_end") <= F.expr("TIMESTAMP_NTZ'1970-01-01 08:00:00.001'"))
    assert rows(got, *COLS) == rows(want, *COLS)
    assert sum(1 for p in progress if p["numInputRows"] > 0) == 3
    assert jobs.rows_dropped_by_watermark(progress) == 0


def test_watermark_delay_accepts_late_slice(spark):
    """Slice 1 arrives after slice 2 but within the 15-day delay: nothing is
    dropped, and windows ending at least 15 days before the last event are
    emitted with all of their impressions."""
    folder = work_dir(spark, "t-delay")

    def build(src):
        return agg.finalise(jobs.fine_stream(jobs.impression_stream(src, delay="15 days"), COARSE, bid_type=EXACT_BID_TYPE))

    sink, progress = run_slices(spark, _messages(spark), 5, build, folder,
                                     order=(0, 2, 1, 3, 4))
    assert jobs.rows_dropped_by_watermark(progress) == 0
    imp = known_geo(impressions(spark, SF_SMALL))
    mx = imp.agg(F.max("timestamp")).first()[0] - 15 * 86_400_000
    want = agg.window_aggregate(imp, COARSE, bid_type=EXACT_BID_TYPE).where(F.expr(
        f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', window_end) <= {mx}"))
    got = spark.read.parquet(sink).drop("batch_id")
    assert rows(got, *COLS) == rows(want, *COLS)
