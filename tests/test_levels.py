"""The levelled store and the job on it: flat reads, retries, compaction,
clean-up, atomic batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adpulse.functions.constants import EXACT_BID_TYPE
from adpulse.operators import aggregate as agg
from adpulse.plans.catalog import COARSE, FINE, impressions
from adpulse.session import work_dir
from adpulse.sources import codec
from adpulse.sources.impressions import known_geo
from adpulse.streaming import jobs
from adpulse.streaming.levels import Levels, Manifest, Segment, Table
from adpulse.streaming.sources import message_stream
from helpers import SF_SMALL, rows

ONCE = {"availableNow": True}


def add_up(df):
    return df.groupBy("at", "key").agg(F.sum("n").alias("n"), F.min("v").alias("v"))


def table(spark, root, **options):
    return Levels(spark, root, [Table("t", lambda: F.col("at"), add_up)], **options)


def put(levels, spark, batch, values, run="r"):
    m = levels.begin(run, batch)
    df = spark.createDataFrame([(a, k, 1, m.v) for a, k in values], "at bigint, key string, n bigint, v bigint").coalesce(1)
    levels.write(m, "t", df)
    levels.commit(m)
    return m


def test_segments_merge_and_old_ones_go(spark):
    root = work_dir(spark, "t-levels")
    levels = table(spark, root, fanout=3)
    for batch in range(13):
        put(levels, spark, batch, [(batch, "a"), (batch, "b"), (0, "hot")])
    last = levels.latest()
    assert sorted(s.level for s in last.segments) == [0, 1, 2] and last.v == 12
    got = {(r["at"], r["key"]): (r["n"], r["v"]) for r in levels.read("t").collect()}
    assert got[(0, "hot")] == (13, 0) and got[(7, "b")] == (1, 7) and len(got) == 27
    assert levels.vacuum(kept=1) > 0 and levels.folder.names("manifest") == ["000000000012.json"]
    assert {(r["at"], r["key"]): (r["n"], r["v"]) for r in levels.read("t").collect()} == got
    live = {s.path for s in last.segments}
    assert {f"t/{v}/{x}" for v in levels.folder.names("t") for x in levels.folder.names(f"t/{v}")} == live


def test_a_repeated_batch_leaves_one_copy(spark):
    levels = table(spark, work_dir(spark, "t-again"))
    for batch in (0, 1, 1, 1, 2, 2):
        put(levels, spark, batch, [(batch, "a")])
    assert rows(levels.read("t"), "at", "n") == [(0, 1), (1, 1), (2, 1)] and levels.latest().v == 2
    # what a batch wrote before it failed is not seen, and is replaced when it comes again
    m = levels.begin("r", 3)
    levels.write(m, "t", spark.createDataFrame([(3, "lost", 1, m.v)], "at bigint, key string, n bigint, v bigint"))
    assert levels.read("t").count() == 3
    put(levels, spark, 3, [(3, "a")])
    assert rows(levels.read("t"), "at", "key")[-1] == (3, "a")
    # another run goes on behind it
    put(levels, spark, 0, [(9, "z")], run="other")
    assert levels.latest().v == 4 and levels.read("t").count() == 5


def test_large_segments_are_final_and_ranges_prune(spark):
    levels = table(spark, work_dir(spark, "t-final"), fanout=2, segment_bytes=1)
    for batch in range(5):
        put(levels, spark, batch, [(10 * batch, "a"), (10 * batch + 5, "a")])
    last = levels.latest()
    assert [s.level for s in last.segments] == [0] * 5 and last.compacted == 0
    assert [s.low for s in levels.segments(last, "t", [(11, 19), (34, 36)])] == [10, 30]
    assert levels.segments(last, "t", [(6, 9)]) == []


def test_manifest_text_and_empty_tables(spark):
    m = Manifest(3, "r", 1, [Segment("t", "p", 0, 1, 2, 3, 4, "r")], {"rawCount": 7})
    assert Manifest.of(m.text()) == m
    levels = table(spark, work_dir(spark, "t-none"))
    assert levels.latest() == Manifest()
    with pytest.raises(ValueError, match="no rows yet"):
        levels.read("t")
    m = levels.begin("r", 0)
    levels.write(m, "t", spark.createDataFrame([], "at bigint, key string, n bigint, v bigint"))
    levels.commit(m)
    assert levels.latest().segments == [] and levels.latest().v == 0


def live_messages(spark, start, count):
    """``count`` messages a second from ``start`` on, ten seconds of them."""
    imp = [(1_700_000_000_000 + 1000 * (start + k // count), f"publisher_{k % 3}", "a", "w", ["NY", "CA", "unknown"][k % 3], 0.25, f"c{k % 7}") for k in range(10 * count)]
    schema = "timestamp bigint, publisher string, advertiser string, website string, geo string, bid double, cookie string"
    return codec.encode_messages(spark.createDataFrame(imp, schema).coalesce(1))


def test_a_batch_reads_what_it_touches(spark):
    """Batch after batch of a live topic: bytes read and live segments stay flat."""
    folder = work_dir(spark, "t-flat")
    n = 10
    for k in range(n):
        live_messages(spark, 10 * k, 6).write.mode("append").text(f"{folder}/in")
    source = message_stream(spark, "text", f"{folder}/in", batch_limit=1)
    query = jobs.start_impression_job(spark, source, f"{folder}/job", "1 second", "10 seconds", trigger=ONCE, time_mode="event", bid_type=EXACT_BID_TYPE, levels={"fanout": 3})
    query.awaitTermination()
    levels = jobs.job_levels(spark, f"{folder}/job")
    manifests = [Manifest.of(levels.folder.read(f"manifest/{name}")) for name in levels.folder.names("manifest")]
    assert manifests[-1].v == n - 1
    reads = [m.read for m in manifests]
    assert max(reads[-4:]) <= 1.5 * max(reads[:4])
    for name in levels.tables:
        assert max(sum(s.table == name for s in m.segments) for m in manifests) <= 3 * 3
    assert jobs.read_store(spark, f"{folder}/job").agg(F.sum("imps")).first()[0] == n * 10 * 6 * 2 // 3


def test_late_message_touches_its_windows_alone(spark):
    folder = work_dir(spark, "t-touch")
    msgs = codec.encode_messages(impressions(spark, SF_SMALL), keep=("timestamp",))
    cut = 1 + msgs.agg(F.max("timestamp")).first()[0] - 5 * 86_400_000
    msgs.where(F.col("timestamp") < cut).select("value").coalesce(1).write.mode("append").text(f"{folder}/in")
    msgs.where(F.col("timestamp") >= cut).select("value").coalesce(1).write.mode("append").text(f"{folder}/in")
    one = msgs.orderBy("timestamp").select("value").first().value.replace('"cookie":"', '"cookie":"again_')
    spark.createDataFrame([(one,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/in")
    source = message_stream(spark, "text", f"{folder}/in", batch_limit=1)
    jobs.start_impression_job(spark, source, f"{folder}/job", FINE, COARSE, trigger=ONCE, time_mode="event", bid_type=EXACT_BID_TYPE).awaitTermination()
    levels = jobs.job_levels(spark, f"{folder}/job")
    last = levels.latest()
    assert last.batch == 2
    written = [s for s in last.segments if s.path.startswith(f"store/v={last.v}/")]
    window = dt.datetime.fromtimestamp(written[0].low, dt.UTC).replace(tzinfo=None)
    assert written[0].low == written[0].high
    before = agg.fine_partials(known_geo(impressions(spark, SF_SMALL)), FINE, bid_type=EXACT_BID_TYPE)
    coarse = agg.finalise(agg.merge_partials(before, COARSE, fine_window=FINE))
    other = F.col("window_start") != F.lit(window)
    assert rows(jobs.read_store(spark, f"{folder}/job").where(other)) == rows(coarse.where(other))
    known = '"geo":"unknown"' not in one
    assert jobs.read_store(spark, f"{folder}/job").agg(F.sum("imps")).first()[0] == coarse.agg(F.sum("imps")).first()[0] + known
