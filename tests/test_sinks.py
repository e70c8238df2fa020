import datetime as dt

from adpulse.session import work_dir
from adpulse.sources.sinks import (batch_writer, decode_dates, encode_dates, stored_count,
                                   write_results)
from helpers import rows


def _results(spark, day, n):
    start = dt.datetime(2024, 1, day)
    return spark.createDataFrame(
        [(start, start + dt.timedelta(hours=1), f"publisher_{i}", "NY", start) for i in range(n)],
        "window_start timestamp_ntz, window_end timestamp_ntz, publisher string, geo string, "
        "date timestamp_ntz")


def test_rerun_replaces_only_its_dates(spark):
    path = work_dir(spark, "t-sink") + "/results"
    assert write_results(_results(spark, 1, 3), path) == 3
    assert write_results(_results(spark, 2, 2), path) == 2
    assert write_results(_results(spark, 1, 4), path) == 4  # rerun of day 1 with new content
    got = rows(spark.read.parquet(path).groupBy("window_date").count())
    assert got == [(dt.date(2024, 1, 1), 4), (dt.date(2024, 1, 2), 2)]
    assert stored_count(spark, path).first()["stored_rows"] == 6


def test_batch_writer_replay_and_counter(spark):
    folder = work_dir(spark, "t-batch")
    write = batch_writer(f"{folder}/sink", counts_path=f"{folder}/counts")
    write(_results(spark, 1, 3), 0)
    write(_results(spark, 2, 5), 1)
    write(_results(spark, 2, 5), 1)  # batch 1 replayed after a failure
    assert spark.read.parquet(f"{folder}/sink").count() == 8
    assert rows(spark.read.parquet(f"{folder}/counts")) == [(3, 0), (5, 1)]


def test_date_codec_roundtrip(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:09:58.778' AS date")
    enc = encode_dates(df)
    assert enc.first()["date"] == 1704067798778
    assert decode_dates(enc).first()["date"] == dt.datetime(2024, 1, 1, 0, 9, 58, 778000)
