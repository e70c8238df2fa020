import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from adpulse.operators import metrics as met
from helpers import rows

W0 = dt.datetime(2024, 1, 1, 0)
W1 = dt.datetime(2024, 1, 1, 1)
W2 = dt.datetime(2024, 1, 1, 2)


def _results(spark, data):
    return spark.createDataFrame(
        [(s, e, p, g, i, a) for s, e, p, g, i, a in data],
        "window_start timestamp_ntz, window_end timestamp_ntz, publisher string, geo string, "
        "imps bigint, avg_bids double")


def test_bid_share_uses_whole_window_group_count(spark):
    # 4 groups in the window: NY has two (0.5 + 0.3), CA one (0.2), FL one (0.9)
    res = _results(spark, [(W0, W1, "p0", "NY", 3, 0.5), (W0, W1, "p1", "NY", 1, 0.3),
                           (W0, W1, "p0", "CA", 2, 0.2), (W0, W1, "p0", "FL", 5, 0.9)])
    got = {r["geo"]: r["share"] for r in met.geo_bid_share(res).collect()}
    assert got == {"NY": 20, "CA": 5, "FL": 22}  # int((0.8)*100/4), int(0.2*100/4), int(0.9*100/4)
    wide = met.geo_bid_share_wide(res).first()
    assert (wide["CO"], wide["CA"], wide["FL"], wide["HI"], wide["NY"]) == (0, 5, 22, 0, 20)
    assert wide["ts"] == int(W1.replace(tzinfo=dt.timezone.utc).timestamp())


def test_geo_impressions_and_group_count(spark):
    res = _results(spark, [(W0, W1, "p0", "NY", 3, 0.5), (W0, W1, "p1", "NY", 1, 0.3),
                           (W1, W2, "p0", "CA", 2, 0.2)])
    assert rows(met.geo_impressions(res), "window_start", "geo", "imps") == [(W0, "NY", 4), (W1, "CA", 2)]
    assert rows(met.group_count(res), "window_start", "pub_geo_count") == [(W0, 2), (W1, 1)]


def test_pivot_fixed_order_and_unpivot(spark):
    long_df = spark.createDataFrame([(1, "NY", 7), (1, "CO", 3), (2, "HI", 1)],
                                    "ts int, geo string, v int")
    wide = met.pivot_fixed(long_df, ["ts"], "geo", "v")
    assert wide.columns == ["ts", "CO", "CA", "FL", "HI", "NY"]
    assert rows(wide) == [(1, 3, 0, 0, 0, 7), (2, 0, 0, 0, 1, 0)]
    back = met.unpivot_series(wide, ["ts"])
    assert back.count() == 10 and rows(back.where("y > 0")) == [(1, "CO", 3), (1, "NY", 7), (2, "HI", 1)]


def test_ceilings(spark):
    long_df = spark.createDataFrame([(1, "NY", 41), (1, "CA", 3), (2, "NY", 40)],
                                    "ts int, geo string, v int")
    assert rows(met.row_ceiling(long_df, "v"), "ts", "geo") == [(1, "CA"), (2, "NY")]
    assert rows(met.point_ceiling_long(long_df, ["ts"], "v"), "ts", "geo") == [(2, "NY")]
    wide = met.pivot_fixed(long_df, ["ts"], "geo", "v")
    assert rows(met.point_ceiling(wide), "ts") == [(2,)]
    assert rows(met.row_ceiling(long_df, "v", ceiling=3), "ts") == [(1,)]


def test_running_total_equals_plain_window(spark):
    df = spark.range(0, 500).select(
        (F.col("id") % 3).cast("string").alias("key"),
        F.timestamp_add("HOUR", F.col("id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("t"),
        (F.col("id") * 7 % 11).alias("v"))
    got = met.running_total(df, ["key"], "t", "v", met.day_bucket("t"))
    w = Window.partitionBy("key").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("total", F.sum("v").over(w))
    assert rows(got, "key", "t", "v", "total") == rows(want, "key", "t", "v", "total")


def test_latest_n_uses_partial_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 5).alias("label"), F.col("id").alias("ts"))
    out = met.latest_n(df, ["label"], "ts", n=30)
    assert out.count() == 150
    assert rows(out.groupBy("label").agg(F.min("ts"))) == [(k, 1000 - 150 + k) for k in range(5)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_route_by_target_reports_unhandled(spark):
    env = spark.createDataFrame(
        [("rawCount", 10, "100"), ("geoImpsCounts", 10, '[{"key":"FL","count":3},{"key":"CO","count":8}]'),
         ("geoAvgBids", 10, '{"ts":12,"data":[{"key":"FL","count":9}]}'), ("logs", 10, '[{"id":1,"size":200,"storage":50}]'),
         ("rawCount", 11, "many"), ("geoImpsCounts", 11, "["), ("else", 11, "1")],
        "target string, ts bigint, data string")
    out = met.route_by_target(env)
    assert rows(out.where("not handled"), "target", "ts") == [("else", 11), ("geoImpsCounts", 11), ("rawCount", 11)]
    got = rows(out.where("handled"), "target", "ts", "key", "value", "handled")
    assert got == [("geoAvgBids", 12, "FL", 9, True), ("geoImpsCounts", 10, "CO", 8, True),
                   ("geoImpsCounts", 10, "FL", 3, True), ("logs", 10, "1", 25, True),
                   ("rawCount", 10, "rawCount", 100, True)]


def test_ingest_counter_reports_in_steps(spark):
    t = F.timestamp_add("MINUTE", F.col("id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    imp = spark.range(0, 250).select(F.lit(0).alias("timestamp"), t.alias("et"))
    out = rows(met.ingest_counter(imp, "1 hour", time_col=F.col("et")),
               "messages", "cumulative", "reported_total", "reported_increment")
    # 60 per hour; the last 10 are below the step and never reported
    assert out == [(10, 250, 200, 0), (60, 60, 0, 0), (60, 120, 100, 100), (60, 180, 100, 0),
                   (60, 240, 200, 100)]


def test_storage_ratio(spark):
    files = spark.createDataFrame([(1, 200, 100), (2, 0, 5)], "id int, size bigint, storage bigint")
    out = met.storage_ratio(files).collect()
    assert [r["id"] for r in out] == [2, 1]  # newest first
    assert out[1]["ratio"] == 50.0 and out[0]["ratio"] is None


def test_gauge_keeps_last_value_within_ceiling(spark):
    df = spark.createDataFrame([("NY", 1, 12), ("NY", 2, 41), ("CA", 1, 7), ("CA", 2, 9)],
                               "geo string, t int, imps bigint")
    got = rows(met.gauges(df, "geo", "t", "imps"), "geo", "t", "imps", "text")
    assert got == [("CA", 2, 9, "9"), ("NY", 1, 12, "12")]  # NY's 41 is ignored


def test_display_formats(spark):
    df = spark.createDataFrame([(1234567,), (0,), (999,)], "v bigint")
    got = sorted(r[0] for r in df.select(met.counter_text("v")).collect())
    assert got == ["0", "1,234,567", "999"]
    assert df.select(met.gauge_text("v")).first()[0] == "1234567"


def test_empty_windows_count_zero(spark):
    t = "TIMESTAMP_NTZ'2024-01-01 0{}:00:00'"
    df = spark.createDataFrame([(1, "a"), (1, "b"), (4, "a")], "h int, geo string").select(
        F.timestamp_add("HOUR", "h", F.expr(t.format(0))).alias("window_start"), F.timestamp_add("HOUR", F.col("h") + 1, F.expr(t.format(0))).alias("window_end"))
    out = met.group_count(df, fill="1 hour").orderBy("window_start").collect()
    assert [r.pub_geo_count for r in out] == [2, 0, 0, 1]


def test_envelope_message_holds_the_payload(spark):
    import json
    env = spark.createDataFrame([("geoImpsCounts", 1, '[{"key":"FL","count":3}]'), ("rawCount", 2, "100")], "target string, ts bigint, data string")
    got = [json.loads(r.value) for r in met.envelope_messages(env).collect()]
    assert got == [{"data": [{"key": "FL", "count": 3}], "target": "geoImpsCounts"}, {"data": 100, "target": "rawCount"}]
