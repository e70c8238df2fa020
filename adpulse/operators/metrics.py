"""Dashboard metrics over finalised window results.

Input rows are finalised results (window_start, window_end, publisher, geo,
imps, uniques, avg_bids, ...): at most one row per (window, publisher, geo),
so every per-window group here is bounded by the key domain, not by the raw
event volume.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.functions.columns import duration_seconds, epoch_seconds, truncated_int
from adpulse.functions.constants import (CHART_CEILING, CHART_GEO_ORDER, CHART_WINDOW_SIZE,
                                         INGEST_REPORT_STEP, TARGET_FILE_LOGS, TARGET_GEO_AVG_BIDS,
                                         TARGET_GEO_IMPS, TARGET_PUB_GEO_COUNT,
                                         TARGET_RAW_COUNT, TARGET_STORED_COUNT)
from adpulse.operators.aggregate import event_time, window_bounds
from adpulse.session import materialize

BLOCK_WINDOWS = 4096  # windows that one task makes at a time
WINDOW_COLS = ("window_start", "window_end")


# -- per-window statistics (the statistics step of each batch) -------------------

def geo_impressions(results: DataFrame, by: Sequence[str] = WINDOW_COLS) -> DataFrame:
    """Impressions per window and geo: the sum of the groups' ``imps``."""
    return results.groupBy(*by, "geo").agg(F.sum("imps").alias("imps"))


def group_count(results: DataFrame, by: Sequence[str] = WINDOW_COLS, fill: str | None = None) -> DataFrame:
    """Number of (publisher, geo) groups per window. With ``fill``, the length
    of the windows, a window between the first and the last that has no group
    counts 0. The counts, one row per window that has a group, are checkpointed
    and read for the bounds and for the join. The span between the
    bounds is cut into blocks, and the windows of a block are made in its task."""
    counts = results.groupBy(*by).agg(F.count(F.lit(1)).alias("pub_geo_count"))
    if fill is None:
        return counts
    counts = materialize(counts.select("window_start", "pub_geo_count"))
    step = F.expr(f"INTERVAL {fill}")
    bounds = counts.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).where("lo IS NOT NULL")
    seconds = duration_seconds(fill)
    n = F.timestamp_diff("SECOND", F.col("lo"), F.col("hi")) / seconds
    blocks = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.floor(n / BLOCK_WINDOWS))).alias("block")).repartition("block")
    first = F.timestamp_add("SECOND", F.col("block") * (BLOCK_WINDOWS * seconds), F.col("lo"))
    last = F.least("hi", F.timestamp_add("SECOND", F.lit((BLOCK_WINDOWS - 1) * seconds), F.col("first")))
    every = blocks.withColumn("first", first).select(F.explode(F.sequence("first", last, step)).alias("window_start"))
    return (every.join(counts, "window_start", "left")
            .select("window_start", (F.col("window_start") + step).alias("window_end"),
                    F.coalesce("pub_geo_count", F.lit(0)).alias("pub_geo_count")))


def geo_bid_share(results: DataFrame, by: Sequence[str] = WINDOW_COLS,
                  digits: int | None = None) -> DataFrame:
    """Per window and geo: ``int(sum(avg_bids of the geo's groups) * 100 / groups in the window)``.

    The denominator is the group count of the whole window, not of the geo, so
    the values are each geo's contribution to the window's mean bid, in percent
    (they add up to about 100 x the mean). ``ts`` stamps the point with the
    window end in epoch seconds.

    Groups are summed per (window, geo) before the first shuffle; the window's
    total then adds up one row per geo. ``digits`` as in ``truncated_int``.
    """
    per_geo = results.groupBy(*by, "geo").agg(
        F.sum("avg_bids").alias("_s"), F.count(F.lit(1)).alias("_c"))
    n = F.sum("_c").over(Window.partitionBy(*by))
    return per_geo.select(*by, epoch_seconds("window_end").alias("ts"), "geo",
                          truncated_int(F.col("_s") * 100 / n, digits).alias("share"))


def geo_bid_share_wide(results: DataFrame, geos: Sequence[str] = CHART_GEO_ORDER,
                       by: Sequence[str] = WINDOW_COLS, digits: int | None = None) -> DataFrame:
    """The bid share as one row per window with a column per geo in chart
    order (0 when a geo has no group). One aggregation, no analytic window
    function, so it also runs on a stream."""
    sums = [F.sum(F.when(F.col("geo") == g, F.col("avg_bids"))).alias(f"_s_{g}") for g in geos]
    agg = results.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *sums)
    if list(by) == ["window"]:  # grouped on the window struct (streams)
        agg = agg.select(*window_bounds(agg), "_n", *[f"_s_{g}" for g in geos])
        by = WINDOW_COLS
    return agg.select(*by, epoch_seconds("window_end").alias("ts"),
                      *[truncated_int(F.coalesce(F.col(f"_s_{g}"), F.lit(0.0)) * 100 / F.col("_n"), digits).alias(g)
                        for g in geos])


# -- reshaping for charts -----------------------------------------------------------

def pivot_fixed(long_df: DataFrame, index: Sequence[str], key: str, value: str,
                keys: Sequence[str] = CHART_GEO_ORDER, fill=0) -> DataFrame:
    """Long (index, key, value) -> one row per index with a column per key in
    the given order; missing keys get ``fill``. Conditional aggregation (what
    ``pivot`` plans to) so it works on streams too."""
    cols = [F.coalesce(F.max(F.when(F.col(key) == k, F.col(value))), F.lit(fill)).alias(k) for k in keys]
    return long_df.groupBy(*index).agg(*cols)


def unpivot_series(wide: DataFrame, index: Sequence[str], keys: Sequence[str] = CHART_GEO_ORDER,
                   label: str = "label", value: str = "y") -> DataFrame:
    """Wide -> one (index, label, value) row per key: the chart series points."""
    return wide.unpivot(list(index), list(keys), label, value)


def row_ceiling(df: DataFrame, value: str, ceiling: int = CHART_CEILING) -> DataFrame:
    """Ignore single values above the ceiling."""
    return df.where(F.col(value) <= F.lit(ceiling))


def point_ceiling(wide: DataFrame, values: Sequence[str] = CHART_GEO_ORDER,
                  ceiling: int = CHART_CEILING) -> DataFrame:
    """Drop a whole time point when any of its values is above the ceiling."""
    return wide.where(F.greatest(*[F.col(v) for v in values]) <= F.lit(ceiling))


def point_ceiling_long(long_df: DataFrame, index: Sequence[str], value: str,
                       ceiling: int = CHART_CEILING) -> DataFrame:
    """Long-form variant: keep the points whose maximum value is within the ceiling."""
    ok = long_df.groupBy(*index).agg(F.max(value).alias("_mx")).where(F.col("_mx") <= ceiling)
    return long_df.join(ok.select(*index), list(index), "left_semi")


# -- running totals and history ------------------------------------------------------

def running_total(df: DataFrame, keys: Sequence[str], order: str, value: str,
                  bucket: Column, out: str = "total") -> DataFrame:
    """Cumulative sum of ``value`` per key in ``order``, without putting a
    key's whole series into one task.

    Rows are cut into ``bucket`` ranges (for example the day of the point):
    1. per (key, bucket) sums - a small table;
    2. per key, the exclusive prefix sum over buckets (few rows per key);
    3. per (key, bucket), the running sum within the bucket plus that offset.
    A task then holds one bucket of one key; the bucket must grow with
    ``order`` (a coarsening of it). Without keys (a single series) step 2 runs
    in one task over one row per bucket, e.g. one row per day of data.

    ``df`` is read twice (rows and offsets); when it is computed from a large
    scan, pass a checkpointed ``df`` (``session.materialize``) so the scan runs
    once.
    """
    # rows are clustered by (key, bucket) once: the bucket sums, the join with
    # the offsets and the within-bucket running sum all reuse that partitioning
    b = df.withColumn("_bucket", bucket).repartition(*keys, "_bucket")
    sums = b.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_bsum"))
    prior = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_bucket",
                          F.coalesce(F.sum("_bsum").over(prior), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (b.join(offsets, [*keys, "_bucket"], "inner")
             .withColumn(out, F.col("_offset") + F.sum(value).over(within))
             .drop("_bucket", "_offset"))


def day_bucket(ts: str) -> Column:
    """Day number of a zone-less timestamp, a bucket for ``running_total``."""
    return F.floor(epoch_seconds(ts) / 86400)


def latest_n(df: DataFrame, keys: Sequence[str], order: str,
             n: int = CHART_WINDOW_SIZE) -> DataFrame:
    """Latest ``n`` points per series. ``row_number() <= n`` is planned with a
    partial WindowGroupLimit before the shuffle, so each map task forwards at
    most ``n`` rows per key."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def counter_text(value) -> Column:
    """Counter display: thousands-separated integer ("12,345")."""
    return F.format_number(F.col(value) if isinstance(value, str) else value, 0)


def gauge_text(value) -> Column:
    """Gauge display: the value with no decimals ("14")."""
    c = F.col(value) if isinstance(value, str) else value
    return F.format_string("%.0f", c.cast("double"))


def gauges(long_df: DataFrame, key: str, order: str, value: str,
           ceiling: int = CHART_CEILING) -> DataFrame:
    """What each gauge shows: its latest value within the ceiling (a value
    above the ceiling is ignored, so the gauge keeps the previous one)."""
    latest = latest_n(row_ceiling(long_df, value, ceiling), [key], order, n=1)
    return latest.select(key, order, value, gauge_text(value).alias("text"))


def sum_by_key(df: DataFrame, key: str = "key", value: str = "count") -> DataFrame:
    """(key, count) list -> total count per key."""
    return df.groupBy(key).agg(F.sum(value).alias(value))


# -- counters -------------------------------------------------------------------------

def messages_per_window(impressions: DataFrame, window: str,
                        time_col: Column | None = None) -> DataFrame:
    """(window_start, window_end, messages) over all impressions."""
    t = time_col if time_col is not None else event_time()
    return (impressions.groupBy(F.window(t, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "messages"))


def ingest_counter(impressions: DataFrame, window: str, step: int = INGEST_REPORT_STEP,
                   time_col: Column | None = None) -> DataFrame:
    """Messages per window, their running total, and what a producer that
    reports once per ``step`` messages has reported (``floor(total/step)*step``);
    the remainder below ``step`` is not reported yet."""
    return ingest_reports(messages_per_window(impressions, window, time_col), step)


def ingest_reports(per_window: DataFrame, step: int = INGEST_REPORT_STEP) -> DataFrame:
    """(window_start, window_end, messages) -> running total and step reports."""
    totals = running_total(per_window, [], "window_start", "messages",
                           day_bucket("window_start"), out="cumulative")
    reported = F.floor(F.col("cumulative") / step) * step
    before = F.floor((F.col("cumulative") - F.col("messages")) / step) * step
    return totals.select(*WINDOW_COLS, "messages", "cumulative",
                         reported.cast("bigint").alias("reported_total"),
                         (reported - before).cast("bigint").alias("reported_increment"))


# -- envelope and routing ---------------------------------------------------------

def window_metrics(results: DataFrame, digits: int | None = None) -> DataFrame:
    """The three per-window dashboard metrics as envelope rows, from two
    aggregations: per (window, geo), then per window (whose lists hold one
    entry per geo). Each window row is exploded into its three targets:

    * pubGeoCount: number of (publisher, geo) groups;
    * geoImpsCounts: [{key, count}] impressions per geo, sorted by key;
    * geoAvgBids: {ts, data: [{key, count}]} bid share per geo (O30).
    """
    per_geo = results.groupBy(*WINDOW_COLS, "geo").agg(
        F.sum("imps").alias("imps"), F.sum("avg_bids").alias("s"), F.count(F.lit(1)).alias("c"))
    per_win = per_geo.groupBy(*WINDOW_COLS).agg(
        F.sum("c").alias("n"),
        F.array_sort(F.collect_list(F.struct(F.col("geo").alias("key"), F.col("imps").alias("count"))))
        .alias("imps_list"),
        F.array_sort(F.collect_list(F.struct(F.col("geo").alias("key"), F.col("s").alias("s"))))
        .alias("share_parts"))
    ts = epoch_seconds("window_end")
    shares = F.transform("share_parts", lambda x: F.struct(
        x["key"].alias("key"), truncated_int(x["s"] * 100 / F.col("n"), digits).alias("count")))
    rows = F.array(
        F.struct(F.lit(TARGET_PUB_GEO_COUNT).alias("target"), F.col("n").cast("string").alias("data")),
        F.struct(F.lit(TARGET_GEO_IMPS).alias("target"), F.to_json("imps_list").alias("data")),
        F.struct(F.lit(TARGET_GEO_AVG_BIDS).alias("target"),
                 F.to_json(F.struct(ts.alias("ts"), shares.alias("data"))).alias("data")))
    return (per_win.select(ts.alias("ts"), F.explode(rows).alias("_r"))
            .select(F.col("_r.target").alias("target"), "ts", F.col("_r.data").alias("data")))


def metric_envelope(results: DataFrame, stored: DataFrame | None = None,
                    ingest: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """All dashboard metrics as (target, ts, data JSON) rows, one sink/topic:
    the per-window metrics of ``window_metrics``, plus

    * mongoCount: rows stored per coarse window (``stored`` = coarse results);
    * rawCount: ingest reports per window (``ingest`` = ``ingest_counter``).
    ``ts`` is the window end in epoch seconds.
    """
    out = window_metrics(results, digits)
    if stored is not None:
        out = out.unionByName(stored_metric(stored))
    if ingest is not None:
        out = out.unionByName(ingest.where(F.col("reported_increment") > 0).select(
            F.lit(TARGET_RAW_COUNT).alias("target"), epoch_seconds("window_end").alias("ts"),
            F.col("reported_increment").cast("string").alias("data")))
    return out


def stored_metric(stored: DataFrame) -> DataFrame:
    """Rows stored per coarse window, as envelope rows."""
    return group_count(stored).select(
        F.lit(TARGET_STORED_COUNT).alias("target"), epoch_seconds("window_end").alias("ts"),
        F.col("pub_geo_count").cast("string").alias("data"))


def report_increment(counter: DataFrame, step: int = INGEST_REPORT_STEP) -> DataFrame:
    """(value, total, ts) of the message counter after a batch -> the envelope
    row of what a producer that reports per ``step`` messages has reported in
    it; none if that is nothing."""
    reported = F.floor(F.col("total") / step) * step - F.floor((F.col("total") - F.col("value")) / step) * step
    return counter.where(reported > 0).select(
        F.lit(TARGET_RAW_COUNT).alias("target"), "ts", reported.cast("bigint").cast("string").alias("data"))


_PAIRS = "array<struct<key:string,count:bigint>>"
_FILES = "array<struct<id:string,size:bigint,storage:bigint>>"
_POINT = "struct<ts:bigint,data:array<struct<key:string,count:bigint>>>"


def route_by_target(envelope: DataFrame,
                    counters: Iterable[str] = (TARGET_RAW_COUNT, TARGET_PUB_GEO_COUNT,
                                               TARGET_STORED_COUNT)) -> DataFrame:
    """Dispatch envelope rows on ``target`` into one long table
    (target, ts, key, value, handled):

    * counters -> one row, key = target, value = the number;
    * geoImpsCounts -> one row per geo;
    * geoAvgBids -> one row per geo, stamped with the payload's ``ts``;
    * logs -> one row per file, key = its id, value = its storage ratio;
    * a payload that cannot be read, or another target -> one row with
      handled = false (the reject output).
    """
    t = F.col("target")
    # each payload is parsed once: the parsed point passes a one-element explode
    point = F.when(t == TARGET_GEO_AVG_BIDS, F.from_json("data", _POINT))
    parsed = envelope.select("target", "ts", "data", F.explode(F.array(point)).alias("_pt"))
    number = F.col("data").try_cast("bigint")
    one = F.when(number.isNotNull(), F.array(F.struct(t.alias("key"), number.alias("count"))))
    files = F.transform(F.from_json("data", _FILES), lambda x: F.struct(
        x["id"].cast("string").alias("key"), F.floor(F.try_divide(x["storage"] * 100, x["size"])).alias("count")))
    pairs = (F.when(t.isin(*counters), one)
             .when(t == TARGET_GEO_IMPS, F.from_json("data", _PAIRS))
             .when(t == TARGET_GEO_AVG_BIDS, F.col("_pt.data"))
             .when(t == TARGET_FILE_LOGS, files))
    stamp = F.when(t == TARGET_GEO_AVG_BIDS, F.col("_pt.ts")).otherwise(F.col("ts"))
    return (parsed.select("target", stamp.alias("ts"), pairs.alias("_pairs"))
            .select("target", "ts", F.col("_pairs").isNotNull().alias("handled"), F.explode_outer("_pairs").alias("_p"))
            .select("target", "ts", F.col("_p.key").alias("key"),
                    F.col("_p.count").alias("value"), "handled"))


def envelope_messages(envelope: DataFrame) -> DataFrame:
    """Each envelope row as one JSON message, ``{"data": ..., "target": ...}``
    with the payload itself, not its text, in ``data``."""
    return envelope.select("target", "ts", F.concat(
        F.lit('{"data":'), F.col("data"), F.lit(',"target":'),
        F.to_json(F.array("target")).substr(F.lit(2), F.length(F.to_json(F.array("target"))) - 2), F.lit("}")).alias("value"))


def storage_ratio(files: DataFrame) -> DataFrame:
    """File metadata rows with ``ratio = storage * 100 / size``, newest first."""
    return (files.withColumn("ratio", F.try_divide(F.col("storage") * 100, F.col("size")))
            .orderBy(F.col("id").desc()))
