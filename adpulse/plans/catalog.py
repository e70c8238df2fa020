"""Named queries over the driver's tables.

Each query is ``(spark, base_dir) -> DataFrame`` and reads whole tables. The
fine window is 1 hour and the coarse window 10 hours: the reference's 1 s and
10 s windows scaled to the sparse ``events`` table, same 1:10 ratio.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.columns import epoch_millis, ntz_from_millis
from adpulse.functions.constants import (EXACT_BID_TYPE, EXACT_SHARE_DIGITS, TARGET_PUB_GEO_COUNT, TARGET_RAW_COUNT,
                                         TARGET_STORED_COUNT, TEST_COARSE_WINDOW,
                                         TEST_FINE_WINDOW)
from adpulse.operators import aggregate as agg
from adpulse.operators import metrics as met
from adpulse.sources import codec
from adpulse.session import materialize, work_dir
from adpulse.sources.documents import read_documents, write_documents
from adpulse.sources.impressions import impression_columns, impressions_from_events, known_geo
from adpulse.sources.sinks import (decode_dates, encode_dates, stored_count, write_partials,
                                   write_results)
from adpulse.sources.tables import read_table

FINE = TEST_FINE_WINDOW
COARSE = TEST_COARSE_WINDOW
SLIDE = TEST_FINE_WINDOW
GAP_WINDOW = "10 minutes"  # short enough to leave windows without events
DIGITS = EXACT_SHARE_DIGITS

Query = Callable[[SparkSession, str], DataFrame]


# -- shared building blocks -----------------------------------------------------------

def impressions(spark: SparkSession, base: str, key: bool = False) -> DataFrame:
    """Impressions of the whole ``events`` table."""
    return impressions_from_events(read_table(spark, base, "events"), key=key)


def fine_partials(spark: SparkSession, base: str) -> DataFrame:
    """Bids of ``events`` have two decimals: their sums are exact."""
    return agg.fine_partials(known_geo(impressions(spark, base)), FINE, bid_type=EXACT_BID_TYPE)


def fine_results(spark: SparkSession, base: str) -> DataFrame:
    return agg.finalise(fine_partials(spark, base))


def coarse_results(spark: SparkSession, base: str) -> DataFrame:
    return agg.finalise(agg.merge_partials(fine_partials(spark, base), COARSE, fine_window=FINE))


# -- ingest ---------------------------------------------------------------------------

def q_decode_encode_roundtrip(spark, base):
    """Records -> JSON messages -> strict decode: all seven typed fields back."""
    msgs = codec.encode_messages(impressions(spark, base))
    return codec.decode_strict(msgs)


def damaged_messages(spark, base) -> DataFrame:
    """Messages of ``error`` events are sent damaged, in one of ten ways picked
    by event id: not JSON, two fields missing, or one field of another JSON
    type. All other messages are well formed. One scan, no join."""
    ev = read_table(spark, base, "events")
    imp = ev.select(F.col("event_id").cast("string").alias("key"), "event_type", "event_id",
                    *impression_columns())
    f = codec.IMPRESSION_FIELDS
    good = F.to_json(F.struct(*[F.col(x) for x in f]))
    no_bid_cookie = F.to_json(F.struct(*[F.col(x) for x in f if x not in ("bid", "cookie")]))
    odd = [("timestamp", F.col("timestamp").cast("string")), ("bid", F.col("bid").cast("string")),
           ("publisher", F.lit(5)), ("cookie", F.struct(F.lit("y").alias("x"))), ("geo", F.array("geo")),
           ("website", F.lit(True)), ("bid", F.lit("NaN")), ("bid", F.lit("Infinity"))]
    kind = F.col("event_id") % (len(odd) + 2)
    value = (F.when(F.col("event_type") != "error", good)
             .when(kind == 0, F.concat(F.lit("not json "), F.col("key")))
             .when(kind == 1, no_bid_cookie))
    for k, (name, other) in enumerate(odd):
        value = value.when(kind == k + 2, F.to_json(F.struct(*[other.alias(x) if x == name else F.col(x) for x in f])))
    return imp.select("key", value.alias("value"))


def q_decode_rejects(spark, base):
    """Permissive decode: the reject side output with its reason."""
    decoded = codec.decode_permissive(damaged_messages(spark, base), keep=("key",))
    return codec.rejects(decoded).select("key", "reject_reason")


def q_decode_accepted(spark, base):
    """Permissive decode: the accepted rows (all well-formed messages)."""
    decoded = codec.decode_permissive(damaged_messages(spark, base), keep=("key",))
    return codec.accepted(decoded)


def q_known_geo(spark, base):
    return known_geo(impressions(spark, base))


# -- window aggregates ------------------------------------------------------------

def q_fine_window_agg(spark, base):
    """Flagship: per (publisher, geo, 1-hour window) impressions, distinct
    cookies, average bid and earliest impression."""
    return fine_results(spark, base)


def q_coarse_from_fine(spark, base):
    """10-hour windows merged from the 1-hour partials (sketches unioned)."""
    return coarse_results(spark, base)


def q_sliding_window_agg(spark, base):
    """10-hour windows sliding by 1 hour, merged from the 1-hour partials."""
    return agg.finalise(agg.sliding_from_partials(fine_partials(spark, base), COARSE, SLIDE,
                                                  fine_window=FINE))


def q_uniques_estimate(spark, base):
    return agg.uniques(known_geo(impressions(spark, base)))


def q_uniques_one_shot(spark, base):
    """The one-shot estimate is approximate: beside the exact count, whether
    it lies within three standard errors (and one) of it."""
    known = known_geo(impressions(spark, base))
    # per cookie first: the exact count and the sketch read one (keys, cookie) exchange
    cookies = known.groupBy(*agg.KEYS, "cookie").agg(F.count(F.lit(1)).alias("n"))
    both = cookies.groupBy(*agg.KEYS).agg(F.count("cookie").alias("uniques"),
                                          F.approx_count_distinct("cookie", agg.ONE_SHOT_RSD).alias("estimate"))
    bound = 3 * agg.ONE_SHOT_RSD * F.col("uniques") + 1
    return both.select(*agg.KEYS, "uniques", (F.abs(F.col("estimate") - F.col("uniques")) <= bound).alias("within_bound"))


def q_uniques_exact(spark, base):
    return agg.uniques_exact(known_geo(impressions(spark, base)))


# -- dashboard metrics --------------------------------------------------------------

def q_geo_impressions(spark, base):
    return met.geo_impressions(fine_results(spark, base))


def q_group_count(spark, base):
    return met.group_count(fine_results(spark, base))


def q_geo_bid_share(spark, base):
    return met.geo_bid_share(fine_results(spark, base), digits=DIGITS)


def q_geo_share_wide(spark, base):
    return met.geo_bid_share_wide(fine_results(spark, base), digits=DIGITS)


def q_geo_share_pivot(spark, base):
    """Long bid shares pivoted into the fixed chart order."""
    return met.pivot_fixed(met.geo_bid_share(fine_results(spark, base), digits=DIGITS),
                           ["window_start", "window_end", "ts"], "geo", "share")


def q_geo_share_long(spark, base):
    return met.unpivot_series(met.geo_bid_share_wide(fine_results(spark, base), digits=DIGITS),
                              ["window_start", "window_end", "ts"])


def q_row_ceiling(spark, base):
    return met.row_ceiling(met.geo_impressions(fine_results(spark, base)), "imps")


def q_point_ceiling(spark, base):
    return met.point_ceiling(met.geo_bid_share_wide(fine_results(spark, base), digits=DIGITS))


def metric_series(spark, base) -> DataFrame:
    """Counter metrics as (key, window_end, value): messages per fine window,
    (publisher, geo) groups per fine window, rows stored per coarse window.

    All three come from one count per (publisher, geo, fine window) over all
    impressions; the branches share its exchange, so events are scanned once.
    """
    per_group = (impressions(spark, base)
                 .groupBy("publisher", "geo", F.window(agg.event_time(), FINE).alias("window"))
                 .agg(F.count(F.lit(1)).alias("n")))
    known = per_group.where(F.col("geo") != "unknown")
    raw = per_group.groupBy(F.col("window.end").alias("window_end")).agg(F.sum("n").alias("value"))
    groups = known.groupBy(F.col("window.end").alias("window_end")).agg(F.count(F.lit(1)).alias("value"))
    stored = (known.groupBy("publisher", "geo", F.window(F.window_time("window"), COARSE).alias("c"))
              .agg(F.count(F.lit(1)).alias("_g"))
              .groupBy(F.col("c.end").alias("window_end")).agg(F.count(F.lit(1)).alias("value")))
    return (raw.select(F.lit(TARGET_RAW_COUNT).alias("key"), "window_end", "value")
            .unionByName(groups.select(F.lit(TARGET_PUB_GEO_COUNT).alias("key"), "window_end", "value"))
            .unionByName(stored.select(F.lit(TARGET_STORED_COUNT).alias("key"), "window_end", "value")))


def q_running_totals(spark, base):
    series = materialize(metric_series(spark, base))  # read twice by running_total
    return met.running_total(series, ["key"], "window_end", "value", met.day_bucket("window_end"))


def q_dashboard_counters(spark, base):
    """The three counters as the dashboard shows them after the last window:
    final running total per counter, as thousands-separated text."""
    series = materialize(metric_series(spark, base))
    totals = met.running_total(series, ["key"], "window_end", "value", met.day_bucket("window_end"))
    last = met.latest_n(totals, ["key"], "window_end", n=1)
    return last.select("key", "window_end", "total", met.counter_text("total").alias("text"))


def q_geo_gauges(spark, base):
    """Per geo gauge: latest hourly impressions within the ceiling, as text."""
    return met.gauges(met.geo_impressions(fine_results(spark, base)), "geo", "window_end", "imps")


def q_latest_n(spark, base):
    series = met.unpivot_series(met.geo_bid_share_wide(fine_results(spark, base), digits=DIGITS),
                                ["window_start", "window_end", "ts"])
    return met.latest_n(series, ["label"], "ts")


def q_sum_by_key(spark, base):
    counts = met.geo_impressions(fine_results(spark, base)).select(
        F.col("geo").alias("key"), F.col("imps").alias("count"))
    return met.sum_by_key(counts)


def q_ingest_counter(spark, base):
    # the per-window counts are read twice by the running total: computed once
    per_window = materialize(met.messages_per_window(impressions(spark, base), FINE))
    return met.ingest_reports(per_window)


def q_metric_envelope(spark, base):
    # fine partials over all geos feed all five metrics: events are scanned
    # once, the partials are written once and read back by each branch
    every = agg.fine_partials(impressions(spark, base), FINE, bid_type=EXACT_BID_TYPE)
    every = materialize(every.select("window", *agg.KEYS, "imps", "sum_bids"))
    known = every.where(F.col("geo") != "unknown")
    per_window = (every.groupBy("window").agg(F.sum("imps").alias("messages"))
                  .select(*agg.window_bounds(every), "messages"))
    return met.metric_envelope(agg.averages(known), stored=agg.coarse_groups(known, COARSE),
                               ingest=met.ingest_reports(per_window), digits=DIGITS)


def q_envelope_messages(spark, base):
    """The envelope as it is published: one JSON message a row."""
    return met.envelope_messages(q_metric_envelope(spark, base))


def q_full_precision_bids(spark, base):
    """Average of bids that have all the digits of a double."""
    known = known_geo(impressions(spark, base)).withColumn("bid", F.col("bid") / 7e6)
    return agg.finalise(agg.fine_partials(known, FINE)).select(
        "window_start", "publisher", "geo", F.round(F.col("avg_bids") * 1e6, 9).alias("micro_bids"))


def q_group_count_filled(spark, base):
    """Groups per 10-minute window, 0 for a window without any."""
    results = agg.averages(agg.fine_partials(known_geo(impressions(spark, base)), GAP_WINDOW))
    return met.group_count(results, fill=GAP_WINDOW)


def q_route_by_target(spark, base):
    return met.route_by_target(q_metric_envelope(spark, base))


def q_storage_ratio(spark, base):
    docs = read_table(spark, base, "documents")
    files = docs.select(F.col("doc_id").alias("id"),
                        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file_name"),
                        F.col("n_chars").alias("size"), F.octet_length("text").cast("bigint").alias("storage"),
                        F.col("lang").alias("format"), F.col("source").alias("content_type"))
    return met.storage_ratio(files)


def q_sink_timestamp_codec(spark, base):
    """Stored ``date`` <-> epoch milliseconds, both directions."""
    res = fine_results(spark, base)
    return (res.select("window_start", "publisher", "geo", "date",
                       epoch_millis("date").alias("date_ms"))
            .withColumn("date_back", ntz_from_millis("date_ms")))


def _store_fine_results(spark, base) -> str:
    """Write the fine results to the store (dates as epoch ms, partitioned by
    window date) and return the path."""
    path = work_dir(spark, "store") + "/results"
    write_results(encode_dates(fine_results(spark, base)), path)
    return path


def q_stored_results(spark, base):
    """Rows read back from the store, dates decoded."""
    return decode_dates(spark.read.parquet(_store_fine_results(spark, base)).drop("window_date"))


def q_stored_count(spark, base):
    return stored_count(spark, _store_fine_results(spark, base))


def q_stored_documents(spark, base):
    """Fine results upserted into a document store twice, first with wrong
    counts: the last document of each key is read back."""
    path = work_dir(spark, "documents") + "/store"
    results = encode_dates(fine_results(spark, base)).select(epoch_millis("window_start").alias("window_ms"), *agg.KEYS, "date", "imps", "uniques")
    results = materialize(results)
    write_documents(results.withColumn("imps", F.lit(-1).cast("bigint")), path)
    write_documents(results, path)
    return read_documents(spark, path, ["window_ms", *agg.KEYS], "window_ms bigint, publisher string, geo string, date bigint, imps bigint, uniques bigint")


def q_stored_rollup(spark, base):
    """Daily windows merged from stored hourly partials (sketches unioned):
    the raw events are not read again for the rollup."""
    path = work_dir(spark, "partials") + "/fine"
    write_partials(fine_partials(spark, base), path)
    stored = spark.read.parquet(path).drop("window_date")
    return agg.finalise(agg.merge_partials(stored, "1 day", fine_window=FINE))


QUERIES: dict[str, Query] = {
    "fine_window_agg": q_fine_window_agg,
    "coarse_from_fine": q_coarse_from_fine,
    "sliding_window_agg": q_sliding_window_agg,
    "decode_encode_roundtrip": q_decode_encode_roundtrip,
    "decode_rejects": q_decode_rejects,
    "decode_accepted": q_decode_accepted,
    "known_geo": q_known_geo,
    "uniques_estimate": q_uniques_estimate,
    "uniques_one_shot": q_uniques_one_shot,
    "uniques_exact": q_uniques_exact,
    "geo_impressions": q_geo_impressions,
    "group_count": q_group_count,
    "geo_bid_share": q_geo_bid_share,
    "geo_share_wide": q_geo_share_wide,
    "geo_share_pivot": q_geo_share_pivot,
    "geo_share_long": q_geo_share_long,
    "row_ceiling": q_row_ceiling,
    "point_ceiling": q_point_ceiling,
    "running_totals": q_running_totals,
    "latest_n": q_latest_n,
    "dashboard_counters": q_dashboard_counters,
    "geo_gauges": q_geo_gauges,
    "sum_by_key": q_sum_by_key,
    "ingest_counter": q_ingest_counter,
    "metric_envelope": q_metric_envelope,
    "route_by_target": q_route_by_target,
    "envelope_messages": q_envelope_messages,
    "full_precision_bids": q_full_precision_bids,
    "group_count_filled": q_group_count_filled,
    "storage_ratio": q_storage_ratio,
    "sink_timestamp_codec": q_sink_timestamp_codec,
    "stored_results": q_stored_results,
    "stored_count": q_stored_count,
    "stored_rollup": q_stored_rollup,
    "stored_documents": q_stored_documents,
}

FLAGSHIP = "fine_window_agg"
