"""Impression records.

The test tables carry no impressions, so the impression view is derived from
``events`` by the column rules below (same rules in the DuckDB oracle). It is
a pure projection: one scan of five ``events`` columns, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.columns import epoch_millis
from adpulse.functions.constants import (GEOS, IMPRESSION_FIELDS, NUM_ADVERTISERS, NUM_PUBLISHERS,
                                         NUM_WEBSITES, UNKNOWN_GEO)


def impression_columns() -> list[Column]:
    """The seven impression fields as expressions over ``events`` columns."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return [
        epoch_millis("ts").alias("timestamp"),
        F.concat(F.lit("publisher_"), (k % NUM_PUBLISHERS).cast("string")).alias("publisher"),
        F.concat(F.lit("advertiser_"), (F.col("event_id") % NUM_ADVERTISERS).cast("string")).alias("advertiser"),
        F.concat(F.lit("website_"), ((F.col("event_id") * 7919) % NUM_WEBSITES).cast("string"),
                 F.lit(".com")).alias("website"),
        F.element_at(F.array(*[F.lit(g) for g in GEOS]),
                     (F.col("user_id") % len(GEOS) + 1).cast("int")).alias("geo"),
        F.round(F.abs(F.col("value")) % 1, 2).alias("bid"),
        F.concat(F.lit("cookie_"), F.col("user_id").cast("string")).alias("cookie"),
    ]


def impressions_from_events(events: DataFrame, key: bool = False) -> DataFrame:
    """``events`` -> impression rows (timestamp, publisher, advertiser, website, geo, bid, cookie).

    With ``key=True`` the event id is kept as ``key`` (the message key of a topic).
    """
    cols = impression_columns()
    if key:
        cols = [F.col("event_id").cast("string").alias("key")] + cols
    return events.select(*cols)


def known_geo(impressions: DataFrame) -> DataFrame:
    """Drop impressions whose geo could not be resolved (before any shuffle)."""
    return impressions.where(F.col("geo") != F.lit(UNKNOWN_GEO))


__all__ = ["impression_columns", "impressions_from_events", "known_geo", "IMPRESSION_FIELDS"]
