"""adpulse: ad-impression analytics on Spark DataFrames and Structured Streaming.

Layout
------
functions/  fixed domain values and scalar column helpers
sources/    table readers, the impression view over ``events``, JSON codec, sinks
operators/  windowed aggregates over mergeable partials and dashboard metrics
streaming/  file/Kafka stream sources, chained stateful windows, idempotent sinks
plans/      the named queries (Spark side) and their DuckDB oracle SQL
"""

from adpulse.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
