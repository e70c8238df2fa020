"""Scalar column helpers, all built-in expressions (no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

__all__ = [
    "bucket_start", "epoch_millis", "epoch_seconds", "ntz_from_millis", "ltz_from_millis", "ltz_to_ntz",
    "truncated_int", "duration_seconds",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_div(micros: str, unit: int) -> Column:
    # exact integer floor division (``div`` alone truncates toward zero)
    return F.expr(f"({micros} - pmod({micros}, {unit})) div {unit}")


def _micros(ts) -> str:
    return f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {_sql(ts)})"


def epoch_millis(ts) -> Column:
    """Zone-less timestamp -> epoch milliseconds (floored), independent of the session zone."""
    return _floor_div(_micros(ts), 1000)


def epoch_seconds(ts) -> Column:
    """Zone-less timestamp -> epoch seconds (floored)."""
    return _floor_div(_micros(ts), 1000000)


def _epoch_ntz() -> Column:
    return F.expr(_EPOCH_NTZ)


def ntz_from_millis(ms) -> Column:
    """Epoch milliseconds -> zone-less timestamp (the stored ``date`` of a result)."""
    return F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())


def bucket_start(ts: str, seconds: int) -> Column:
    """Start of the bucket of this length, counted from 1970, that a zone-less
    timestamp (a column or a field of one) lies in."""
    at = F.expr(f"timestampdiff(SECOND, {_EPOCH_NTZ}, {ts})")
    return F.timestamp_add("SECOND", at - F.pmod(at, F.lit(seconds)), _epoch_ntz())


def ltz_to_ntz(ts) -> Column:
    """Instant (TIMESTAMP) -> zone-less UTC wall time, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())


def ltz_from_millis(ms) -> Column:
    """Epoch milliseconds -> instant (TIMESTAMP), as needed by ``withWatermark``."""
    return F.timestamp_millis(_col(ms))


def truncated_int(x, digits: int | None = None) -> Column:
    """Truncate a non-negative double to an int; with ``digits``, after
    rounding float noise away at so many decimals."""
    return F.floor(_col(x) if digits is None else F.round(_col(x), digits)).cast("int")


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """'10 hours' -> 36000. Accepts the interval strings ``window()`` accepts."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported duration: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]
