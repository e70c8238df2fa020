"""What the dashboard keeps while a stream runs, as keyed state: counters and
gauges (one value a key), the history of a series (a bounded list), and the
points of windows without events (timers).

Each takes rows of closed windows (append mode, in any order within a batch)
and keeps a few numbers per series; the work on messages is done before, by
windowed aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adpulse.functions.columns import duration_seconds
from adpulse.functions.constants import CHART_CEILING, CHART_HISTORY, CHART_WINDOW_SIZE
from adpulse.session import ship

POINT = "at bigint, value bigint"


class Counter(StatefulProcessor):
    """Running total of a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added, last = 0, None
        for row in rows:
            added, last = added + row["value"], row["at"] if last is None else max(last, row["at"])
        total = added + (self.total.get()[0] if self.total.exists() else 0)
        self.total.update((total,))
        yield Row(key=key[0], at=last, value=added, total=total)

    def close(self) -> None:
        pass


class Gauge(StatefulProcessor):
    """Last value of a key that is within the ceiling."""

    def __init__(self, ceiling: int):
        self.ceiling = ceiling

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shown = handle.getValueState("shown", POINT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        shown = tuple(self.shown.get()) if self.shown.exists() else None
        points = [(row["at"], row["value"]) for row in rows if row["value"] <= self.ceiling]
        points += [shown] if shown else []
        if points:
            last = max(points)
            self.shown.update(last)
            yield Row(key=key[0], at=last[0], value=last[1])

    def close(self) -> None:
        pass


class History(StatefulProcessor):
    """The last ``kept`` points of a series by time; shows the last ``shown``."""

    def __init__(self, kept: int, shown: int):
        self.kept, self.shown = kept, shown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", POINT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        points = [tuple(p) for p in self.points.get()] if self.points.exists() else []
        points = sorted(points + [(row["at"], row["value"]) for row in rows])[-self.kept:]
        self.points.put(points)
        yield Row(key=key[0], at=points[-1][0], points=[Row(at=a, value=v) for a, v in points[-self.shown:]])

    def close(self) -> None:
        pass


class Filler(StatefulProcessor):
    """A point for every window from the first one on: its value, or 0 when the
    watermark passes its end without one. Values wait until then, so points
    come in order; the timer stands at the end of the next window."""

    def __init__(self, step: int):
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at bigint", "value bigint")
        self.due = handle.getValueState("due", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        for row in rows:
            self.waiting.updateValue((row["at"],), (row["value"],))
            first = row["at"] if first is None else min(first, row["at"])
        if not self.due.exists() and first is not None:
            self.due.update((first,))
            self.handle.registerTimer((first + self.step) * 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, at = timerValues.getCurrentWatermarkInMs(), self.due.get()[0]
        while (at + self.step) * 1000 <= now:
            value = 0
            if self.waiting.containsKey((at,)):
                value = self.waiting.getValue((at,))[0]
                self.waiting.removeKey((at,))
            yield Row(key=key[0], at=at, value=value)
            at += self.step
        self.due.update((at,))
        self.handle.registerTimer((at + self.step) * 1000)

    def close(self) -> None:
        pass


def _keyed(points: DataFrame):
    ship(points.sparkSession)
    return points.groupBy("key")


def counters(points: DataFrame) -> DataFrame:
    """(key, at, value) -> (key, at, value, total): per batch and key what it
    added and the running total."""
    return _keyed(points).transformWithState(Counter(), "key string, at bigint, value bigint, total bigint", "append", "none")


def gauges(points: DataFrame, ceiling: int = CHART_CEILING) -> DataFrame:
    """(key, at, value) -> what each gauge shows after a batch that has points
    of it: the latest value within the ceiling."""
    return _keyed(points).transformWithState(Gauge(ceiling), f"key string, {POINT}", "append", "none")


def histories(points: DataFrame, kept: int = CHART_HISTORY, shown: int = CHART_WINDOW_SIZE) -> DataFrame:
    """(key, at, value) -> (key, at, points): after a batch, the latest
    ``shown`` of the ``kept`` points that a series holds."""
    return _keyed(points).transformWithState(
        History(kept, shown), f"key string, at bigint, points array<struct<{POINT.replace('at b', 'at:b').replace('value b', 'value:b')}>>", "append", "none")


def filled(points: DataFrame, window: str) -> DataFrame:
    """(key, at, value) with a watermark -> the same for every window of a
    series from its first, 0 where there is none; ``at`` is the window's start
    in epoch seconds. A window is published when the watermark has passed it."""
    return _keyed(points).transformWithState(Filler(duration_seconds(window)), f"key string, {POINT}", "append", "eventtime")
