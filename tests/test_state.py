"""State of counters, gauges, histories and empty windows, without a stream:
the processors on a handle kept in memory."""

from types import SimpleNamespace

from adpulse.streaming.state import Counter, Filler, Gauge, History


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update


class Mapped(dict):
    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def containsKey(self, key):
        return key in self

    removeKey = dict.pop


class Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, name, schema):
        return Value()

    getListState = getValueState

    def getMapState(self, name, keys, values):
        return Mapped()

    def registerTimer(self, at):
        self.timers.append(at)


def fed(processor, *batches):
    processor.init(Handle())
    return [list(processor.handleInputRows(("k",), iter([{"at": a, "value": v} for a, v in b]), None)) for b in batches]


def test_counter_runs_on():
    out = fed(Counter(), [(1, 2), (3, 4)], [(2, 5)])
    assert [(r.value, r.total, r.at) for (r,) in out] == [(6, 6, 3), (5, 11, 2)]


def test_gauge_keeps_its_last_value_within_the_ceiling():
    out = fed(Gauge(40), [(1, 50)], [(3, 40), (4, 41)], [(2, 7)], [(9, 99)])
    assert out[0] == [] and [(r.at, r.value) for (r,) in out[1:]] == [(3, 40)] * 3


def test_history_is_bounded():
    processor = History(kept=4, shown=2)
    out = fed(processor, [(k, k) for k in range(3)], [(9, 9), (5, 5)], [(4, 4)])
    assert [[p.at for p in r.points] for (r,) in out] == [[1, 2], [5, 9], [5, 9]]
    assert [p[0] for p in processor.points.get()] == [2, 4, 5, 9]


def test_empty_windows_get_zero_when_the_watermark_passes():
    f = Filler(10)
    f.init(Handle())

    def push(*points):
        assert list(f.handleInputRows(("k",), iter([{"at": a, "value": v} for a, v in points]), None)) == []

    def passed(seconds):
        return [(r.at, r.value) for r in f.handleExpiredTimer(("k",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1000 * seconds), None)]

    push((40, 3), (20, 1))
    assert f.handle.timers == [30_000]
    assert passed(35) == [(20, 1)] and f.handle.timers[-1] == 40_000
    push((70, 2))
    assert passed(85) == [(30, 0), (40, 3), (50, 0), (60, 0), (70, 2)] and not f.waiting
