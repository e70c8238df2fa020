import re
from collections import Counter, defaultdict

import pytest

from adpulse.llm import mixing


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def targets(sizes):
    """Excess shared again by weight until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    return out


def test_targets_and_budgets(odd):
    rows = mixing.mix_sources(odd).collect()
    sizes = defaultdict(int)
    for r in rows:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
    want = targets(dict(sizes))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_same_mix_however_partitioned(odd):
    def mix(n):
        return Counter((r.doc_id, r.text, r.taken) for r in mixing.mix_sources(odd.repartition(n)).collect())
    assert mix(1) == mix(7)


def near_budgets(rows, out):
    """Whole documents only, and each source within half a document of its words."""
    assert Counter((r.doc_id, r.text) for r in out).keys() <= {(r.doc_id, r.text) for r in rows}
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        got = sum(len(words(r.text)) for r in out if r.source == source)
        assert abs(got - sum(r.taken for r in own)) <= max(r["size"] for r in own) / 2


def test_documents_of_the_mix(odd):
    rows = mixing.mix_sources(odd).collect()
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    got = out.collect()
    near_budgets(rows, got)
    assert sum(not words(r.text) for r in got) == sum(r["size"] == 0 for r in rows)
    assert {r["size"] for r in got} == {"in"}  # the input's own column


def test_empty_tables_and_texts(spark, none):
    assert mixing.mix_sources(none).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.taken, r.target) for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0)] * 2


def test_documents_stay_as_they_are(spark):
    text = " one\ttwo\n\n  three   four\nfive "
    rows = [(i, text, s) for s in ("a", "b", "c") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed_documents(df).collect()
    assert {r.text for r in out} == {text}
    near_budgets(mixing.mix_sources(df).collect(), out)
