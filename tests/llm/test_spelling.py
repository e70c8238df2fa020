import random
import re
import zlib
from collections import Counter

import pytest

from adpulse.llm import queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def plain_words(docs):
    out = []
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out += [run] * (len(run) >= 6)
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, least=5, ratio=5):
    n = {w: c for w, c in Counter(words).items() if c >= least}
    out, form = {}, {}
    for w in n:
        near = [v for v in n if abs(len(v) - len(w)) < 2 and v != w and one_edit(v, w)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(near)
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], out[w], n[form[w]] if form[w] is not None else None))
    return rows


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def many_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.unset(name)


def test_registered_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(queries.op11_spelling(spark, SF)) == brute(plain_words(docs))


def small_words(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(3, 8))) for _ in range(60)]
    return [rng.choice(base) for _ in range(2000)] + ["", "", "", "", "", "a", "b"] * 2 + ["aaaaaa"] * 400 + ["aaaaa"] * 70 + ["aaaa"] * 10 + ["baaa"] * 2


@pytest.mark.parametrize("seed", range(3))
def test_dense_neighbours_over_many_partitions(many_partitions, seed):
    """Runs of one letter, chains of forms, ties, the empty word, hot words."""
    words = small_words(seed)
    df = many_partitions.createDataFrame([(w, 1) for w in words] + [(None, 1)] * 9, "word string, n int").repartition(5)
    assert found(spelling.variants(df, least=2, ratio=2)) == brute(words, 2, 2)
    assert found(spelling.variants(df)) == brute(words)


def test_trie_numbers(many_partitions):
    """Equal prefixes have one number, over partition borders as well."""
    words = sorted(set(small_words(9)) | {"x" * 100 + c for c in "abc"} | {"x" * 63 + "y", "x" * 64 + "y"})
    got = spelling.numbered(many_partitions.createDataFrame([(w,) for w in words], "word string").repartition(6), "word", "rank", "nodes").collect()
    assert [r.word for r in sorted(got, key=lambda r: r.rank)] == words and {r.rank for r in got} == set(range(len(words)))
    number = {}
    for r in got:
        assert len(r.nodes) == len(r.word) + 1
        for i, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:i], node) == node
    assert len(set(number.values())) == len(number)


def test_border_names():
    names = spelling.border_names([(3, "aa", "ab"), (2, "abc", "abcd"), (4, "abce", "b"), (1, "c", "c")])
    assert [x[0] for x in names] == [0, 3, 5, 9]
    assert [len(x[1]) for x in names] == [1, 3, 4, 1] and [x[2] for x in names] == ["ab", "abc", "", ""]
    assert names[1][3][:3] == names[1][1] and names[2][1] == names[1][3]


def test_very_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "EMIT", 1000)
    long = "x" * 300_000
    words = [long] * 50 + [long + "x"] * 5 + [long[:-1] + "y"] * 6 + ["y" + long] * 7
    got = found(spelling.variants(spark.createDataFrame([(w,) for w in words], "word string")))
    near = {long: 3, long + "x": 2, long[:-1] + "y": 1, "y" + long: 2}
    assert {(w, n) for w, _, _, _, n, _ in got} == set(near.items()) and {f for w, f, *_ in got if w != long} == {long}


def test_odd_rows(odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    words = plain_words(docs)
    assert Counter(r.word for r in spelling.damaged_words(odd).collect()) == Counter(words)
    assert found(spelling.variants(spelling.damaged_words(odd))) == brute(words)
    empty = spelling.variants(spelling.damaged_words(none))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
