import hashlib
import random
import re

import numpy as np
import pytest

from adpulse.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    """(n_words, n_removed, digest) of each (id, text)."""
    split = [(float("inf") if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((str(i), str(t), *x) for (i, t), x in zip(rows, brute(rows)))
    out = substring.remove_repeats(df).collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_words, r.n_removed, r.kept_sha256) for r in out) == want
    for r in out:
        assert sum(b - a for a, b in r.removed) == r.n_removed


@pytest.mark.parametrize("vocabulary", [2, 4, 300])
def test_random_texts_against_all_windows(spark, vocabulary):
    rng = random.Random(vocabulary)
    base = [str(rng.randrange(vocabulary)) for _ in range(400)]
    rows = []
    for i in range(60):
        a, n = rng.randrange(380), rng.randrange(5, 80)
        text = [str(rng.randrange(vocabulary)) for _ in range(rng.randrange(30))] + base[a:a + n] + [str(rng.randrange(vocabulary)) for _ in range(rng.randrange(30))]
        rows.append((rng.choice([i, i, i, 5, None]), rng.choice([" ", "\n", " \t"]).join(text)))
    rows += rows[:7] + [(1000 + i, t) for i, (_, t) in enumerate(rows[:9])]
    check(spark, rows)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(spark, rows)
    assert substring.remove_repeats(odd).count() == len(rows)


def test_empty_table(none):
    assert substring.remove_repeats(none).count() == 0


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 20, 1000])
def test_equal_windows_have_equal_anchors(vocabulary):
    rng = random.Random(vocabulary)
    seen = {}
    for _ in range(400):
        core = [str(rng.randrange(vocabulary)) for _ in range(13)]
        for _ in range(3):
            before, after = ([str(rng.randrange(vocabulary)) for _ in range(rng.randrange(20))] for _ in range(2))
            words, names = substring.word_names(" ".join(before + core + after))
            best = substring.window_anchors(names, np.array([0]))
            for k in range(len(words) - 12):
                assert best[k] > 0
                assert seen.setdefault(tuple(words[k:k + 13]), best[k]) == best[k]


def test_anchors_do_not_cross_documents():
    texts = ["a b c d e f g h i j k l m n o", "n o p q r s t u v w x y z a b c", "a b c d e f g h i j k l m"]
    named = [substring.word_names(t)[1] for t in texts]
    starts = np.cumsum([0] + [len(x) for x in named])[:-1]
    together = substring.window_anchors(np.concatenate(named), starts)
    for at, names in zip(starts, named):
        assert (together[at:at + len(names)] == substring.window_anchors(names, np.array([0]))).all()
