import random
import re

import pytest
from pyspark.sql import functions as F

from adpulse.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near(a, b):
    """At most one word substituted, inserted or deleted."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(rows):
    """n_exact, removed places by (id, text); ids are distinct or the rows equal."""
    lines = []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        lines += [((i, t), no, tuple(WORD.findall(x))) for no, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    first, gone = {}, {}
    for doc, no, words in lines:
        entry = gone.setdefault(doc, [0, [], 0])
        entry[2] += 1
        if words in first:
            entry[0] += 1
            entry[1].append(no)
        else:
            if len(words) >= 8 and any(len(w) >= 8 and near(w, words) for w in first):
                entry[1].append(no)
            first[words] = True
    return gone


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    out = line_dedup.dedup_lines(df).collect()
    assert len(out) == len(rows)
    for r in out:
        exact, removed, n = want.get((r.doc_id, r.text), [0, [], 0])
        assert (r.n_lines, r.n_exact, r.n_near, r.removed_lines) == (n, exact, len(removed) - exact, removed)


@pytest.mark.parametrize("vocabulary", [2, 30])
def test_random_lines_against_all_pairs(spark, vocabulary):
    rng = random.Random(vocabulary)
    base = [[str(rng.randrange(vocabulary)) for _ in range(rng.randrange(1, 30))] for _ in range(25)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(words) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    words.insert(at, str(rng.randrange(vocabulary)))
                elif words[at:at + 1]:
                    words[at:at + 1] = [str(rng.randrange(vocabulary))] if kind == 1 else []
            lines.append(rng.choice([" ", "\t", "  "]).join(words))
        rows.append((i, "\n".join(lines)))
    check(spark, rows + rows[:3])


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id not in (None, 11)]
    check(spark, rows)
    assert line_dedup.dedup_lines(odd).count() == odd.count()


def test_empty_table(none):
    assert line_dedup.dedup_lines(none).count() == 0


def test_text_without_removed_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc", [1, 3])], "text string, removed array<int>")
    assert df.select(line_dedup.kept_text(F.col("text"), F.col("removed")).alias("t")).first().t == "a\n"
