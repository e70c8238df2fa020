import re
from collections import Counter

import numpy as np

from adpulse.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {p for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_of_odd_rows(odd):
    out = quality_rules.quality_rules(odd).collect()
    assert len(out) == odd.count()
    for r in out:
        want = counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_thresholds_follow_each_group(spark):
    """What is usual in one source is out of line in another; the verdict is
    that of exact quartiles, as sketches of small groups are exact, weighed
    by rows against those of the language and of all rows."""
    rng = np.random.default_rng(5)
    rows = []
    for source, share in (("prose", 0.0), ("code", 0.3), (None, 0.1)):
        for k in range(150):
            words = [("#" if rng.random() < share else "") + "w" + str(rng.integers(10 ** 6)) for _ in range(80)]
            rows.append((len(rows), " ".join(words), "en", source))
    rows += [(len(rows), " ".join(f"#{i}x" for i in range(80)), "en", "prose"), (len(rows) + 1, " ".join(f"#{i}x" for i in range(80)), "en", "code")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    out = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    rate = {i: counts(t)[2] / counts(t)[1] for i, t, _, _ in rows}
    prior, every = quality_rules.PRIOR_ROWS, np.quantile(list(rate.values()), [0.25, 0.75], method="inverted_cdf")
    for source in ("prose", "code", None):
        ids = [i for i, _, _, s in rows if s == source]
        own = np.quantile([rate[i] for i in ids], [0.25, 0.75], method="inverted_cdf")  # one language: above are all rows
        q1, q3 = (len(ids) * own + prior * every) / (len(ids) + prior)
        spread = max(q3 - q1, 0.01)
        for i in ids:
            if abs(rate[i] - (q3 + 3 * spread)) > 0.01 and abs(rate[i] - (q1 - 3 * spread)) > 0.01:
                assert out[i].kept == (q1 - 3 * spread <= rate[i] <= q3 + 3 * spread)
    assert not out[len(rows) - 2].kept
    assert sum(out[i].kept for i in range(450)) >= 445


def test_small_groups_lean_on_the_merged_sketches(spark):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(60)), "en", f"s{k}") for k in range(120)] + [(500, " ".join(f"#{i}" for i in range(60)), "de", "alone")]
    out = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(out[k] for k in range(120)) and not out[500]


def test_empty_table(none):
    assert quality_rules.quality_rules(none).count() == 0
