import random
import zlib

import pytest

from adpulse.llm import linear, quality_model, toxicity

SYLLABLES = ["ther", "ing", "on", "at", "en", "ed", "al", "is", "or", "ti", "sh", "ble", "ou"]
BAD = ["idiot", "scum", "pathetic", "worthless"]


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def labelled(n=600):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        words = prose(rng, rng.randrange(30, 300)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(3, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    return rows, docs, toxicity.fit(docs, labels)


def test_toxicity_of_held_out_texts(toxic_model):
    rows, docs, model = toxic_model
    out = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(out[i].held_out for i, _ in held) and sum(r.held_out for r in out.values()) == len(held)
    assert sum(out[i].predicted == y for i, y in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())


def test_held_out_labels_do_not_matter(spark, toxic_model):
    rows, docs, model = toxic_model
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows]
    again = toxicity.fit(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert (again.weights == model.weights).all() and again.bias == model.bias


def test_toxicity_of_odd_rows(odd, none, toxic_model):
    out = toxicity.toxicity(odd, toxic_model[2]).collect()
    assert len(out) == odd.count() and len({r.score for r in out if not r.text}) == 1
    assert toxicity.toxicity(none, toxic_model[2]).count() == 0


def test_without_training_rows_scores_are_even(spark, odd):
    model = toxicity.fit(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.toxicity(odd, model).collect()} == {0.5}


def test_grams_of_a_long_text_are_those_of_its_parts(monkeypatch):
    text = prose(random.Random(2), 500)
    whole = linear.Grams((3, 4))(text)
    monkeypatch.setattr(linear, "BYTES_AT_ONCE", 64)
    assert (linear.Grams((3, 4))(text) == whole).all()


def test_log_count_ratios_favour_the_label():
    import numpy as np
    x = [np.array([1, 2]), np.array([1, 3]), np.array([2, 3])]
    r = linear.log_count_ratios(x, [1, 1, 0])
    assert r[1] > 0 > r[2] - 1e-9 or r[1] > r[2]
    assert r[1] == pytest.approx(np.log(3 / 4) - np.log(1 / 3))


def junk(rng, kind, n):
    words = prose(rng, n).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words[:20] * 5)
    if kind == 1:
        return " | ".join(words)
    if kind == 2:
        return " ".join(w + rng.choice(["***", "$$$", "&&&"]) for w in words)
    return " ".join([words[0]] * n)


def test_quality_without_labels(spark):
    rng = random.Random(6)
    rows = [(i, junk(rng, i % 4, 100) if i % 6 == 0 else prose(rng, rng.randrange(40, 250)), i % 6 != 0) for i in range(0, 900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model, posteriors = quality_model.fit(docs)
    assert all(0 <= p <= 1 for p in posteriors.values())
    out = {r.doc_id: r.kept for r in quality_model.quality(docs, model).collect()}
    assert sum(out[i] for i, _, good in rows if good) >= 0.99 * sum(good for *_, good in rows)
    assert sum(not out[i] for i, _, good in rows if not good) >= 0.95 * sum(not good for *_, good in rows)
    kept = quality_model.good_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(out.values())


def test_expectation_maximisation_finds_the_accuracies():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = "".join(str(int(good) if rng.random() < a else 1 - int(good)) for a in (0.9, 0.85, 0.95, 0.9))
        counts[votes] = counts.get(votes, 0) + 1
    p = quality_model.posteriors(counts)
    assert p["1111"] > 0.99 and p["0000"] < 0.05 and p["1101"] < p["1111"]
    assert sum(n * p[v] for v, n in counts.items()) / 20_000 == pytest.approx(0.8, abs=0.03)


def test_quality_of_odd_rows(odd, none):
    model, _ = quality_model.fit(odd)
    assert quality_model.quality(odd, model).count() == odd.count()
    empty, posteriors = quality_model.fit(none)
    assert posteriors == {} and quality_model.quality(none, empty).count() == 0
    assert quality_model.good_documents(odd).columns == odd.columns


def test_sample_passes_over_oversized_texts(spark):
    small = [(i, f"text {i}", y) for y in (0, 1) for i in range(3)]
    big = [(100 + i, "x" * 600, y) for y in (0, 1) for i in range(30)]
    rows = spark.createDataFrame(small + big, "id long, text string, y int")
    got = toxicity.sampled(rows, "y", per_label=10, most_bytes=1000).collect()
    assert sorted((r.id, r.text, r.y) for r in got) == sorted(small)
    only = toxicity.sampled(rows.where("id >= 100"), "y", most_bytes=1000).collect()
    assert sorted(r.y for r in only) == [0, 1]


def test_quality_sample_counts_copies_once(spark, monkeypatch):
    rng = random.Random(5)
    texts = spark.createDataFrame([(prose(rng, 60),) for _ in range(200)], "text string")
    lowest = texts.selectExpr("text", "xxhash64(text) AS h").orderBy("h").first().text
    docs = texts.selectExpr("monotonically_increasing_id() AS doc_id", "text").union(
        spark.range(10_000_000_000_000, 10_000_000_002_500).selectExpr("id", f"'{lowest}'"))
    sampled = []

    def feature_lists(rows, label, features):
        sampled.extend(r.text for r in rows.collect())
        return toxicity.feature_lists(rows, label, features)

    monkeypatch.setattr(quality_model, "feature_lists", feature_lists)
    quality_model.fit(docs)
    assert len(sampled) == len(set(sampled)) == 200
