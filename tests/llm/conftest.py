import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "shard string, size string, key string, row string, id long, kept string, ids string, n_words string")
TEN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
LONG = " ".join(random.Random(4).choice(["alpha", "beta", "gamma", "delta", "Été", "日本", "x9"]) for _ in range(40_000))


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    texts = [(1, TEN), (2, TEN), (2, TEN), (None, TEN), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (7, LONG + " end"),
             (8, "Short line\nShort line\nanother " + TEN), (9, "other start " + TEN + " other end"), (None, None), (None, "lonely text"),
             (10, "naïve café 日本語 \U0001F600 1234 don't"), (11, "a b"), (11, "a c"), (12, "x" * 3000)]
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", k) for k, (i, t) in enumerate(texts)]
    return [(*r, "in", "in", None, "in", 77, None, "in", "in") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
