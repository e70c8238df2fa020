"""Quality without labels: a weak-label model and a hashed linear scorer.

Nine heuristics vote on each text: good, bad or no opinion. Texts with equal
votes are counted, at most 3 ** 9 patterns whatever the corpus, and
expectation-maximisation estimates on these counts how often texts are good
and how each heuristic votes on good and on bad ones. A text's posterior is
that of its pattern. The posteriors of a bounded sample, fixed by a hash of
the text, train a scorer on hashed character n-grams, which then scores every
text whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm import linear
from adpulse.llm.common import packed, quoted, ship, stored, unpacked
from adpulse.llm.toxicity import Model, feature_lists, sampled, scorer

SIZES = (3, 4)
KEEP = 0.5
VOTE_SCALE = 20.0  # of a vote among n-grams that count 1
GOOD, BAD, NONE = 1, 0, 2
_SYMBOLS = set("#*$%&|<>{}\\^~=_")
_ENDS = set(".,;:!?")
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))
# (rate, good up to, bad from): no opinion between the two. The heuristics
# overlap: what is wrong with a text shows in several of them.
RATE_VOTES = {
    "odd_words": (0.05, 0.25),     # words that are not letters with at most one mark behind
    "symbols": (0.01, 0.05),       # symbols of the characters
    "symbol_words": (0.02, 0.15),  # words with a symbol
    "shouting": (0.15, 0.5),       # capitals of the ASCII letters
    "marks": (0.01, 0.1),          # runs of marks, of the words
    "repeats": (0.1, 0.3),         # windows of three words that occurred before
    "lines": (0.05, 0.3),          # lines equal to an earlier one
    "sameness": (0.65, 0.85),      # words that occurred before
}


def votes(text: str | None) -> str:
    """A character for each heuristic: 1 good, 0 bad, 2 no opinion."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return str(BAD) + str(NONE) * len(RATE_VOTES)
    odd = [w for w in words if not (w.isalpha() or (w[-1] in _ENDS and w[:-1].isalpha()))]
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    raw = text.encode()
    plain = len(raw.translate(None, _LETTERS))
    rates = {
        "odd_words": len(odd) / n,
        "symbols": sum(c in _SYMBOLS for w in odd for c in w) / sum(map(len, words)),
        "symbol_words": sum(not _SYMBOLS.isdisjoint(w) for w in odd) / n,
        "shouting": (len(raw) - len(raw.translate(None, _CAPITALS))) / max(1, len(raw) - plain),
        "marks": (text.count("!!") + text.count("??") + text.count("....")) / n,
        "repeats": 1 - (len(set(zip(words, words[1:], words[2:]))) + 2) / n if n > 2 else 0.0,
        "lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
        "sameness": 1 - len(set(words)) / n,
    }
    out = [GOOD if n >= 50 else BAD if n < 5 else NONE]
    out += [GOOD if rates[k] <= good else BAD if rates[k] >= bad else NONE for k, (good, bad) in RATE_VOTES.items()]
    return "".join(map(str, out))


class Features:
    """Hashed character n-grams and the votes."""

    def __init__(self):
        self.grams = linear.Grams(SIZES)

    def __call__(self, text: str | None) -> np.ndarray:
        cast = np.array([3 * k + int(v) for k, v in enumerate(votes(text))])
        return np.concatenate([self.grams(text), linear.WIDTH + cast])


def feature_scale() -> np.ndarray:
    return np.r_[np.ones(linear.WIDTH), np.full(3 * (len(RATE_VOTES) + 1), VOTE_SCALE)]


def posteriors(patterns: dict[str, int], rounds: int = 100, smooth: float = 1.0) -> dict[str, float]:
    """Probability that a text with these votes is good, by expectation-
    maximisation of a two-class model with independent voters. It starts from
    the votes themselves: any bad vote makes a text doubtful."""
    if not patterns:
        return {}
    names = sorted(patterns)
    seen = np.array([[int(v) for v in p] for p in names])
    count = np.array([patterns[p] for p in names], dtype=np.float64)
    good = np.where((seen == BAD).any(axis=1), 0.1, 0.9)
    one_hot = seen[:, :, None] == np.arange(3)
    for _ in range(rounds):
        law = []
        for weight in (count * (1 - good), count * good):
            votes_of = (weight[:, None, None] * one_hot).sum(axis=0) + smooth
            law.append(np.log(weight.sum() + smooth) + (np.log(votes_of / votes_of.sum(axis=1, keepdims=True))[None] * one_hot).sum(axis=(1, 2)))
        new = 1 / (1 + np.exp(np.clip(law[0] - law[1], -50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return dict(zip(names, good.tolist()))


def _voted(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(df.sparkSession)

    @F.pandas_udf("string")
    def votes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([votes(t) for t in texts], dtype=object)

    return df.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("h"), votes_of(quoted(text_col)).alias("votes"))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, dict[str, float]]:
    """The scorer and the posterior of each pattern of votes. Votes of all
    rows count; the sample that trains the scorer is bounded as in
    ``toxicity.sampled``."""
    voted = stored(_voted(df, id_col, text_col), "quality-votes")
    counts = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}  # at most 3 ** 9
    good = posteriors(counts)
    if not good:
        return Model(feature_scale() * 0, feature_scale() ** 2, 0.0), good
    table = df.sparkSession.createDataFrame(list(good.items()), "votes string, y double")
    known = (voted.join(F.broadcast(table), "votes").groupBy("h").agg(F.min("y").alias("y"))
             .withColumn("side", (F.col("y") >= 0.5).cast("int")))
    # the texts of the sample, at most 4,000, are chosen by hash, copies counted once, before they are fetched
    chosen = [known.where(F.col("side") == y).orderBy("h").limit(2000) for y in (0, 1)]
    wanted = chosen[0].union(chosen[1])
    rows = (df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
            .join(F.broadcast(wanted), "h").groupBy("h").agg(*[F.min(c).alias(c) for c in ("id", "text", "y", "side")]).drop("h"))
    x, y = feature_lists(sampled(rows, "side"), "y", Features)
    scale = feature_scale()
    weights, bias = linear.train(x, y, scale)
    return Model(weights * scale, scale * scale, bias), good


def quality(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``score`` (0 to 1, higher: better)
    and ``kept`` (from 0.5 on).

    A null text is scored as an empty one, equal texts get equal scores, and
    an empty table gives an empty result. Input columns that have an output's
    name give way to it.
    """
    ship(df.sparkSession)
    rows = packed(df, scorer(model, Features)(quoted(text_col)).alias("score"))
    return unpacked(rows, df.columns, {"score": F.col("score"), "kept": F.col("score") >= KEEP})


def good_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the fitted model keeps, with its columns."""
    model, _ = fit(df, id_col, text_col)
    ship(df.sparkSession)
    rows = packed(df, scorer(model, Features)(quoted(text_col)).alias("score"))
    return rows.where(F.col("score") >= KEEP).select(*[F.col("row")[c].alias(c) for c in df.columns])
