"""Toxicity by a linear classifier on character n-grams that are scaled by
naive Bayes log-count ratios.

The labelled rows that may be learned from are joined to their texts; of each
label a sample fixed by a hash of the id trains the model: at most
``PER_LABEL`` rows and ``SAMPLE_BYTES`` of text. All texts are scored whole in
the tasks that read them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm import linear
from adpulse.llm.common import packed, quoted, ship, unpacked

SIZES = (4, 5)
PER_LABEL = 1000
SAMPLE_BYTES = 16 << 20
CUT = 0.7


@dataclass
class Model:
    weights: np.ndarray  # times the scale
    squares: np.ndarray  # of the scale
    bias: float


def grams() -> linear.Grams:
    return linear.Grams(SIZES)


def held_out(ids: Column) -> Column:
    return F.coalesce(F.crc32(ids.cast("string")) % 3 == 1, F.lit(False))


def sampled(rows: DataFrame, label: str, per_label: int = PER_LABEL, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``rows``: (id, text, <label> 0 or 1). A sample of each label in the
    order of a hash of id and text, up to the two bounds. A text above the
    bound of bytes by itself is passed over; a label that has no other texts
    keeps one of them."""
    rows = rows.withColumns({"h": F.xxhash64("id", "text"), "size": F.coalesce(F.octet_length("text"), F.lit(0))})
    order = [F.col("size") > most_bytes // 2, "h", "id"]
    parts = [rows.where(F.col(label) == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    upto = Window.partitionBy(label).orderBy(*order)
    return parts[0].union(parts[1]).withColumns({
        "upto": F.sum("size").over(upto.rowsBetween(Window.unboundedPreceding, 0)), "place": F.row_number().over(upto)
    }).where((F.col("upto") <= most_bytes // 2) | (F.col("place") == 1))


def feature_lists(rows: DataFrame, label: str, features) -> tuple[list[np.ndarray], list[float]]:
    """Features and labels of a sample, extracted on the executors;
    ``features()`` makes what maps a text to the features it has."""
    ship(rows.sparkSession)

    @F.pandas_udf("binary")
    def found_in(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = features()
        for texts in batches:
            yield pd.Series([find(t).astype("<i4").tobytes() for t in texts], dtype=object)

    found = rows.select("h", "id", F.col(label).cast("double").alias("y"), found_in("text").alias("x")).toPandas().sort_values(["h", "id"])
    return [np.frombuffer(x, dtype="<i4") for x in found.x], found.y.tolist()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns from labelled rows that are not held out. Rows without an id or a
    label are left aside; of several labels of one id the largest counts."""
    known = (labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y"))
             .where(F.col("y").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    # the ids of the sample, at most 4,000, are chosen before their texts are fetched
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(2 * PER_LABEL) for y in (0, 1)]
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(F.broadcast(chosen[0].union(chosen[1])), "id")
    x, y = feature_lists(sampled(rows, "y"), "y", grams)
    scale = linear.log_count_ratios(x, y) if y else np.zeros(linear.WIDTH)
    weights, bias = linear.train(x, y, scale)
    return Model(weights * scale, scale * scale, bias)


def scorer(model: Model, features):
    weights, squares, bias = model.weights.astype(np.float32), model.squares.astype(np.float32), model.bias

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = features()
        for texts in batches:
            yield pd.Series([linear.score(find(t), weights, bias, squares) for t in texts], dtype="float64")
    return scores


def toxicity(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``held_out`` (its label was not to
    be learned from), ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    A null text is scored as an empty one; a null id is not held out; equal
    texts get equal scores. Without training rows every score is 0.5. An empty
    table gives an empty result. Input columns that have an output's name give
    way to it.
    """
    ship(df.sparkSession)
    rows = packed(df, held_out(quoted(id_col)).alias("held_out"), scorer(model, grams)(quoted(text_col)).alias("score"))
    return unpacked(rows, df.columns, {"held_out": F.col("held_out"), "score": F.col("score"),
                                       "predicted": (F.col("score") >= CUT).cast("int")})
