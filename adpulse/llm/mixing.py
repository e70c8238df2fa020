"""Mixing sources to target weights.

Every row gets a key that its content decides at random. Within its source
rows are sorted by that key in ranges: the leading digits of the key name the
range, each range is summed, and a prefix sum over the ranges of a source
gives every range its start, so that no task holds more than one range. A row
is taken as far as the source's exact budget reaches; a budget beyond the
source's size takes whole epochs first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import WORD, packed, quoted, small, stored, unpacked

ROWS_PER_RANGE = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5       # all targets together, as a share of all sizes
MOST_EPOCHS = 2   # a target stops at so many times its source's size


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` has one row per source: (sk, source, source_size). Adds
    ``target`` and the whole-word ``budget``.

    Sources in code-point order, null last, weigh 3, 1, 2, repeating. Targets
    share the total by weight; what lies above a source's limit is shared
    again by weight among the others until none is above. In the order of
    limit to weight the sources at their limit come first, so the level of the
    others follows from prefix sums. One row per source goes through one task.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", "place")
    w = F.array(*[F.lit(float(x)) for x in WEIGHTS])
    t = (sizes.withColumn("place", F.row_number().over(order) - 1)
         .withColumn("weight", w[F.col("place") % len(WEIGHTS)])
         .withColumn("total", F.sum("source_size").over(everything).cast("double") * SHARE)
         .withColumn("limit", (F.col("source_size") * MOST_EPOCHS).cast("double"))
         .withColumn("ratio", F.col("limit") / F.col("weight")))
    below = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (F.col("total") - below) / others)
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    t = t.withColumn("target", F.coalesce(F.least("limit", level * F.col("weight")), F.col("limit")))
    return t.select("sk", "source", "source_size", "target", F.round("target").cast("long").alias("budget"))


def _mixed(df: DataFrame, size: Column | None, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(row, size, source_size, target, taken)."""
    size = word_count(quoted(text_col)) if size is None else size
    source = quoted(source_col)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(quoted(id_col).cast("string"), F.lit("-")),
                            F.md5(F.coalesce(quoted(text_col), F.lit("")))))
    rows = stored(packed(df, source.alias("source"), F.coalesce(F.concat(F.lit("s"), source), F.lit("-")).alias("sk"),
                         size.alias("size"), key.alias("key")), "mix-rows")
    sums = rows.groupBy("sk", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = stored(source_targets(sums.drop("n")), "mix-targets")
    n_rows, n_sources = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    digits = max(0, math.ceil(math.log(max(n_rows, 1) / ROWS_PER_RANGE, 16)))
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    earlier = Window.partitionBy("sk").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (rows.groupBy("sk", "range").agg(F.sum("size").alias("in_range"))
              .withColumn("start", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
              .join(small(targets.drop("source"), 64 * n_sources), "sk").drop("in_range"))
    upto = Window.partitionBy("sk", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("start") + F.sum("size").over(upto) - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
    part = F.greatest(F.lit(0), F.least("size", rest))
    return (rows.drop("source").join(ranges, ["sk", "range"]).withColumns({"before": before, "epochs": epochs})
            .select("row", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")))


def mix_sources(df: DataFrame, size: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", seed: int = 23) -> DataFrame:
    """All rows and columns of ``df`` with ``size`` (words of the text unless
    given), ``source_size``, ``target`` and ``taken`` (words that the mix
    takes of the row, repeats counted: 0 to 2 times its size).

    The words taken from a source are its target, rounded to a whole word.
    A null source is a source of its own, a null text has size 0, repeated
    rows are rows like any other, and an empty table gives an empty result.
    Input columns that have an output's name give way to it. The same table
    gives the same mix, however it is partitioned.
    """
    return unpacked(_mixed(df, size, id_col, text_col, source_col, seed), df.columns,
                    {c: F.col(c) for c in ("size", "source_size", "target", "taken")})


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: int = 23) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row, unchanged, for each
    epoch of a document that the mix takes. The one document per source at
    which the budget ends is taken whole if at least half of it lies within,
    else left out, so a source's words come within half a document of its
    budget. A document without words takes no budget and stays once; a null
    text is one. Repeated rows are rows like any other, a null source is a
    source of its own, and an empty table gives an empty result."""
    mixed = _mixed(df, None, id_col, text_col, source_col, seed)
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    copies = F.when(F.col("size") > 0, whole + (2 * rest >= F.col("size")).cast("long")).otherwise(1).cast("long")
    out = mixed.select("row", copies.alias("copies")).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(*[F.col("row")[c].alias(c) for c in df.columns])
