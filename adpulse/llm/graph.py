"""Connected components by randomised contraction.

In each round every vertex joins the neighbour (or itself) whose hash of that
round is least, and edges are renamed to the chosen vertices. In expectation a
fixed share of the vertices goes in each round, whatever the shape of the
graph, so the rounds are as many as the logarithm of the vertices. Every round
is an aggregation and two joins over what is left, written to the shared
folder; only "is anything left" reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has (a, b), long. Returns (v, label) for every vertex that has
    an edge to another; the label is one of the component's vertices."""
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        salt = F.lit(len(rounds))
        both = left.union(left.select("b", "a"))
        near = both.groupBy(F.col("a").alias("v")).agg(F.min(F.struct(F.xxhash64(salt, "b").alias("h"), F.col("b").alias("r"))).alias("near"))
        own = F.struct(F.xxhash64(salt, "v").alias("h"), F.col("v").alias("r"))
        chosen = stored(near.select("v", F.least("near", own)["r"].alias("r")), "graph-round")
        left = stored(left.join(chosen.select(F.col("v").alias("a"), F.col("r").alias("ra")), "a")
                      .join(chosen.select(F.col("v").alias("b"), F.col("r").alias("rb")), "b")
                      .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "graph-edges")
        rounds.append(chosen)
    if not rounds:
        return left.select(F.col("a").alias("v"), F.col("b").alias("label"))
    labels = rounds.pop()
    labels = labels.select("v", F.col("r").alias("label"))
    for chosen in reversed(rounds):
        later = labels.select(F.col("v").alias("r"), "label")
        labels = chosen.join(later, "r", "left").select("v", F.coalesce("label", "r").alias("label"))
    return labels
