"""Uniform shuffle into shards of exact size.

Every input partition is permuted locally. The communication matrix says how
many rows go from each partition to each shard; it is drawn exactly, from the
multivariate hypergeometric law that a uniform permutation of all rows would
give it. The partition's first rows go to shard 0, the next to shard 1 and so
on, and each shard permutes what it has received.

The matrix is drawn by halving: a node holds some partitions and the counts
that the shards still take from them; how many of those come from its first
half is a hypergeometric draw per shard. Depth is the logarithm of the number
of partitions, and past 256 nodes the levels run on all executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import let, packed, quoted, small, stored, uniform, unpacked

ROWS_PER_BUCKET = 4096  # a shard is permuted in buckets of about so many rows
SPREAD_LEVEL = 8        # tree level after which the nodes are dealt to all tasks


def hypergeometric(total: Column, marked: Column, drawn: Column, *seed) -> Column:
    """Number of marked among ``drawn`` of ``total`` items.

    Walks the support with the ratio of neighbouring probabilities and keeps
    a value with its share of the weight so far, which is an exact draw. The
    walk covers 12 standard deviations and 30 values on either side of the
    mean; what lies outside weighs less than a double's last digit.
    """
    n, k, d = (c.cast("double") for c in (total, marked, drawn))
    mean = d * k / F.greatest(n, F.lit(1.0))
    sd = F.sqrt(F.greatest(mean * (1 - k / F.greatest(n, F.lit(1.0))) * (n - d) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked), F.floor(mean - 12 * sd - 30).cast("long"))
    high = F.least(drawn, marked, F.ceil(mean + 12 * sd + 30).cast("long"))

    def walk(s, x):
        v = x.cast("double")
        cum = s["cum"] + s["w"]
        return F.struct(
            F.when(uniform(*seed, x) * cum < s["w"], x).otherwise(s["x"]).alias("x"), cum.alias("cum"),
            (s["w"] * (k - v) * (d - v) / ((v + 1) * (n - k - d + v + 1))).alias("w"))

    start = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0.0).alias("cum"), F.lit(1.0).alias("w"))
    return F.when(low >= high, high).otherwise(F.aggregate(F.sequence(low, high), start, walk)["x"])


def _first_half(caps: Column, rows: Column, *seed) -> Column:
    """How many of the ``rows`` rows of a node's first half each shard takes."""
    def step(acc, cap):
        seeds = [*seed, F.size(acc["out"])]
        return let(hypergeometric(acc["total"], cap, acc["rows"], *seeds), lambda x: F.struct(
            F.concat(acc["out"], F.array(x)).alias("out"), (acc["total"] - cap).alias("total"), (acc["rows"] - x).alias("rows")))

    total = F.aggregate(caps, F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(F.array().cast("array<bigint>").alias("out"), total.alias("total"), rows.alias("rows"))
    return F.aggregate(caps, start, step)["out"]


def communication_matrix(counts: DataFrame, blocks: int, rows: int, n_shards: int, seed: int) -> DataFrame:
    """``counts`` has (pid, n). Returns (pid, upto): the running total over the
    shards of the rows that each takes from the partition."""
    caps = [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]
    nodes = counts.agg(F.sort_array(F.collect_list(F.struct("pid", "n"))).alias("parts")).select(
        F.lit(1).cast("long").alias("node"), "parts", F.array(*[F.lit(c).cast("long") for c in caps]).alias("caps"))
    for level in range(math.ceil(math.log2(max(blocks, 1)))):
        if level == SPREAD_LEVEL:
            nodes = nodes.repartition("node")
        half = F.shiftright(F.size("parts"), 1)
        first = F.slice("parts", 1, half)
        in_first = F.aggregate(first, F.lit(0).cast("long"), lambda a, p: a + p["n"])
        drawn = let(F.struct(F.col("caps").alias("c"), in_first.alias("m"), F.col("node").alias("v")),
                    lambda s: _first_half(s["c"], s["m"], F.lit(seed), s["v"]))
        child = F.explode(let(drawn, lambda mine: F.array(
            F.struct((F.col("node") * 2).alias("node"), first.alias("parts"), mine.alias("caps")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.slice("parts", half + 1, F.size("parts") - half).alias("parts"),
                     F.zip_with("caps", mine, lambda a, b: a - b).alias("caps")))))
        nodes = nodes.select(child.alias("c")).select("c.*").where(F.size("parts") > 0)
    upto = F.aggregate("caps", F.array().cast("array<bigint>"),
                       lambda a, c: F.concat(a, F.array(c + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))
    return nodes.select(F.col("parts")[0]["pid"].alias("pid"), upto.alias("upto"))


def shuffle_into_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to ``n_shards`` - 1)
    and ``slot`` (gapless from 0 in each shard); sizes differ by one at most.

    Nulls, empty texts, ties and repeated rows are rows like any other: each
    gets a place of its own. An empty table gives an empty result. Input
    columns named shard or slot give way to the outputs.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = df.sparkSession
    mid = F.monotonically_increasing_id()
    local = (packed(df, F.xxhash64(F.lit(seed), quoted(id_col), quoted(text_col)).alias("key"))
             .sortWithinPartitions("key").withColumn("mid", mid))
    placed = stored(local, "shards-local").withColumns({
        "pid": F.shiftright("mid", 33), "pos": F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("pid").agg(F.count("*").alias("n"))
    blocks, rows = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if rows == 0:
        matrix = spark.createDataFrame([], "pid long, upto array<bigint>")
    else:
        matrix = stored(communication_matrix(counts, blocks, rows, n_shards, seed), "shards-matrix")

    buckets = max(1, math.ceil(rows / n_shards / ROWS_PER_BUCKET))
    sent = (placed.join(small(matrix, blocks * n_shards * 8), "pid")
            .withColumn("shard", F.size(F.filter("upto", lambda u: u <= F.col("pos"))))
            .withColumn("again", uniform(F.lit(seed + 1), F.col("key"), F.col("mid")))
            .withColumn("bucket", F.floor(F.col("again") * buckets).cast("int")))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("shard", "bucket").orderBy("again", "mid")
    out = (sent.select("row", "shard", "bucket", "again", "mid")
           .join(small(starts, n_shards * buckets * 24), ["shard", "bucket"])
           .withColumn("slot", F.col("start") + F.row_number().over(inside) - 1))
    return unpacked(out, df.columns, {"shard": F.col("shard"), "slot": F.col("slot").cast("long")})
