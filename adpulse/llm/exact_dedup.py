"""Exact deduplication with an extendible-hash index on shared files.

Every text has a 64-bit hash. The index maps a range of hashes to a bucket;
the directory has a slot for each prefix of the hash, starts from the depth
that the number of keys calls for and doubles while a bucket holds more keys
than its capacity. A bucket that is not overfull keeps its depth and is shared
by several slots. A key is a distinct (hash, SHA-256); keys of equal hash form
a chain in their bucket. Bytes are compared when the keys are made: rows are
grouped by the text itself, so two texts are in one group only if identical.

Copies are counted before any shuffle of rows, so a text that a third of all
rows share is one entry per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import packed, quoted, small, stored, unpacked

CAPACITY = 50_000  # keys of a bucket
DEEPEST = 40       # bits of the hash that the directory may use


def _prefix(h: Column, depth: int) -> Column:
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(h, 64 - depth)


def build_directory(keys: DataFrame, n_keys: int, capacity: int) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) for each prefix of the global depth, and
    that depth. Overfull buckets are split bit by bit; one whose keys all have
    the same hash cannot be split and stays a chain."""
    depth = max(0, math.ceil(math.log2(max(n_keys, 1) / capacity)))
    spark = keys.sparkSession
    done, open_keys = [], keys.select("h")
    while True:
        fill = open_keys.groupBy(_prefix(F.col("h"), depth).alias("prefix")).agg(
            F.count("*").alias("n"), (F.min("h") == F.max("h")).alias("one"))
        fill = stored(fill, "dedup-directory")
        over = F.col("n") > capacity
        split = over & ~F.col("one") if depth < DEEPEST else F.lit(False)
        done.append((depth, fill.where(~split).select("prefix")))
        overfull = fill.where(split).select("prefix")
        if overfull.isEmpty():
            break
        open_keys = open_keys.withColumn("prefix", _prefix(F.col("h"), depth)).join(
            overfull, "prefix", "left_semi").select("h")
        depth += 1
    slots = spark.createDataFrame([], "slot long, bucket string, local_depth int")
    for local, buckets in done:
        span = 1 << (depth - local)
        slots = slots.union(buckets.select(
            F.explode(F.sequence(F.col("prefix") * span, F.col("prefix") * span + (span - 1))).alias("slot"),
            F.concat_ws("/", F.lit(local), "prefix").alias("bucket"), F.lit(local).alias("local_depth")))
    return stored(slots, "dedup-slots"), depth


def _grouped(df: DataFrame, id_col: str, text_col: str, capacity: int, hash_of) -> DataFrame:
    """(row, sha, group_size, stays, kept)."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = stored(packed(df, hash_of(text).alias("h"), F.sha2(text, 256).alias("sha"),
                         quoted(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("rid")), "dedup-rows")
    # bytes compared: one row per distinct text
    texts = (df.groupBy(hash_of(text).alias("h"), text.alias("t")).agg(F.count("*").alias("n"))
             .select("h", F.sha2("t", 256).alias("sha"), "n"))
    chains = texts.groupBy("h", "sha").agg(F.sum("n").alias("group_size"), F.count("*").alias("texts")).withColumn(
        "group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
            F.raise_error(F.lit("two texts have one SHA-256")).cast("long"))).drop("texts")
    stays = rows.groupBy("h", "sha").agg(F.max(F.struct("id", (-F.col("rid")).alias("tie"))).alias("stays"))
    keys = stored(chains.join(stays, ["h", "sha"]), "dedup-keys")

    directory, depth = build_directory(keys, keys.count(), capacity)
    directory = small(directory, 24 << depth)

    def owned(part: DataFrame) -> DataFrame:
        return part.withColumn("slot", _prefix(F.col("h"), depth)).join(directory, "slot")

    index = owned(keys)
    found = owned(rows).join(index.select("bucket", "h", "sha", "group_size", "stays"), ["bucket", "h", "sha"])
    return found.select("row", "sha", "group_size", F.col("stays")["id"].alias("stays"),
                        (F.col("rid") == -F.col("stays")["tie"]).alias("kept"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                hash_of=F.xxhash64) -> DataFrame:
    """All rows and columns of ``df`` with ``keep_id`` (largest id among the
    rows of equal text), ``group_size``, ``kept`` and ``text_sha256``.

    A null text counts as empty. A null id is smaller than any other; in a
    group of null ids only, ``keep_id`` is null. Of repeated rows with the
    largest id one stays. An empty table gives an empty result. Input columns
    that have an output's name give way to it. ``hash_of`` may be any function
    from text to long; a poor one makes longer chains, not other results.
    """
    return unpacked(_grouped(df, id_col, text_col, capacity, hash_of), df.columns, {
        "keep_id": F.col("stays"), "group_size": F.col("group_size"), "kept": F.col("kept"), "text_sha256": F.col("sha")})


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``df`` that stay, with its columns."""
    return _grouped(df, id_col, text_col, capacity, F.xxhash64).where("kept").select(
        *[F.col("row")[c].alias(c) for c in df.columns])
