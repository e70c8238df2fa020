"""Removal of repeated and nearly repeated lines.

A line is its sequence of words. Two lines are near if one word substituted,
inserted or deleted makes them equal. The deletion neighbourhood of a line is
the line with any one word left out. Two lines of equal length are near if
they agree after leaving out the word at the same place; a line and one with a
word more, if the longer one agrees with the shorter after leaving out a word.
All variants are emitted as hashed keys of 128 bits, with the place; equal
keys meet, and the place verifies the distance: a variant reached at different
places of two lines of equal length is two edits away. The least of a key's
lines decides, so a key costs its members, not their pairs.

Near lines share their first or their last q words, q about half the length.
Lines whose halves no other line has are known to have no neighbour and emit
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import WORD, quoted, small, stored, unpacked

MIN_WORDS = 8  # shorter lines are repeated only if equal
NO_ID = (1 << 63) - 1
# Lengths of the shared halves: a line of c words or more than twice q has q.
HALVES = [4]
while HALVES[-1] < 1 << 20:
    HALVES.append(HALVES[-1] * 3 // 2)


def _half(n: Column) -> Column:
    """Largest of HALVES that is at most half of ``n``, a number of words."""
    found = F.when(n >= 2 * HALVES[-1], HALVES[-1])
    for q in reversed(HALVES[:-1]):
        found = found.when(n >= 2 * q, q)
    return found


def _words(line: str) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def _lines(docs: DataFrame) -> DataFrame:
    """(ord, key, no, line) of each line."""
    return docs.select("ord", "key", F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))


def _neighbours(first: DataFrame, docs: DataFrame) -> DataFrame:
    """(h1, h2) of the lines whose first occurrence has an earlier neighbour.

    ``first``: one row per distinct line (h1, h2, n, halves, first)."""
    halves = first.where(F.col("n") >= MIN_WORDS).select("h1", "h2", "n", "first", F.posexplode("halves").alias("pos", "half"))
    shared = (halves.groupBy("half").agg(F.min("h1").alias("least"), F.max("h1").alias("most"))
              .where("least <> most").select("half"))
    q = _half(F.when(F.col("pos") < 2, F.col("n")).otherwise(F.col("n") - 1))
    open_lines = (halves.join(shared, "half").groupBy("h1", "h2", "first")
                  .agg(F.min(F.when(F.col("pos") % 2 == 0, q)).alias("head"), F.min(F.when(F.col("pos") % 2 == 1, q)).alias("tail")))
    wanted = stored(open_lines.select("first.ord", "first.key", "first.no", "h1", "h2", "head", "tail"), "lines-open")
    words = (_lines(docs).join(small(wanted, 64 * wanted.count()), ["ord", "key", "no"]).dropDuplicates(["ord", "key", "no"])
             .select("ord", "key", "no", "h1", "h2", "head", "tail", F.posexplode(_words("line")).alias("i", "word")))
    # a variant's hash: xor over the words before the gap, and over those after it one place further on
    for lane in (1, 2):
        words = words.withColumns({f"here{lane}": F.xxhash64(F.lit(lane), "i", "word"),
                                   f"moved{lane}": F.xxhash64(F.lit(lane), F.col("i") - 1, "word")})
    line = Window.partitionBy("ord", "key", "no")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = words.drop("word").withColumns({
        "n": F.count("*").over(line),
        **{f"all_{c}": F.bit_xor(c).over(line) for c in ("here1", "moved1", "here2", "moved2")},
        **{f"upto_{c}": F.bit_xor(c).over(upto) for c in ("here1", "moved1", "here2", "moved2")}})
    for lane in (1, 2):
        before = F.col(f"upto_here{lane}").bitwiseXOR(F.col(f"here{lane}"))
        after = F.col(f"all_moved{lane}").bitwiseXOR(F.col(f"upto_moved{lane}"))
        words = words.withColumn(f"v{lane}", before.bitwiseXOR(after)).withColumnRenamed(f"all_here{lane}", f"whole{lane}")
    # an edit lies behind a shared head or before a shared tail
    needed = F.coalesce(F.col("i") >= F.col("head"), F.lit(False)) | F.coalesce(F.col("i") < F.col("n") - F.col("tail"), F.lit(False))
    member = F.struct("ord", "key", "no")
    variants = words.select("h1", "h2", member.alias("first"), F.explode(F.concat(
        F.when(needed, F.array(F.struct("v1", "v2", "i"))).otherwise(F.array()),
        F.when(F.col("i") == 0, F.array(F.struct(F.col("whole1").alias("v1"), F.col("whole2").alias("v2"), F.lit(-1).alias("i"))))
        .otherwise(F.array()))).alias("v")).select("h1", "h2", "first", "v.*")
    variants = stored(variants, "lines-variants")
    at_place = variants.groupBy("v1", "v2", "i").agg(F.min("first").alias("least"))
    # a whole line (place -1) meets the longer lines of its key, and they meet it
    key = Window.partitionBy("v1", "v2")
    whole = F.min(F.when(F.col("i") == -1, F.col("least"))).over(key)
    keyed = at_place.select("v1", "v2", "i", F.when(F.col("i") == -1, F.min("least").over(key)).otherwise(
        F.least("least", whole)).alias("least"))
    return (variants.join(keyed, ["v1", "v2", "i"]).where(F.col("least") < F.col("first"))
            .select("h1", "h2").distinct())


def _judged(df: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """(row, n_lines, n_exact, removed)."""
    ids = F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("ord")
    key = F.xxhash64(quoted(text_col)).alias("key")
    docs = df.select(ids, key, F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    words, n, q, lower = (F.col(c) for c in ("words", "n", "q", "lower"))

    def halves(q):  # first and last words, side and number hashed along
        return F.array(F.xxhash64(F.lit(0), q, F.slice(words, F.lit(1), q)), F.xxhash64(F.lit(1), q, F.slice(words, -q, q)))

    keys = F.when(n >= MIN_WORDS, F.when(q == lower, halves(q)).otherwise(F.concat(halves(q), halves(lower))))
    split = _lines(docs).withColumn("words", _words("line")).withColumn("n", F.size("words")).where("n > 0")
    split = split.withColumn("q", _half(n)).withColumn("lower", F.coalesce(_half(n - 1), q))
    lines = stored(split.select("ord", "key", "no", "n", F.xxhash64(words).alias("h1"),
                                       F.xxhash64(F.lit(7), words).alias("h2"), keys.alias("halves")), "lines")
    first = stored(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("ord", "key", "no")).alias("first"), F.first("n").alias("n"), F.first("halves").alias("halves")), "lines-first")
    near = _neighbours(first, docs).withColumn("near", F.lit(True))
    judged = first.join(near, ["h1", "h2"], "left").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    again = F.struct("ord", "key", "no") > F.col("first")
    by_doc = (lines.select("ord", "key", "no", "h1", "h2").join(judged, ["h1", "h2"])
              .groupBy("ord", "key").agg(
                  F.size(F.collect_set("no")).alias("n_lines"),
                  F.size(F.collect_set(F.when(again, F.col("no")))).alias("n_exact"),
                  F.array_sort(F.collect_set(F.when(again | F.col("near"), F.col("no")))).alias("removed")))
    carried = df.select(F.struct(*[quoted(c).alias(c) for c in carry]).alias("row"), ids, key)
    return carried.join(by_doc, ["ord", "key"], "left").select(
        "row", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` (columns of ``carry``, or all) with ``n_lines`` (lines with a word),
    ``n_exact`` and ``n_near`` (removed as equal to an earlier line; as only
    near one) and ``removed_lines`` (their places from 0, in order).

    A line is removed if an earlier line, by id and then place, equals it or,
    for lines of 8 words or more, is one word away; lines are judged on the
    input. Of an equal line only the first occurrence is compared with near
    ones: the others go anyway. Null ids come last, by a hash of the text; a
    null or empty text has no lines; repeated rows are one document and get
    the same result; an empty table gives an empty result. Input columns that
    have an output's name give way to it.
    """
    carry = df.columns if carry is None else carry
    return unpacked(_judged(df, id_col, text_col, carry), carry, {
        "n_lines": F.col("n_lines").cast("long"), "n_exact": F.col("n_exact").cast("long"),
        "n_near": (F.size("removed") - F.col("n_exact")).cast("long"), "removed_lines": F.col("removed")})


def kept_text(text: Column, removed: Column) -> Column:
    """The text without the lines at these places."""
    lines = F.split(text, "\n", -1)
    return F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(removed, i)), "\n")
