"""Spelling variants: neighbours at one edit by a dictionary of trie-node pairs.

The words make a trie, and the reversed words another; every node of both gets
a number. A word without one of its positions is a pair (node of the prefix
before it, reversed node of the suffix behind it), and so is a word cut between
two positions. Two words that leave the same pair when one position of each is
skipped differ by a replaced character; a word that leaves by skipping what
another is cut into has one character more. Both are equalities of two
integers, so the neighbours are exact and no strings are compared.

The numbers come from sorted words: a prefix is new where the word before does
not have it, and then takes the rank of the word and its length as number.
Words are range-partitioned by their first HEAD characters, so a prefix that
lies in several partitions is short; the driver names those from the first and
last heads of the partitions. A pair's words differ in one character, so a
group has at most as many as the alphabet has letters; each learns from the
group only its count and its two most frequent words. A run of equal letters
is skipped at its first position alone, or a pair of words would meet twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import quoted, ship, stored

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5        # a form is so many times as frequent as the word
HEAD = 64
DEPTH_BITS = 31  # of a node's number; the rank of its first word is above them
EMIT = 1 << 18   # rows or numbers of a batch
CUT, SKIP, FIRST_SKIP = range(3)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word): the runs of Latin letters of all texts with A-Z lower-cased; a
    run loses a code point if 199 divides the CRC of ``id:run``. Words below
    six code points are left out; a null text has none, a null id is empty."""
    runs = docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(quoted(text_col), UPPER, LOWER), F.lit(f"[a-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 199 == 0, F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)


# -- tries ------------------------------------------------------------------------------

def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def border_names(bounds: list[tuple[int, str, str]]) -> list[tuple[int, list[int], str, list[int]]]:
    """For partitions in order, each (words, first head, last head): the rank
    of the first word, the numbers of the prefixes shared with the partition
    before, the longest prefix shared with the next one, and its numbers."""
    out, rank, left = [], 0, [0]
    for k, (count, first, last) in enumerate(bounds):
        after = rank + count
        right = [0]
        if k + 1 < len(bounds):
            through = min(_common(first, last), len(left) - 1)  # these come from further left
            shared = _common(last, bounds[k + 1][1])
            right = [left[i] if i <= through else after << DEPTH_BITS | i for i in range(shared + 1)]
        out.append((rank, left, last[:len(right) - 1], right))
        rank, left = after, right
    return out


def numbered(words: DataFrame, word: str, rank: str, nodes: str) -> DataFrame:
    """``words`` with the rank of each in code-point order, from 0, and the
    numbers of its prefixes' trie nodes from the empty one to the whole word.
    The column ``word`` must hold distinct strings."""
    head = F.substring(word, 1, HEAD)
    dealt = stored(words.repartitionByRange(head).sortWithinPartitions(word).withColumn("part", F.spark_partition_id()), "trie")
    bounds = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(head).alias("a"), F.max(head).alias("b")).orderBy("part").collect()
    borders = dict(zip([b.part for b in bounds], border_names([(b.n, b.a, b.b) for b in bounds])))
    place = dealt.columns.index(word)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, path, here = None, "", np.zeros(1, dtype=np.int64), 0
        for batch in batches:
            texts, parts = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            start, ranks, paths, size = 0, [], [], 0
            for at, (text, p) in enumerate(zip(texts, parts)):
                new = p != part
                if new:
                    part, (here, left, right_text, right) = p, borders[p]
                    kept, path = len(left) - 1, np.array(left, dtype=np.int64)
                else:
                    kept = _common(before, text)
                own = (here << DEPTH_BITS) + np.arange(len(text) + 1, dtype=np.int64)
                own[:kept + 1] = path[:kept + 1]
                if kept < (m := _common(text, right_text)):
                    own[kept + 1:m + 1] = right[kept + 1:m + 1]
                before, path = text, own
                ranks.append(here)
                paths.append(own)
                here, size = here + 1, size + len(own)
                if size >= EMIT or at + 1 == len(texts):
                    given = batch.slice(start, at + 1 - start)
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in paths])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*given.columns[:-1], pa.array(ranks, type=pa.int64()),
                                                      pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(paths)))],
                                                     [*given.schema.names[:-1], rank, nodes])
                    start, ranks, paths, size = at + 1, [], [], 0

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields] + [f"`{rank}` bigint", f"`{nodes}` array<bigint>"])
    return dealt.repartition("part").sortWithinPartitions("part", word).mapInArrow(number, schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, word, prefix nodes, suffix nodes) -> (p, s, kind, id, n)."""
    names = ["p", "s", "kind", "id", "n"]
    rows: list[list[np.ndarray]] = [[] for _ in names]
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in rows], names)

    for given in batches:
        prefixes, suffixes = given.column(3), given.column(4)
        for k, (i, n, word) in enumerate(zip(*(given.column(c).to_pylist() for c in range(3)))):
            signs = np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)
            first = np.append(True, signs[1:] != signs[:-1])[:len(signs)]
            p = prefixes[k].values.to_numpy()
            s = suffixes[k].values.to_numpy()[::-1]
            for at in range(0, len(p), EMIT):
                cut_p, cut_s = p[at:at + EMIT], s[at:at + EMIT]
                skip_p, skip_s = p[:-1][at:at + EMIT], s[1:][at:at + EMIT]
                kind = np.concatenate([np.full(len(cut_p), CUT), np.where(first[at:at + EMIT], FIRST_SKIP, SKIP)]).astype(np.int8)
                for column, values in zip(rows, (np.concatenate([cut_p, skip_p]), np.concatenate([cut_s, skip_s]), kind,
                                                 np.full(len(kind), i, dtype=np.int64), np.full(len(kind), n, dtype=np.int64))):
                    column.append(values)
                size += len(kind)
                if size >= EMIT:
                    yield batch()
                    rows, size = [[] for _ in names], 0
    if size:
        yield batch()


# -- neighbours and forms ---------------------------------------------------------------

def _near(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are one edit away, and the most
    frequent of these as (minus its n, id)."""
    back = numbered(words.select("id", F.reverse("word").alias("drow")), "drow", "_rank", "suffixes").select("id", "suffixes")
    joined = words.join(back, "id").select("id", "n", "word", "prefixes", "suffixes")
    pairs = joined.mapInArrow(_pairs, "p bigint, s bigint, kind tinyint, id bigint, n bigint")
    # at most one word is cut at a pair, and those that skip there differ in one letter
    group = pairs.groupBy("p", "s").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "id", "kind"))).alias("all")).where(F.size("all") > 1)
    group = group.select("all", *[F.filter("all", test).alias(name) for name, test in (
        ("skips", lambda x: x["kind"] != CUT), ("firsts", lambda x: x["kind"] == FIRST_SKIP), ("cuts", lambda x: x["kind"] == CUT))])
    each = group.select(F.explode("all").alias("w"), F.get("skips", F.lit(0)).alias("top"), F.get("skips", F.lit(1)).alias("next"),
                        F.get("cuts", F.lit(0)).alias("cut"), F.get("firsts", F.lit(0)).alias("first"),
                        F.size("skips").alias("skips"), F.size("firsts").alias("firsts"), F.size("cuts").alias("cuts"))
    skips, takes_cut = F.col("w.kind") != CUT, F.col("w.kind") == FIRST_SKIP
    other = F.when(F.col("top.id") == F.col("w.id"), F.col("next")).otherwise(F.col("top"))
    best = F.when(skips, F.array_min(F.array_compact(F.array(other, F.when(takes_cut, F.col("cut")))))).otherwise(F.col("first"))
    count = F.when(skips, F.col("skips") - 1 + F.when(takes_cut, F.col("cuts")).otherwise(0)).otherwise(F.col("firsts"))
    found = each.select("w.id", count.cast("bigint").alias("near"), F.struct(best["m"].alias("m"), best["id"].alias("id")).alias("best")).where("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """(id, root) of links (id, to): each round doubles the steps taken. A
    step multiplies n by ``ratio`` at least, so ``most`` bounds the steps."""
    steps = math.floor(math.log(max(most, 1), ratio)) + 1
    at, far = links.select("id", F.col("to").alias("root")), 1
    while far < steps:
        on = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root")), "roots")
        far *= 2
    return at


def variants(words: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO, word_col: str = "word") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every distinct word of a
    table with one row per occurrence.

    Words with at least ``least`` occurrences (n) count. Two are near if they
    differ by one inserted, deleted or replaced code point. The form of a word
    is the near word of largest n (of equals the least in code-point order) if
    that n is at least ``ratio`` (2 or more) times its own, else null; the root is where the
    forms lead to, the word itself if it has none. Null words count nothing,
    the empty word is one like others, words of any length are whole, and an
    empty table gives no rows. Other columns play no part.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, so that forms lead upwards")
    ship(words.sparkSession)
    counts = words.select(quoted(word_col).alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    own = stored(numbered(counts, "word", "id", "prefixes"), "words")
    named = own.select("id", "word", "n")
    near = stored(_near(own), "near")
    linked = near.join(named, "id").where(-F.col("best.m") >= ratio * F.col("n")).select("id", F.col("best.id").alias("to"), (-F.col("best.m")).alias("form_n"))
    links = stored(linked, "links")
    roots = _roots(links, named.agg(F.max("n")).first()[0] or 0, ratio)
    name = named.select(F.col("id").alias("to"), F.col("word").alias("form"))
    forms = (links.join(name, "to").select("id", "form", "form_n")
             .join(roots.join(name.toDF("root", "root_word"), "root").select("id", "root_word"), "id"))
    return (named.join(near.select("id", "n_near"), "id", "left").join(forms, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))
