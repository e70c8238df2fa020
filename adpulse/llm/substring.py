"""Removal of repeated passages by recompression.

Words are named by hash. A round names every adjacent pair whose left symbol
falls in one half of the alphabet and whose right symbol in the other, then
every run of one symbol. Names are hashes of what they stand for, so they are
the same in every task without an exchange; which half a symbol falls in
follows from its name and the round. Each symbol carries the words that its
parse depends on. A symbol whose dependencies lie inside a window is an
interior symbol of the window wherever the window occurs.

A window's anchor is its longest interior symbol. Equal windows have equal
anchors, and anchors are several times fewer than windows. A first exchange
finds the anchors that documents of different text share; only windows on
shared anchors can be repeated. A second one compares these windows by 128
bits and tells each document which of its windows start in a document of
smaller id. Whole copies are one symbol and need neither.

What a batch can decide by itself it does not send: of all documents of a
batch with one anchor or window, one asks, so a passage that a third of all
documents share is one row per batch at its owner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import packed, quoted, ship, stored

WINDOW = 13
ROUNDS = 4
FAR = 1 << 40
WORDS_AT_ONCE = 1 << 20
WORDS_AT_A_TIME = 1 << 16
ASK, MARK, KNOWN = 0, 1, 2
NO_ID = (1 << 63) - 1  # a null id comes after every other


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_names(text: str | None) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode().split()  # bytes: the six ASCII spaces only
    return words, np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def window_anchors(names: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Anchor of the window that starts at each word; ``starts`` are the first
    words of the documents that ``names`` holds one after the other. Words at
    which no whole window starts get 0."""
    n = len(names)
    sizes = np.diff(np.r_[starts, n])
    first = np.repeat(starts, sizes)          # of each word's document
    past = np.repeat(starts + sizes, sizes)
    # best[k][i]: of the symbols that all windows from i to i + 2**k - 1 hold
    best = [np.zeros(n, dtype=np.uint64) for _ in range(window.bit_length())]
    exponent = np.array([max(x, 1).bit_length() - 1 for x in range(window + 1)])

    def consider(name, s, e, ds, de):
        inside = np.flatnonzero((ds >= first[s]) & (de <= past[s]) & (de - ds <= window))
        s, e, de = s[inside], e[inside], de[inside]
        low, high = np.maximum(de - window, first[s]), np.minimum(ds[inside], past[s] - window)
        rank = ((e - s).astype(np.uint64) << np.uint64(58)) | (name[inside] >> np.uint64(6))
        fits = low <= high
        low, high, rank = low[fits], high[fits], rank[fits]
        power = exponent[high - low + 1]
        for k, at_k in enumerate(best):  # two blocks of 2**k windows cover all from low to high
            some = np.flatnonzero(power == k)
            if len(some):
                np.maximum.at(at_k, low[some], rank[some])
                if k:
                    np.maximum.at(at_k, high[some] - (1 << k) + 1, rank[some])

    def beside(ds, de, joined):
        """What the next and the previous symbol depend on; past the end of a
        document, on more than any window holds."""
        back = np.r_[False, joined[:-1]]
        return ((np.where(joined, np.r_[ds[1:], 0], -FAR), np.where(joined, np.r_[de[1:], 0], FAR)),
                (np.where(back, np.r_[0, ds[:-1]], -FAR), np.where(back, np.r_[0, de[:-1]], FAR)))

    s, e = np.arange(n), np.arange(n) + 1
    name, ds, de = names, s, e
    consider(name, s, e, ds, de)
    for level in range(ROUNDS):
        # pairs: a symbol of the left half with its right-hand neighbour of the right half
        doc = first[s]
        right = (_mix(name, 2 * level + 1) & np.uint64(1)).astype(bool)
        joined = np.r_[doc[1:] == doc[:-1], False]
        pair = ~right & np.r_[right[1:], False] & joined
        second = np.r_[False, pair[:-1]]
        (next_ds, next_de), (prev_ds, prev_de) = beside(ds, de, joined)
        # a left symbol's neighbour decides if it is paired; a right symbol's, too
        ds, de = (np.where(right, np.minimum(ds, prev_ds), np.minimum(ds, next_ds)),
                  np.where(right, np.maximum(de, prev_de), np.maximum(de, next_de)))
        name = np.where(pair, _mix(name * np.uint64(3) + np.r_[name[1:], np.uint64(0)], 2 * level + 2), name)
        e = np.where(pair, np.r_[e[1:], 0], e)
        keep = ~second
        name, s, e, ds, de, pair = name[keep], s[keep], e[keep], ds[keep], de[keep], pair[keep]
        consider(name[pair], s[pair], e[pair], ds[pair], de[pair])
        # runs of one symbol; a symbol is alone only if its neighbours are known to differ
        doc = first[s]
        same = np.r_[False, (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])]
        heads = np.flatnonzero(~same)
        if not len(heads):
            break
        count = np.diff(np.r_[heads, len(name)])
        last = heads + count - 1
        (next_ds, next_de), (prev_ds, prev_de) = beside(ds, de, np.r_[doc[1:] == doc[:-1], False])
        next_ds, next_de, prev_ds, prev_de = next_ds[last], next_de[last], prev_ds[heads], prev_de[heads]
        run_ds, run_de = np.minimum.reduceat(ds, heads), np.maximum.reduceat(de, heads)
        tail_word, head_word = names[e[heads] - 1], names[s[heads]]
        s, e, doc = s[heads], e[last], doc[heads]
        end = past[s]
        before, after = s - 1, e
        left_known = (s > doc) & (names[np.maximum(before, 0)] != tail_word)
        right_known = (e < end) & (names[np.minimum(after, n - 1)] != head_word)
        ds, de = (np.minimum(np.minimum(run_ds, np.where(left_known, before, prev_ds)), np.where(right_known, FAR, next_ds)),
                  np.maximum(np.maximum(run_de, np.where(right_known, after + 1, next_de)), np.where(left_known, -FAR, prev_de)))
        many = count > 1
        name = np.where(many, _mix(name[heads] + count.astype(np.uint64), 1000 + level), name[heads])
        consider(name[many], s[many], e[many], ds[many], de[many])
    for k in range(len(best) - 1, 0, -1):
        half = 1 << (k - 1)
        np.maximum(best[k - 1], best[k], out=best[k - 1])
        np.maximum(best[k - 1][half:], best[k][:-half], out=best[k - 1][half:])
    return best[0]


_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(names: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each window of ``names``."""
    n = len(names) - window + 1
    high, part, out = names >> np.uint64(32), np.empty(n, dtype=np.uint64), []
    for factors in _FACTORS:
        h = np.zeros(n, dtype=np.uint64)
        for k in range(window):
            np.multiply(names[k:k + n], factors[k], out=part)
            part ^= high[k:k + n]
            h += part
        out.append(_mix(h, 77))
    return out[0], out[1]


def in_chunks(named: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(which, their names one after the other, starts, lengths) of documents,
    in chunks that a processor's cache holds; a longer document is alone."""
    at = 0
    while at < len(named):
        stop, size = at, 0
        while stop < len(named) and (stop == at or size + len(named[stop]) <= WORDS_AT_A_TIME):
            size += len(named[stop])
            stop += 1
        lengths = np.array([len(x) for x in named[at:stop]])
        yield range(at, stop), np.concatenate(named[at:stop]), np.r_[0, np.cumsum(lengths)[:-1]], lengths
        at = stop


def covered_words(hit: np.ndarray, n_words: int, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window that starts at a position of ``hit``."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """(ord, key, text, ...) rows in groups of bounded words."""
    for batch in batches:
        group, size = [], 0
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            size += len(row[2] or "") // 4
            group.append(row)
            if size > WORDS_AT_ONCE:
                yield group
                group, size = [], 0
        if group:
            yield group


def _parsed(group: list[tuple], window: int, hashed: bool = False) -> list[tuple]:
    """(row, anchors) of each document with a whole window; with ``hashed``
    the two hashes of its windows, too."""
    named = [(row, word_names(row[2])[1]) for row in group]
    named = [(row, x) for row, x in named if len(x) >= window]
    out = []
    for which, names, starts, lengths in in_chunks([x for _, x in named]):
        found = [window_anchors(names, starts, window), *(window_hashes(names, window) if hashed else ())]
        out += [(named[i][0], *[x[a:a + k - window + 1] for x in found]) for i, a, k in zip(which, starts, lengths)]
    return out


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v.view(np.int64) if v.dtype == np.uint64 else v for k, v in columns.items()})


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``docs``: (ord, key, text). Returns (ord, key, name) of each anchor that
    texts of another key have, too."""
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _texts(batches):
            parsed = _parsed(group, window)
            if not parsed:
                continue
            own = [np.unique(best) for _, best in parsed]
            sizes = [len(x) for x in own]
            name = np.concatenate(own)
            order_of = np.repeat(np.array([r[0] for r, _ in parsed], dtype=np.int64), sizes)
            key = np.repeat(np.array([r[1] for r, _ in parsed], dtype=np.int64), sizes)
            order = np.lexsort((key, name))
            by_name, by_key = name[order], key[order]
            heads = np.flatnonzero(np.r_[True, by_name[1:] != by_name[:-1]])
            count = np.diff(np.r_[heads, len(name)])
            shared = by_key[heads] != by_key[heads + count - 1]  # within the batch
            alike = np.empty(len(name), dtype=bool)
            alike[order] = np.repeat(shared, count)
            # document by document, so that equal ids follow one another and compress
            yield _batch(name=name, salt=np.where(alike, order_of ^ key, 0), ord=order_of, key=key,
                         kind=np.where(alike, KNOWN, ASK).astype(np.int32))
            marks = heads[shared]
            zero = np.zeros(len(marks), dtype=np.int64)
            yield _batch(name=by_name[marks], salt=zero, ord=zero, key=by_key[marks], kind=np.full(len(marks), MARK, dtype=np.int32))

    rows = docs.mapInArrow(anchors, "name long, salt long, ord long, key long, kind int")
    same = Window.partitionBy("name", "salt")
    rows = rows.select("*", F.max("kind").over(same).alias("top"), F.min("key").over(same).alias("least"), F.max("key").over(same).alias("most"))
    return rows.where(((F.col("kind") == KNOWN) | ((F.col("kind") == ASK) & ((F.col("top") == MARK) | (F.col("least") != F.col("most"))))))\
        .select("ord", "key", "name")


def earlier_windows(docs: DataFrame, window: int) -> DataFrame:
    """``docs``: (ord, key, text, anchors). Returns (ord, key, h) of each
    window on these anchors that starts in a document of smaller ord, too."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _texts(batches):
            parts = []
            for row, best, h, g in _parsed(group, window, hashed=True):
                alive = np.isin(best, np.array(row[3], dtype=np.int64).view(np.uint64))
                if alive.any():
                    h, at = np.unique(h[alive], return_index=True)
                    parts.append((h, g[alive][at], np.full(len(h), row[0], dtype=np.int64), np.full(len(h), row[1], dtype=np.int64)))
            if not parts:
                continue
            h, g, order_of, key = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((order_of, g, h))
            by_h, by_g = h[order], g[order]
            heads = np.flatnonzero(np.r_[True, (by_h[1:] != by_h[:-1]) | (by_g[1:] != by_g[:-1])])
            least = np.empty(len(h), dtype=np.int64)
            least[order] = np.repeat(order_of[order][heads], np.diff(np.r_[heads, len(h)]))
            later = order_of > least
            yield _batch(h=h, g=g, salt=np.where(later, order_of ^ key, 0), ord=order_of, key=key,
                         kind=np.where(later, KNOWN, ASK).astype(np.int32))

    rows = docs.mapInArrow(windows, "h long, g long, salt long, ord long, key long, kind int")
    same = Window.partitionBy("h", "g", "salt")
    rows = rows.withColumn("least", F.min("ord").over(same))
    return rows.where((F.col("kind") == KNOWN) | (F.col("least") < F.col("ord"))).select("ord", "key", "h")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                   window: int = WINDOW) -> DataFrame:
    """Rows of ``df`` (columns of ``carry``, or all) with ``n_words``,
    ``n_removed``, ``removed`` (word spans [start, end) covered by windows of
    ``window`` words that also start in a document of smaller id) and
    ``kept_sha256`` (of the words kept, joined by one space).

    A null text has no words. A null id is larger than any other, and rows of
    equal id remove nothing from one another; so repeated rows get the same
    result. An empty table gives an empty result. Input columns that have an
    output's name give way to it.
    """
    ship(df.sparkSession)
    order_of = F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID))
    key = F.xxhash64(quoted(text_col))

    @F.pandas_udf("n_words long, a long, b long, sha string")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = (text or "").encode().split()
                joined = b" ".join(words)
                whole = xxhash.xxh3_128_digest(joined)
                rows.append((len(words), *np.frombuffer(whole, dtype="<i8").tolist(), hashlib.sha256(joined).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_words", "a", "b", "sha"])

    info = packed(df, order_of.alias("ord"), key.alias("key"), described(quoted(text_col)).alias("d"))
    if carry is not None:
        info = info.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in carry]))
    info = stored(info.select("row", "ord", "key", "d.*"), "repeats-info")
    firsts = info.groupBy("a", "b").agg(F.min("ord").alias("first"))
    info = info.join(firsts, ["a", "b"]).withColumn("copy", (F.col("ord") > F.col("first")) & (F.col("n_words") >= window))

    docs = df.select(order_of.alias("ord"), key.alias("key"), quoted(text_col).alias("text"))
    anchors = (shared_anchors(docs, window).groupBy("ord", "key").agg(F.collect_set("name").alias("anchors"))
               .join(info.where("not copy").select("ord", "key").distinct(), ["ord", "key"]))
    candidates = stored(docs.join(anchors, ["ord", "key"]), "repeats-candidates")
    hits = earlier_windows(candidates, window).groupBy("ord", "key").agg(F.collect_set("h").alias("hits"))

    @F.pandas_udf("n_removed long, removed array<array<long>>, sha string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            rows, given = [], [word_names(text) for text in texts]
            for which, names, starts, lengths in in_chunks([x for _, x in given]):
                h = window_hashes(names, window)[0]
                for i, a, k in zip(which, starts, lengths):
                    hit = np.isin(h[a:a + k - window + 1], np.asarray(found.iloc[i], dtype=np.int64).view(np.uint64))
                    gone = covered_words(hit, k, window)
                    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    kept = b" ".join(w for w, g in zip(given[i][0], gone) if not g)
                    rows.append((int(gone.sum()), edges.reshape(-1, 2).tolist(), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_removed", "removed", "sha"])

    cuts = (candidates.select("ord", "key", "text").join(hits, ["ord", "key"])
            .select("ord", "key", cut("text", "hits").alias("cut"))
            .groupBy("ord", "key").agg(F.first("cut").alias("cut")))
    found = info.join(cuts, ["ord", "key"], "left")
    nothing = F.sha2(F.lit(""), 256)
    out = {
        "n_words": F.col("n_words"),
        "n_removed": F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce(F.col("cut.n_removed"), F.lit(0))).cast("long"),
        "removed": F.when(F.col("copy"), F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))).otherwise(
            F.coalesce(F.col("cut.removed"), F.array().cast("array<array<bigint>>"))),
        "kept_sha256": F.when(F.col("copy"), nothing).otherwise(F.coalesce(F.col("cut.sha"), F.col("sha")))}
    names = [c for c in (df.columns if carry is None else carry) if c.lower() not in out]
    return found.select(*[F.col("row")[c].alias(c) for c in names], *[v.alias(k) for k, v in out.items()])
