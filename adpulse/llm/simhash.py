"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has 64 bits. Bits that are correlated over the corpus are
grouped into partitions, and the partitions get thresholds T_i of at least -1
whose sum is the bit distance minus the number of partitions plus 1. Two
fingerprints within the distance then differ in at most T_i bits of some
partition. A dynamic program over the partitions allocates the thresholds, and
with them the number of partitions, by the signatures to be emitted and the
candidates that the bit statistics of all fingerprints make likely.

Fingerprints are probed by every value within T_i of theirs in a partition; a
bucket holds those that meet in one value. In a bucket a search from
fingerprint to fingerprint verifies the distance to those not yet reached, so
a group of near copies costs about its size and gives a spanning tree, not all
its pairs. Equal fingerprints count once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import packed, quoted, ship, stored
from adpulse.llm.graph import components

BITS = 64
SHINGLE = 3
DISTANCE = 3
CHUNK = 1 << 16         # shingles of a text that are counted at once
PAIR_COST = 0.02        # of verifying a candidate, in signatures emitted
SMALL_BUCKET = 12       # up to here a bucket's pairs are compared in place


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the shingles of lower-cased words, repeats
    included; fewer words than a shingle make one, none give 0."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:min(at + CHUNK, n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")
    return fingerprints


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, of how many both are
    set: 64 x 64 sums over all of them."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += len(bits)
            both += bits.T @ bits
        if total:
            yield pa.RecordBatch.from_pydict({"i": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), total).astype(np.int64)})

    rows = distinct.select("fp").mapInArrow(partial, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    sums = np.zeros(BITS * BITS + 1)
    for row in rows:  # 4,097 sums, whatever the corpus
        sums[row.i] = row.n
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def correlated_groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of nearly equal size; each starts with the free bit of
    the strongest correlations and takes the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        groups.append(sorted(group))
        free = [b for b in free if b not in group]
    return groups


def near_probability(p: np.ndarray, most: int) -> list[float]:
    """For t = 0 to ``most``: chance that two fingerprints differ in at most t
    of the bits that are set with probabilities ``p``."""
    law = np.zeros(most + 1)
    law[0] = 1.0
    for x in 2 * p * (1 - p):
        law = law * (1 - x) + np.concatenate([[0.0], law[:-1]]) * x
    return list(np.cumsum(law))


def allocate(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition: the cheapest over 2 to
    ``distance`` + 1 partitions, thresholds by dynamic programming."""
    p = np.diag(both) / max(n, 1)
    plans = []
    for parts in range(2, distance + 2):
        best = {0: (0.0, [])}  # by the sum of thresholds so far
        for group in correlated_groups(n, both, parts):
            near = near_probability(p[group], min(2, distance))
            costs = {-1: 0.0}
            ball = 0
            for t, chance in enumerate(near):
                ball += len(list(itertools.combinations(range(len(group)), t)))
                costs[t] = n * ball + PAIR_COST * n * n / 2 * chance * ball
            step = {}
            for used, (cost, so_far) in best.items():
                for t, extra in costs.items():
                    if used + t not in step or cost + extra < step[used + t][0]:
                        step[used + t] = (cost + extra, [*so_far, (group, t)])
            best = step
        plans.append(best[distance - parts + 1])
    return min(plans, key=lambda x: x[0])[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def signatures(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp): every value within the threshold, part by part."""
    def probe(k: int, mask: int):
        return lambda flip: F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).bitwiseXOR(flip).alias("value"))

    probes = []
    for k, (bits, threshold) in enumerate(plan):
        flips = [_signed(sum(1 << b for b in some)) for t in range(threshold + 1) for some in itertools.combinations(bits, t)]
        if flips:
            own = _signed(sum(1 << b for b in bits))
            probes.append(F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), probe(k, own)))
    return distinct.select(F.explode(F.concat(*probes)).alias("s"), "fp").select("s.part", "s.value", "fp")


def _tree(fps: np.ndarray, distance: int) -> tuple[list, list]:
    """Spanning forest of the links among ``fps``."""
    a, b, rest = [], [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = np.bitwise_count(rest ^ at) <= distance
            if hit.any():
                found = rest[hit]
                a.extend([at] * len(found))
                b.extend(found)
                queue.extend(found)
                rest = rest[~hit]
    return a, b


def _bucket_links(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in sorted buckets; ``keys`` numbers the buckets."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    of_row = np.repeat(sizes, sizes)
    a, b = [], []
    small = np.flatnonzero((of_row > 1) & (of_row <= SMALL_BUCKET))
    for step in range(1, SMALL_BUCKET):
        first = small[small + step < len(keys)]
        first = first[keys[first] == keys[first + step]]
        first = first[np.bitwise_count(fps[first] ^ fps[first + step]) <= distance]
        a.append(fps[first])
        b.append(fps[first + step])
    for s in np.flatnonzero(sizes > SMALL_BUCKET):
        x, y = _tree(fps[starts[s]:starts[s] + sizes[s]], distance)
        a.append(np.array(x, dtype=np.uint64))
        b.append(np.array(y, dtype=np.uint64))
    return np.concatenate(a), np.concatenate(b)


def verified_links(probes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): fingerprints of one bucket at most ``distance`` bits apart; a
    bucket's links span the same groups as all its pairs would."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            new = [] if batch is None else [[c.to_numpy(zero_copy_only=False) for c in batch.columns]]
            part, value, fp = (np.concatenate(x) for x in zip(*([held] if held else []), *new)) if held or new else (np.zeros(0),) * 3
            if not len(part):
                continue
            ends = np.flatnonzero((part[1:] != part[:-1]) | (value[1:] != value[:-1])) + 1
            cut = len(part) if batch is None else (ends[-1] if len(ends) else 0)
            held = [part[cut:], value[cut:], fp[cut:]]  # the last bucket may go on in the next batch
            if cut:
                keys = np.cumsum(np.r_[0, (part[1:cut] != part[:cut - 1]) | (value[1:cut] != value[:cut - 1])])
                a, b = _bucket_links(keys, fp[:cut].astype(np.int64).view(np.uint64), distance)
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (probes.repartition("part", "value").sortWithinPartitions("part", "value", "fp")
            .mapInArrow(search, "a long, b long"))


def _grouped(df: DataFrame, id_col: str, text_col: str, carry: list[str] | None, shingle: int, distance: int) -> DataFrame:
    """(row, fp, component_id, kept)."""
    ship(df.sparkSession)
    text, ids = quoted(text_col), quoted(id_col).cast("long")
    rows = packed(df, fingerprint_udf(shingle)(text).alias("fp"), ids.alias("id"))
    if carry is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in carry]))
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "simhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("first")
    distinct = stored(rows.groupBy("fp").agg(first), "simhash-distinct")
    n, both = bit_statistics(distinct)
    links = verified_links(signatures(distinct.select("fp"), allocate(n, both, distance)), distance)
    labels = stored(components(links), "simhash-labels")
    grouped = (distinct.join(labels.withColumnRenamed("v", "fp"), "fp", "left")
               .select("fp", F.coalesce("label", "fp").alias("label"), "first"))
    firsts = grouped.groupBy("label").agg(F.min("first").alias("first"))
    members = grouped.select("fp", "label").join(firsts, "label").select("fp", "first")
    return rows.join(members, "fp").select(
        "row", "fp", F.col("first")["id"].alias("component_id"), (F.col("rid") == F.col("first")["rid"]).alias("kept"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Rows of ``df`` (columns of ``carry``, or all) with ``fingerprint`` (16
    hex digits), ``component_id`` (smallest id reachable by links of at most
    ``distance`` bits) and ``kept`` (one row of each component: of the
    smallest id; a null id comes after the others, repeated rows give one).

    A null or empty text has fingerprint 0, which links like any other. In a
    component without an id, component_id is null. An empty table gives an
    empty result. Input columns that have an output's name give way to it.
    """
    out = {"fingerprint": F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id": F.col("component_id"), "kept": F.col("kept")}
    rows = _grouped(df, id_col, text_col, carry, shingle, distance)
    names = [c for c in (df.columns if carry is None else carry) if c.lower() not in out]
    return rows.select(*[F.col("row")[c].alias(c) for c in names], *[v.alias(k) for k, v in out.items()])


def without_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with the columns of ``df``."""
    return _grouped(df, id_col, text_col, None, shingle, distance).where("kept").select(
        *[F.col("row")[c].alias(c) for c in df.columns])
