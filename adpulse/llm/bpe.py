"""Byte-level BPE: encoding by recursive DuckDB queries, decoding by ordered
aggregation.

Spark deals the texts to its partitions. In a partition texts are cut into
pieces by the pattern, and the pieces that its process has not seen before go
to DuckDB together. There a recursive query holds each piece's tokens; its
token positions, as rows with their right-hand neighbours, join the merge
table, and each piece contracts its leftmost pair of minimum rank, until no
pair of any piece has a rank. Ids are packed as little-endian unsigned 32-bit
integers. Decoding looks every id up in the vocabulary and aggregates a text's
pieces in the order of their positions.

A piece of more than 64 bytes takes a second query that contracts every
non-overlapping occurrence of the minimum-rank pair at once, from the left.
That is the same result as long as the new token can form no pair of lower
rank; where some token of lower rank begins or ends with it, only the leftmost
occurrence is contracted.

A piece of more than 512 bytes is cut into blocks, which are contracted like
pieces. Tokens in a row are what contraction gives if every two neighbours,
contracted again, stay as they are; so only the seams between blocks are
tried. Where one does not hold, the tokens around it are contracted again;
where that does not help either, the block behind it is, together with the
tokens before it, from the left to the right. Rounds and memory of a query
thus do not grow with the piece.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import packed, quoted, ship, unpacked

LONG_PIECE = 64          # bytes
BLOCK = 512              # bytes of a block of a longer piece
AROUND = 8               # tokens on each side of a seam that are contracted again
TEXT_AT_ONCE = 1 << 21   # characters of texts that are cut before a query
PIECES_AT_ONCE = 400_000
WORDS_AT_ONCE = 50_000   # pieces of one query
BLOCKS_AT_ONCE = 256     # blocks of one query
REMEMBERED = 120_000     # pieces of a generation; a process keeps the ids of two
TOKENS_AT_ONCE = 1 << 18

SHORT = """
    WITH RECURSIVE state(word, toks) USING KEY (word) AS (
        SELECT word, toks FROM pieces
        UNION
        SELECT s.word, list_concat(list_append(s.toks[:b.best % 4294967296 - 1], (b.best // 4294967296)::INTEGER),
                                   s.toks[b.best % 4294967296 + 2:])
        FROM state s JOIN (
            SELECT word, min(m.merged * 4294967296 + x.pos) AS best
            FROM (SELECT word, unnest(range(1, len(toks))) AS pos, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r FROM state) x
            JOIN merges m ON m.l = x.l AND m.r = x.r GROUP BY word) b ON s.word = b.word)
    SELECT word, toks FROM state ORDER BY word"""

LONG = """
    WITH RECURSIVE state(word, toks) USING KEY (word) AS (
        SELECT word, toks FROM pieces
        UNION
        (WITH pairs AS (
            SELECT x.word, x.pos, m.merged, m.safe
            FROM (SELECT word, unnest(range(1, len(toks))) AS pos, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r FROM state) x
            JOIN merges m ON m.l = x.l AND m.r = x.r),
        least AS (SELECT word, min(merged) AS merged FROM pairs GROUP BY word),
        found AS (
            SELECT p.*, row_number() OVER (PARTITION BY p.word ORDER BY p.pos) AS k
            FROM pairs p JOIN least USING (word, merged)),
        taken AS (
            SELECT word, pos, merged
            FROM (SELECT *, row_number() OVER (PARTITION BY word, pos - k ORDER BY pos) AS in_run FROM found)
            WHERE in_run % 2 = 1 AND (safe OR k = 1)),
        tokens AS (
            SELECT word, unnest(range(1, len(toks) + 1)) AS pos, unnest(toks) AS tok
            FROM state WHERE word IN (SELECT word FROM taken))
        SELECT t.word, list(coalesce(a.merged, t.tok) ORDER BY t.pos)
        FROM tokens t LEFT JOIN taken a ON a.word = t.word AND a.pos = t.pos
                      LEFT JOIN taken b ON b.word = t.word AND b.pos + 1 = t.pos
        WHERE b.word IS NULL GROUP BY t.word))
    SELECT word, toks FROM state ORDER BY word"""

DECODE = """
    SELECT text, list_aggregate(list_transform(ids, lambda i: pieces[i + 1]), 'string_agg', '') AS decoded
    FROM encoded, (SELECT list(piece ORDER BY i) AS pieces
                   FROM range((SELECT max(id) + 1 FROM vocabulary)) r(i) LEFT JOIN vocabulary v ON v.id = r.i) ORDER BY text"""


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, content.splitlines()))}


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int, bool]]:
    """(left, right, merged, safe) for every split of a token in two tokens;
    safe if no token of lower rank begins or ends with the merged one."""
    lowest: dict[bytes, int] = {}  # of the longer tokens that begin or end with it
    for token, rank in ranks.items():
        for part in itertools.chain((token[:i] for i in range(1, len(token))), (token[i:] for i in range(1, len(token)))):
            lowest[part] = min(rank, lowest.get(part, rank))
    rows = []
    for token, rank in ranks.items():
        safe = lowest.get(token, rank) >= rank
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                rows.append((ranks[token[:i]], ranks[token[i:]], rank, safe))
    return rows


class Codec:
    """One DuckDB connection with the merge table and the vocabulary."""

    def __init__(self, content: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(content)
        self.find = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self.seams: dict[tuple[int, int], bool] = {}

    def _table(self, name: str, **columns) -> None:
        import pyarrow as pa

        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    @cached_property
    def first(self) -> np.ndarray:
        """Id of each byte; the merge table is made along with it."""
        left, right, merged, safe = map(np.array, zip(*merge_table(self.ranks)))
        self._table("merges", l=left.astype(np.int32), r=right.astype(np.int32), merged=merged.astype(np.int64), safe=safe)
        return np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    @cached_property
    def vocabulary(self) -> int:
        """Size of the vocabulary, whose table is made along with it."""
        self._table("vocabulary", id=np.array(list(self.ranks.values()), dtype=np.int32), piece=[t.decode("latin-1") for t in self.ranks])
        return len(self.ranks)

    def _query(self, sql: str, name: str, keys: str, lists: str, counts: np.ndarray, values: np.ndarray):
        import pyarrow as pa

        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        self.db.register(name, pa.table({
            keys: np.arange(len(counts), dtype=np.int32),
            lists: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}))
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _merge(self, sql: str, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        starts = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        found = self._query(sql, "pieces", "word", "toks", np.array([len(w) for w in words]), starts)
        toks = found.column("toks").combine_chunks()
        at = toks.offsets.to_numpy()
        ids = toks.values.to_numpy().astype("<u4")
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[i] for i in ids.tolist())

    def _contracted(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of a block or so, equal ones once."""
        found: dict[bytes, np.ndarray] = {}
        for sql, own in ((SHORT, lambda w: len(w) <= LONG_PIECE), (LONG, lambda w: len(w) > LONG_PIECE)):
            some = [w for w in dict.fromkeys(words) if own(w)]
            for at in range(0, len(some), BLOCKS_AT_ONCE):
                part = some[at:at + BLOCKS_AT_ONCE]
                found.update(zip(part, (np.frombuffer(ids, dtype="<u4") for ids in self._merge(sql, part))))
        return [found[w] for w in words]

    def _hold(self, pairs: list[tuple[int, int]]) -> list[bool]:
        """Whether two neighbouring tokens, contracted again, stay as they are."""
        new = [p for p in dict.fromkeys(pairs) if p not in self.seams]
        if len(self.seams) > REMEMBERED:
            self.seams = {}
            new = list(dict.fromkeys(pairs))
        for (a, b), ids in zip(new, self._contracted([self.tokens[a] + self.tokens[b] for a, b in new])):
            self.seams[a, b] = ids.tolist() == [a, b]
        return [self.seams[p] for p in pairs]

    def _blocks(self, raw: bytes) -> bytes:
        """Packed ids of a piece that is longer than a block."""
        parts = self._contracted([raw[k:k + BLOCK] for k in range(0, len(raw), BLOCK)])
        hold = self._hold([(int(a[-1]), int(b[0])) for a, b in zip(parts, parts[1:])])
        # around each seam that does not hold: of two near seams every other one at a time
        for odd in (0, 1):
            open_seams = [k for k, ok in enumerate(hold) if not ok and k % 2 == odd]
            zones = [(k, min(AROUND, len(parts[k]) - 1), min(AROUND, len(parts[k + 1]) - 1)) for k in open_seams]
            zones = [(k, i, j) for k, i, j in zones if i > 0 and j > 0]
            again = self._contracted([self._bytes(np.concatenate([parts[k][-i:], parts[k + 1][:j]])) for k, i, j in zones])
            outer = self._hold([(int(parts[k][-i - 1]), int(z[0])) for (k, i, _), z in zip(zones, again)])
            inner = self._hold([(int(z[-1]), int(parts[k + 1][j])) for (k, _, j), z in zip(zones, again)])
            for (k, i, j), zone, a, b in zip(zones, again, outer, inner):
                if a and b:
                    parts[k], parts[k + 1], hold[k] = np.concatenate([parts[k][:-i], zone]), parts[k + 1][j:], True
        out = [parts[0]]
        for k, part in enumerate(parts[1:]):
            last = out[-1]
            if not hold[k] or not self._hold([(int(last[-1]), int(part[0]))])[0]:
                kept = max(0, len(last) - AROUND)
                while True:  # the tail of what is done and the whole next block, until the seam before them holds
                    redone = self._contracted([self._bytes(np.concatenate([last[kept:], part]))])[0]
                    if kept == 0 and len(out) > 1:
                        out.pop()
                        last = np.concatenate([out[-1], last])
                        kept = max(0, len(out[-1]) - AROUND)
                    elif kept == 0 or self._hold([(int(last[kept - 1]), int(redone[0]))])[0]:
                        break
                    else:
                        kept = max(0, kept - AROUND)
                out[-1], part = last[:kept], redone
                if not kept:
                    out.pop()
            out.append(part)
        return np.concatenate(out).astype("<u4").tobytes()

    def learn(self, pieces: Iterable[str]) -> None:
        """Ids of the pieces that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        short, long = [], []
        for piece in set(pieces).difference(self.known):
            if piece in self.older:
                self.known[piece] = self.older[piece]
                continue
            raw = piece.encode()
            if raw in self.ranks:
                self.known[piece] = self.ranks[raw].to_bytes(4, "little")
            elif len(raw) > BLOCK:
                self.known[piece] = self._blocks(raw)
            else:
                (short if len(raw) <= LONG_PIECE else long).append((piece, raw))
        for sql, some in ((SHORT, short), (LONG, long)):
            for at in range(0, len(some), WORDS_AT_ONCE):
                part = some[at:at + WORDS_AT_ONCE]
                self.known.update(zip([p for p, _ in part], self._merge(sql, [raw for _, raw in part])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        out, at = [], 0
        while at < len(texts):
            size, stop = 0, at
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= TEXT_AT_ONCE):
                size += len(texts[stop])
                stop += 1
            if size > TEXT_AT_ONCE:  # one very long text: a run of pieces at a time
                runs, packed_ids = (m.group() for m in self.find.finditer(texts[at])), []
                while run := list(itertools.islice(runs, PIECES_AT_ONCE)):
                    self.learn(run)
                    packed_ids.append(b"".join(map(self.known.__getitem__, run)))
                out.append(b"".join(packed_ids))
            else:
                cut = [self.find.findall(t) for t in texts[at:stop]]
                self.learn(itertools.chain.from_iterable(cut))
                out.extend(b"".join(map(self.known.__getitem__, pieces)) for pieces in cut)
            at = stop
        return out

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Bytes of each run of packed ids."""
        runs, owner = [], []
        for k, ids in enumerate(encoded):
            for at in range(0, len(ids), 4 * TOKENS_AT_ONCE):
                runs.append(np.frombuffer(ids[at:at + 4 * TOKENS_AT_ONCE], dtype="<u4").astype(np.int32))
                owner.append(k)
        out = [b""] * len(encoded)
        at = 0 if self.vocabulary else len(runs)
        while at < len(runs):
            size, stop = 0, at
            while stop < len(runs) and (stop == at or size + len(runs[stop]) <= TOKENS_AT_ONCE):
                size += len(runs[stop])
                stop += 1
            found = self._query(DECODE, "encoded", "text", "ids", np.array([len(r) for r in runs[at:stop]]), np.concatenate(runs[at:stop]))
            for k, text in zip(owner[at:stop], found.column("decoded").to_pylist()):
                out[k] += (text or "").encode("latin-1")
            at = stop
        return out


@lru_cache(maxsize=2)
def codec(content: bytes, pattern: str) -> Codec:
    return Codec(content, pattern)


def read_file(path: str) -> bytes:
    """The vocabulary file, about 1 MB, read once and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, vocabulary: bytes, pattern: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``ids`` (binary: little-endian
    unsigned 32-bit ids) and ``n_tokens``.

    A null text counts as empty and an empty text has no ids. Texts of any
    length are encoded whole, pieces of any length in blocks. Repeated rows
    each get their ids; an empty table stays empty with the two columns. Input
    columns that have an output's name give way to it.
    """
    @F.pandas_udf("binary")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(vocabulary, pattern)
        for texts in batches:
            yield pd.Series(own.encode([t or "" for t in texts]), dtype=object)

    ship(df.sparkSession)
    rows = packed(df, ids_of(quoted(text_col)).alias("ids"))
    return unpacked(rows, df.columns, {"ids": F.col("ids"), "n_tokens": (F.octet_length("ids") / 4).cast("long")})


def decode(df: DataFrame, vocabulary: bytes, pattern: str, ids_col: str = "ids") -> DataFrame:
    """All rows and columns of ``df`` with ``decoded`` (binary); null and empty
    ids decode to nothing. Repeated rows are decoded each, an empty table stays
    empty, and an input column ``decoded`` gives way."""
    @F.pandas_udf("binary")
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(vocabulary, pattern)
        for ids in batches:
            yield pd.Series(own.decode([x or b"" for x in ids]), dtype=object)

    ship(df.sparkSession)
    rows = packed(df, bytes_of(quoted(ids_col)).alias("decoded"))
    return unpacked(rows, df.columns, {"decoded": F.col("decoded")})


def encode_and_decode(df: DataFrame, vocabulary: bytes, pattern: str, text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: all rows and columns of ``df``
    with ``ids``, ``n_tokens`` and ``decoded``; nulls, empty and long texts,
    repeated rows, empty tables and clashing names as there. Nothing is written
    between the two, and a task needs one Python worker."""
    ship(df.sparkSession)

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(vocabulary, pattern)
        for texts in batches:
            ids = own.encode([t or "" for t in texts])
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(own.decode(ids), dtype=object)})

    rows = packed(df, both(quoted(text_col)).alias("b"))
    return unpacked(rows, df.columns, {"ids": F.col("b.ids"), "n_tokens": (F.octet_length("b.ids") / 4).cast("long"), "decoded": F.col("b.decoded")})
