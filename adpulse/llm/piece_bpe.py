"""SentencePiece encoding (models of the merge type) by backtracking, and decoding.

A merge-type model joins the adjacent pair of best score, the leftmost of
equals, until no pair is a piece. A run of pieces is what it gives exactly if
every piece gives itself and every two neighbours, merged again from single
characters, give the two of them. So a text is encoded from left to right: an
Aho-Corasick automaton finds the longest piece at every position; a piece is
taken if it fits behind the one before and its end has not failed yet; else
the next shorter piece that begins there is tried; where none is left, the
position is marked in a bitfield of failed positions and the piece before is
taken back. No position is left twice, so the work is linear in the text.

Spark deals the texts to its partitions. A text is cut where no piece of the
model can lie across (between letters and other characters, before spaces),
and a process remembers the ids of the chunks it has seen last.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import packed, quoted, ship, unpacked

SPACE = "▁"  # how a model writes a space (fixed value of the format)
# From the finest cut to none; a model takes the first that divides none of its pieces.
CUTS = (rf"{SPACE}*(?:\p{{L}}+|[^\p{{L}}{SPACE}]+)|{SPACE}+", rf"{SPACE}*[^{SPACE}]+|{SPACE}+", r"(?s:.+)")
REMEMBERED = 200_000       # chunks of at most LONG_CHUNK characters, twice
REMEMBERED_PAIRS = 500_000
LONG_CHUNK = 64
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types (fixed values of the format)


class Model:
    """What encoding and decoding need of a model file; made once on the driver."""

    def __init__(self, content: bytes):
        import regex
        from sentencepiece import sentencepiece_model_pb2 as format

        spec = format.ModelProto()
        spec.ParseFromString(content)
        norm, kinds = spec.normalizer_spec, {p.type for p in spec.pieces}
        if spec.trainer_spec.model_type != format.TrainerSpec.BPE or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a merge-type model of normal, control and byte pieces")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model rewrites its texts, which is not built")
        if not spec.trainer_spec.byte_fallback:
            raise ValueError("the model has no pieces for single bytes")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.surface = [b"" if p.type == CONTROL else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
                        else p.piece.replace(SPACE, " ").encode() for p in spec.pieces]
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        # a piece that merging does not give can stand in no result
        self.reachable = [p for p in self.ids if self.merged(p) == [p]]
        cuts = [regex.compile(cut) for cut in CUTS]
        self.cut = next(cut for cut in cuts if all(cut.fullmatch(p) for p in self.ids))

    def merged(self, text: str) -> list[str]:
        """The merges as the model states them, for texts of two pieces at most."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Codec:
    """The automaton and the memories of one process."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        # characters inside pieces stand for themselves, too, if only as bytes
        self.pieces = sorted(set(model.reachable).union(*model.reachable))
        number = {p: k for k, p in enumerate(self.pieces)}
        self.automaton = ahocorasick.Automaton()
        for piece, k in number.items():
            self.automaton.add_word(piece, (len(piece) - 1, k))
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.pieces]
        self.shorter = [next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in self.pieces]
        self.out = [self._ids_of(p) for p in self.pieces]
        offsets = np.cumsum([0] + [len(s) for s in model.surface])
        self.starts, self.sizes = offsets[:-1], np.diff(offsets)
        self.bytes = np.frombuffer(b"".join(model.surface), dtype=np.uint8)
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def _ids_of(self, piece: str) -> list[int]:
        own = self.model.ids.get(piece)
        return [self.model.byte_ids[b] for b in piece.encode()] if own is None else [own]

    def _fit(self, a: int, b: int) -> bool:
        """Whether two neighbours, merged again from characters, stay as they are."""
        left, right = self.pieces[a], self.pieces[b]
        if len(self.fits) >= REMEMBERED_PAIRS:
            self.fits.clear()
        ok = self.fits[a, b] = self.model.merged(left + right) == [left, right]
        return ok

    def _backtrack(self, chunk: str, longest: list[int]) -> list[int]:
        """Pieces of a chunk in which every position begins some piece."""
        length, shorter, fits = self.length, self.shorter, self.fits
        end, at, taken = len(chunk), 0, []
        failed = bytearray(end // 8 + 1)
        piece, last = longest[0], -1
        while True:
            while piece >= 0:
                stop = at + length[piece]
                if not failed[stop >> 3] >> (stop & 7) & 1:
                    ok = True if last < 0 else fits.get((last, piece))
                    if ok or ok is None and self._fit(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                if stop == end:
                    return taken
                at, last, piece = stop, piece, longest[stop]
            else:  # nothing fits from here: another end for the piece before
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= length[piece]
                last = taken[-1] if taken else -1

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk, cut further at characters that no piece has."""
        longest = [-1] * len(chunk)
        for stop, (back, piece) in self.automaton.iter(chunk):
            longest[stop - back] = piece  # later ends are longer
        ids, at = [], 0
        while at < len(chunk):
            if longest[at] < 0:
                ids += self._ids_of(chunk[at])
                at += 1
                continue
            try:
                stop = longest.index(-1, at)
            except ValueError:
                stop = len(chunk)
            whole = at == 0 and stop == len(chunk)
            for piece in self._backtrack(chunk if whole else chunk[at:stop], longest if whole else longest[at:stop]):
                ids += self.out[piece]
            at = stop
        return ids

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        for match in self.model.cut.finditer(self.model.prefix + text.replace(" ", SPACE)):
            chunk = match.group()
            found = self.known.get(chunk)
            if found is None:
                found = self.older.get(chunk) or self._chunk(chunk)
                if len(chunk) <= LONG_CHUNK:
                    if len(self.known) >= REMEMBERED:
                        self.older, self.known = self.known, {}
                    self.known[chunk] = found
            ids += found
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of ids: their surfaces in order, the prefix taken off; bytes
        that are no UTF-8 become replacement characters."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        raw = self.bytes[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()
        if self.model.prefix and self.model.surface[ids[0]][:1] == b" ":
            raw = raw[1:]
        return raw


@lru_cache(maxsize=2)
def model_of(content: bytes) -> Model:
    return Model(content)


_codecs: dict[int, Codec] = {}


def _codec(content: bytes) -> Codec:
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model_of(content))
    return _codecs[key]


def read_file(path: str) -> bytes:
    """The model file, about 0.5 MB, read once and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def _ids(model: bytes, text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _codec(model)
        for texts in batches:
            offsets, parts = [0], []
            for text in texts:
                parts.append(np.array(own.encode(text.as_py() or ""), dtype=np.int32))
                offsets.append(offsets[-1] + len(parts[-1]))
            flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(flat))

    return ids_of(text)


def _decoded(model: bytes, ids: Column) -> Column:
    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _codec(model)
        for lists in batches:
            texts = []
            for one in lists:
                found = np.zeros(0, dtype=np.int32) if one.values is None else one.values.to_numpy(zero_copy_only=False)
                texts.append(own.decode(found).decode(errors="replace"))
            yield pa.array(texts, type=pa.string())

    return text_of(ids)


def encode(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``ids`` (array of int) and
    ``n_tokens``, as the library's ``encode`` gives them without begin and end
    ids.

    A null text counts as empty; an empty text has no ids. Texts of any length
    are encoded whole, a run of letters of any length in linear time. Equal
    rows each get their ids; an empty table stays empty with the two columns.
    Input columns that have an output's name give way to it.
    """
    ship(df.sparkSession)
    rows = packed(df, _ids(model, quoted(text_col)).alias("ids"))
    return unpacked(rows, df.columns, {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long")})


def decode(df: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """All rows and columns of ``df`` with ``decoded``, as the library's
    ``decode`` of the ids gives it. Null and empty ids give the empty text; an
    empty table stays empty; an input column ``decoded`` gives way."""
    ship(df.sparkSession)
    rows = packed(df, _decoded(model, quoted(ids_col)).alias("decoded"))
    return unpacked(rows, df.columns, {"decoded": F.col("decoded")})
