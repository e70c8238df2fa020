import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from adpulse.llm import piece_bpe, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def content():
    return piece_bpe.read_file(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def samples(codec):
    rng = random.Random(2)
    signs = "abcdeinorst  \n\t.,;()-=_*#é日本\U0001F600▁²3%0\x00\x85́"
    pieces = list(codec.model.ids)
    for _ in range(1500):
        yield "".join(rng.choice(signs) for _ in range(rng.randrange(60)))
        yield "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        yield "".join(rng.choice(["in", "er", "the", "on", "s", " ", "  ", "_", "x"]) for _ in range(rng.randrange(1, 40)))
    yield from ("", " ", " " * 77 + "a", "x" * 4000, "<s>a</s><0x41><unk>", "\r\n" * 50, "²." * 9, "日本語" * 400)


def test_ids_and_texts_as_the_library_gives_them(content, library):
    codec = piece_bpe.Codec(piece_bpe.Model(content))
    for text in samples(codec):
        ids = codec.encode(text)
        assert ids == library.encode(text), text
        assert codec.decode(np.array(ids, dtype=np.int32)).decode(errors="replace") == library.decode(ids), text


@pytest.mark.parametrize("cut", piece_bpe.CUTS)
def test_every_cut_gives_the_same(content, library, cut):
    import regex
    model = piece_bpe.Model(content)
    model.cut = regex.compile(cut)
    codec = piece_bpe.Codec(model)
    for text in list(samples(codec))[-300:]:
        assert codec.encode(text) == library.encode(text), text


def test_failed_positions_are_taken_back(content, library):
    """The longest piece first is not always what merging gives."""
    codec = piece_bpe.Codec(piece_bpe.Model(content))
    other = 0
    for word in {w for text in samples(codec) for w in text.split() if w.isalpha() and w.isascii()}:
        ids = codec.encode(word)
        longest = max((n for n in range(len(word) + 1) if "▁" + word[:n] in codec.model.ids))
        other += ids[0] != codec.model.ids["▁" + word[:longest]]
        assert ids == library.encode(word)
    assert other > 0


def test_very_long_runs(content, library):
    codec = piece_bpe.Codec(piece_bpe.Model(content))
    rng = random.Random(5)
    for text in ("x" * 1_000_000, "".join(rng.choice("abcdefghijklmnop") for _ in range(100_000)), " " * 100_000):
        assert codec.encode(text) == library.encode(text)


def test_small_memories(content, library, monkeypatch):
    for name in ("REMEMBERED", "REMEMBERED_PAIRS", "LONG_CHUNK"):
        monkeypatch.setattr(piece_bpe, name, 3)
    codec = piece_bpe.Codec(piece_bpe.Model(content))
    for text in list(samples(codec))[:200]:
        assert codec.encode(text) == library.encode(text)


def test_table_of_odd_rows(odd, none, content, library):
    encoded = piece_bpe.encode(odd, content)
    rows = piece_bpe.decode(encoded, content).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = library.encode(r.text or "")
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == library.decode(want)
    empty = piece_bpe.decode(piece_bpe.encode(none, content), content)
    assert empty.count() == 0 and {"ids", "n_tokens", "decoded"} <= set(empty.columns)
    nulls = odd.sparkSession.sql("SELECT CAST(NULL AS array<int>) AS ids")
    assert piece_bpe.decode(nulls, content).first().decoded == ""


def test_registered_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_sentencepiece(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
