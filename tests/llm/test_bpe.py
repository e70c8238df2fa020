import random
import struct

import public_tokenizers
import pytest
import tiktoken

from adpulse.llm import bpe


@pytest.fixture(scope="module")
def content():
    return bpe.read_file(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(content):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(content), special_tokens={})
    return lambda text: struct.pack(f"<{len(encoding.encode_ordinary(text))}I", *encoding.encode_ordinary(text))


def samples():
    rng = random.Random(1)
    letters = ["".join(rng.choice("the and in of oni ") for _ in range(rng.randrange(1, 400))).replace(" ", "") for _ in range(40)]
    mixed = ["".join(rng.choice("aé日 \n\t.,!1 \x85\xa0\x1c'st") for _ in range(200)) for _ in range(40)]
    return letters + mixed + ["", " ", "a" * 5000, " " * 3001 + "x", "\n" * 777, "ab" * 3000, "日本語" * 300, "!?#$%" * 500,
                              "don't we'll  x\t\ty", "\U0001F600" * 200, "<|endoftext|>", "Ünïcödé 123456789012" * 50]


def test_ids_and_bytes_as_the_library_gives_them(content, reference):
    codec = bpe.Codec(content, public_tokenizers.PATTERN)
    texts = samples()
    ids = codec.encode(texts)
    assert ids == [reference(t) for t in texts]
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_a_text_beyond_one_batch(content, reference, monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_AT_ONCE", 100)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "TOKENS_AT_ONCE", 5)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(content, public_tokenizers.PATTERN)
    texts = ["one two three " * 40, "short", "four five"]
    ids = codec.encode(texts)
    assert ids == [reference(t) for t in texts] and codec.decode(ids) == [t.encode() for t in texts]


def long_pieces(letters=3000):
    rng = random.Random(6)
    yield from ("x" * 4001, "e" * 4999, "abc" * 1501, "haha" * 999, "the" * 1777, "日本" * 700, "=-" * 1500, " " * 3333, "0" * 3001, "-" * 2999)
    for signs in ("abcdefghijklmnopqrstuvwxyz", "etaoin", "ab", "éèaβ"):
        yield "".join(rng.choice(signs) for _ in range(letters))


@pytest.mark.parametrize("block, around", [(512, 8), (30, 2), (7, 1)])
def test_long_pieces_in_blocks(content, reference, monkeypatch, block, around):
    """Small blocks and zones leave many seams to the way from left to right."""
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "AROUND", around)
    codec = bpe.Codec(content, public_tokenizers.PATTERN)
    texts = list(long_pieces(3000 if block > 100 else 300))
    ids = codec.encode(texts)
    assert [t[:20] for t, got in zip(texts, ids) if got != reference(t)] == [] and codec.decode(ids) == [t.encode() for t in texts]


def test_pieces_of_millions(content, reference):
    codec = bpe.Codec(content, public_tokenizers.PATTERN)
    rng = random.Random(7)
    for text in ("x" * 4_000_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))):
        assert codec.encode([text]) == [reference(text)]


def test_ids_with_gaps_decode():
    codec = bpe.Codec(b"YQ== 3\nYg== 7\nYWI= 9\n", ".")
    assert codec.decode([struct.pack("<3I", 3, 9, 7), b""]) == [b"aabb", b""]


def test_leftmost_rank_that_a_merge_may_lower():
    """A merge whose token begins one of lower rank is contracted one by one."""
    ranks = {bytes([b]): b for b in range(256)} | {b"aba": 256, b"ab": 257}
    rows = {m: safe for *_, m, safe in bpe.merge_table(ranks)}
    assert rows[257] is False and rows[256] is True


def test_table_of_odd_rows(odd, none, content, reference):
    encoded = bpe.encode(odd, content, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, content, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd.count()
    for r in rows:
        want = reference(r.text or "")
        assert bytes(r.ids) == want and r.n_tokens == len(want) // 4 and bytes(r.decoded) == (r.text or "").encode()
    at_once = bpe.encode_and_decode(odd, content, public_tokenizers.PATTERN)
    assert sorted(map(str, at_once.select(encoded.columns).collect())) == sorted(map(str, encoded.collect()))
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in at_once.collect())
    assert bpe.encode(none, content, public_tokenizers.PATTERN).count() == 0
