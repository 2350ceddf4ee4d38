"""Byte-level BPE: ids against the tiktoken library, decoding as a round trip."""

import hashlib
import random

import numpy as np
import pytest
import regex

import public_tokenizers
from bomspark.llm import bytebpe as B
from bomspark.llm import queries
from helpers import documents

PATHS = [public_tokenizers.path(f"{n}.tiktoken") for n in ("byte_bpe_50k", "byte_bpe_multi_50k")]


def library(path):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=B.read_ranks(path), special_tokens={})


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_the_pattern_is_the_vocabularys():
    assert B.PATTERN == public_tokenizers.PATTERN


@pytest.mark.parametrize("path", PATHS)
def test_random_texts_encode_as_the_library_does_and_decode_to_themselves(path):
    rnd, own, want = random.Random(3), B.codec(path), library(path)
    words = ["don't", "we'll've", " the", "  ", "\r\n", "naïve", "日本語", "1234½", "🙂👩‍🚀", "\x00\x1c", "é",
             "<|endoftext|>", "<s>", "<unknown>", " ", " ", "▁", "ÀĀ"]
    def char():
        return chr(rnd.choice((rnd.randrange(32, 127), rnd.randrange(0x250), rnd.randrange(0xD800),
                               rnd.randrange(0xE000, 0x20000), rnd.randrange(0x20000, 0x110000))))
    texts = ["".join(rnd.choice((*words, char(), char())) for _ in range(rnd.randrange(30)))
             for _ in range(4000)]
    for text, raw in zip(texts, own.encode(texts)):
        assert ids_of(raw) == want.encode_ordinary(text)
        assert own.decode(raw) == text.encode()


def test_characters_of_newer_unicode_are_cut_as_the_library_cuts():
    """Letters and numbers that only one of the two engines knows."""
    own, want = B.codec(PATHS[0]), library(PATHS[0])
    letters = regex.compile(r"[\p{L}\p{N}]")
    newer = [chr(c) for c in range(0x250, 0x33480) if not 0xD800 <= c < 0xE000
             and letters.match(chr(c)) and not chr(c).isalnum()]
    texts = [f"a{c}b {c}{c} 1{c}2 {c}" for c in newer]
    assert [ids_of(r) for r in own.encode(texts)] == [want.encode_ordinary(t) for t in texts]


def test_every_token_is_itself_if_it_is_a_pre_token():
    """Also one that no merges lead to, as in a vocabulary with a token beside its parts."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abcd": 257}
    own = B.ByteBpe(ranks)
    assert own.whole.keys() == {b"abcd"}
    got = [ids_of(r) for r in own.encode(["abcd", "abcde", "ab", ""])]
    import tiktoken
    want = tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert got == [want.encode_ordinary(t) for t in ("abcd", "abcde", "ab", "")]
    assert got[0] == [257] and len(got[1]) == 4


def test_ranks_with_holes_and_vocabularies_without_bytes():
    ranks = {bytes([b]): 3 * b + 5 for b in range(256)} | {b"hi": 2000}
    own = B.ByteBpe(ranks)
    assert ids_of(own.encode(["hi!"])[0]) == [2000, 3 * ord("!") + 5]
    assert own.decode(own.encode(["hi ho"])[0]) == b"hi ho"
    with pytest.raises(ValueError):
        B.ByteBpe({b"a": 0})
    with pytest.raises(KeyError):
        own.decode(np.array([1], "<u4").tobytes())


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 50)
    monkeypatch.setattr(B, "_AT_ONCE", 20)
    own, want = B.ByteBpe(B.read_ranks(PATHS[0])), library(PATHS[0])
    texts = [f"word{i % 70} and{i}" for i in range(500)]
    assert [ids_of(r) for r in own.encode(texts)] == [want.encode_ordinary(t) for t in texts]
    assert len(own.known) <= 120 and len(own.before) <= 120


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 1_200_000 + "a", "\n" * 1_000_000,
                                  "ab1 " * 200_000, "é" * 100_000])
def test_very_long_runs(text):
    own = B.codec(PATHS[0])
    raw = own.encode([text])[0]
    assert own.decode(raw) == text.encode()
    if not text.startswith((" ", "\n")):            # the library fails on long blanks
        assert ids_of(raw) == library(PATHS[0]).encode_ordinary(text)


def expected(text):
    raw = np.array(library(PATHS[0]).encode_ordinary(text), "<u4").tobytes()
    return (len(raw) // 4, hashlib.sha256(raw).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_query_on_the_given_table(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in queries.byte_bpe(spark, SF_SMALL).collect()}
    assert got == {d: expected(t or "") for d, t in docs}


def test_null_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (5, " ")]
    frame = documents(spark, rows).selectExpr("doc_id", "text", "1 AS id", "2 AS input_ids")
    encoded = B.encode(frame, PATHS[0])
    assert encoded.columns == ["doc_id", "input_ids"]
    got = B.decode(encoded.selectExpr("*", "0 AS decoded"), PATHS[0]).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in got) == sorted(
        (i or 0, t or "") for i, t in rows)
    assert B.encode(documents(spark, []), PATHS[0]).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, input_ids binary")
    assert B.decode(null, PATHS[0]).collect()[0]["decoded"] is None
    broken = spark.sql("SELECT 1L AS doc_id, CAST(x'61FF62' AS STRING) AS text")
    assert bytes(B.decode(B.encode(broken, PATHS[0]), PATHS[0]).collect()[0]["decoded"]) \
        == "a�b".encode()
