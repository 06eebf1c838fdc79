"""Byte-level BPE against the tokenizer library, and the round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)


def texts():
    rng = random.Random(5)
    bits = ["a", "b", " ", "  ", "\n", "\t", " ", "é", "日", "本", "1", "२", "'s", "'LL", "!", "?", "\x1c", "\x1e", "\x85", "​",
            "𝒳", "😀", "ࡰ", "\U0001df00", "th", "ing", "́", "　", "<|endoftext|>", "%%%"]
    every = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    out = [None, "", " ", "\n\n", "a" * 700, "ab" * 500, "".join(rng.choice("etaoinshr") for _ in range(900)), "a" * 5000]
    out += ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(500)]
    return out + ["".join(chr(c) + rng.choice(["", " ", "a"]) for c in rng.sample(every, 200)) for _ in range(200)]


def test_digests_equal_the_library(spark):
    given = texts()
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(given)
    for i, text in enumerate(given):
        ids = LIBRARY.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids), text
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest(), text


def test_held_words_change_no_id(spark, vocabulary):
    df = spark.createDataFrame([("thhe thha qqzx thhe", 1), ("thhe qqzx qqzx zzqj", 2)], "text string, doc_id long")
    none = {r.doc_id: r.ids for r in bpe.encode(df, vocabulary, cache=0).collect()}
    some = {r.doc_id: r.ids for r in bpe.encode(df, vocabulary, cache=2).collect()}
    many = {r.doc_id: r.ids for r in bpe.encode(df, vocabulary).collect()}
    assert none == some == many
    assert none[1] == LIBRARY.encode_ordinary("thhe thha qqzx thhe")


def test_most_frequent_words_are_held(spark, vocabulary):
    df = spark.createDataFrame([(" thhe" * 9 + " qqzx" * 3 + " zzqj",)], "text string")
    assert bpe.frequent_words(df, vocabulary, limit=1)["word"].to_pylist() == [" thhe"]
    assert set(bpe.frequent_words(df, vocabulary, limit=2)["word"].to_pylist()) == {" thhe", " qqzx"}


def test_extra_and_clashing_columns_repeats_and_empty_tables(spark, vocabulary):
    df = spark.createDataFrame([("a b", "x", "y", 1), ("a b", "x", "y", 1)], "text string, word string, n string, ids int")
    got = bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect()
    assert [r.ids for r in got] == [LIBRARY.encode_ordinary("a b")] * 2
    assert {(r.word, r.n, bytes(r.decoded)) for r in got} == {("x", "y", b"a b")}
    assert bpe.encode(df.limit(0), vocabulary).count() == 0


def test_decode_of_unknown_and_null_ids(spark, vocabulary):
    df = spark.createDataFrame([(1, [64]), (2, [50256]), (3, [-1]), (4, None), (5, []), (6, [None])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(df, vocabulary).collect()}
    assert got[1] == b"a" and got[5] == b"" and all(got[k] is None for k in (2, 3, 4, 6))


def test_vocabulary_must_hold_all_bytes(spark):
    with pytest.raises(ValueError):
        bpe.Vocabulary(spark, {b"a": 0, b"b": 1, b"ab": 2}, public_tokenizers.PATTERN)


def test_held_words_are_not_listed_in_the_drivers_python(spark, vocabulary):
    import tracemalloc

    df = spark.createDataFrame([(" thhe" * 9 + " qqzx" * 3 + " zzqj",)], "text string")
    tracemalloc.start()
    bpe.encode(df, vocabulary)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18e6, peak


def test_no_literal_holds_all_characters_or_the_held_words(spark, vocabulary, monkeypatch):
    given, lit = [], bpe.F.lit
    monkeypatch.setattr(bpe.F, "lit", lambda value: given.append(value) or lit(value))
    assert bpe.java_pattern(spark, public_tokenizers.PATTERN) == vocabulary.java
    df = spark.createDataFrame([(" thhe" * 9 + " qqzx" * 3 + " zzqj",)], "text string")
    got = bpe.encode(df, vocabulary).first()["ids"]
    assert got == LIBRARY.encode_ordinary(df.first()["text"])
    texts = [value for value in given if isinstance(value, str)]
    assert not [t for t in texts if len(t) > 1_000_000 and bpe.MARK not in t], "a text of all characters"
    assert not [t for t in texts if bpe.ENTRY * 2 in t], "held words"
