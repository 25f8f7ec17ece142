"""Token counts and the byte-level codec against the libraries."""

from __future__ import annotations

import hashlib
import random
import struct
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import by_id
from tillwatch.llm.bpe_codec import Codec, decode_ids, encode_texts, read_ranks
from tillwatch.llm.pretokens import splitter
from tillwatch.llm.queries import QUERIES
from tillwatch.llm.token_counts import TokenCounter, count_tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

ODD = [
    "", " ", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", "aaaaaaaaaaaaaaa", "\x1c\x1d \x85  x\u200b",
    "h\u00e9llo w\u00f6rld 12 \u00bd \u00b2 \u2167", "\u4e2d\u6587\u5b57\u7b26 \n\n  x", "ab" * 4000, "'s 'S don't",
    "\x00\x01", "\U0001f600" * 7, "\u01c5 \u02b0 \u00aa", "\t\t  \r\n x  ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(JSON, PATTERN)


@pytest.fixture(scope="module")
def codec():
    return Codec(RANKS, PATTERN)


def random_texts():
    random.seed(7)
    ranges = [(32, 127), (1, 256), (1, 0x3000), (0x10000, 0x1F000)]
    return ["".join(chr(random.randrange(*random.choice(ranges))) for _ in range(60)) for _ in range(300)]


def test_counts_equal_the_library(counter, library):
    texts = ODD + random_texts()
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.counts(texts) == expected


@settings(max_examples=150, deadline=None)
@given(st.text())
def test_any_text(text):
    counter, codec = TokenCounter_cached(), Codec_cached()
    ids = codec.encode([text])[0]
    assert codec.decode(ids) == text.encode("utf-8", "surrogatepass")
    if "<|" not in text:
        assert counter.counts([text]) == [len(ids) // 4]


_made: dict = {}


def TokenCounter_cached():
    return _made.setdefault("t", TokenCounter(JSON, PATTERN))


def Codec_cached():
    return _made.setdefault("c", Codec(RANKS, PATTERN))


def test_ids_equal_the_library(codec, encoding):
    texts = ODD + random_texts()
    expected = [struct.pack(f"<{len(i)}I", *i) for i in map(encoding.encode_ordinary, texts)]
    assert codec.encode(texts) == expected


def test_both_splitters_agree():
    import regex

    split = splitter(PATTERN)
    for text in ODD + random_texts() + ["".join(map(chr, range(256))) * 2]:
        assert split(text) == regex.findall(PATTERN, text)


def test_rows_of_every_kind(spark, docs_of, library, encoding):
    docs = docs_of(
        (1, None), (2, ""), (3, "some text"), (3, "some text"), (None, "no id"), (4, "x" * 300_000), (5, "word " * 50_000)
    )
    docs = docs.withColumns({"n_tokens": F.lit("clash"), "_text": F.lit("clash"), "ids": F.lit("clash")})
    counted = count_tokens(docs, JSON, PATTERN).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"]) for r in counted) == sorted(
        (r["doc_id"] or 0, len(r["text"] or "")) for r in docs.select("doc_id", "text").collect()
    )
    assert {r["doc_id"]: r["n_tokens"] for r in counted}[1] == 0
    long_text = {r["doc_id"]: r for r in counted}[5]
    assert long_text["over_limit"] and long_text["n_tokens"] == len(library.encode("word " * 50_000).ids)
    decoded = decode_ids(encode_texts(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in decoded) == sorted(
        (r["text"] or "").encode() for r in docs.select("text").collect()
    )
    empty = docs.limit(0)
    assert count_tokens(empty, JSON, PATTERN).count() == 0
    assert encode_texts(empty, RANKS, PATTERN).count() == 0


def test_registered_queries(spark, sf_dir, library, encoding):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = by_id(QUERIES["op2_token_counts"](spark, sf_dir))
    codes = by_id(QUERIES["op9_bpe_codec"](spark, sf_dir))
    assert set(counts) == set(codes) == set(texts)
    for key, text in texts.items():
        assert counts[key]["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert counts[key]["over_limit"] == (counts[key]["n_tokens"] > 1024)
        ids = encoding.encode_ordinary(text)
        assert codes[key]["n_tokens"] == len(ids)
        assert codes[key]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert codes[key]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def long_runs():
    chance = random.Random(11)
    for letters, size in (("abcdefghijklmnopqrstuvwxyz", 30_000), ("aab", 5_000), ("a", 4_097), ("éßж漢", 4_000), ("-", 9_000)):
        yield "".join(chance.choice(letters) for _ in range(size))


def test_long_runs_equal_the_libraries(counter, codec, library, encoding):
    for text in long_runs():
        assert counter.counts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]
        ids = encoding.encode_ordinary(text)
        assert codec.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids)]


@pytest.mark.parametrize("long_bytes, in_step", [(0, 1), (0, 10**9), (7, 3)])
def test_every_way_of_merging_gives_the_same(monkeypatch, library, encoding, long_bytes, in_step):
    """Short pieces by the ways of long runs, and long ones in step."""
    monkeypatch.setattr("tillwatch.llm.token_counts.LONG_BYTES", long_bytes)
    monkeypatch.setattr("tillwatch.llm.bpe_codec.TreeMerger.IN_STEP", in_step)
    texts = [*ODD, *random_texts()]
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert TokenCounter(JSON, PATTERN).counts(texts) == expected
    ids = [encoding.encode_ordinary(t) for t in texts]
    assert Codec(RANKS, PATTERN).encode(texts) == [struct.pack(f"<{len(i)}I", *i) for i in ids]


def test_a_round_looks_up_new_pairs_only(counter, library, monkeypatch):
    """Two pairs at most for each merge, whatever the number of rounds; the counts are the library's."""
    chance = random.Random(13)
    words = ["".join(chance.choice("etaoinshrdlué") for _ in range(chance.randrange(1, 40))) for _ in range(500)]
    looked, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda keys, pairs, *more: looked.append(len(pairs)) or search(keys, pairs, *more))
    found = counter.merger.counts([w.encode() for w in words])
    assert found.tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in words]
    assert sum(looked) <= 2 * (sum(len(w.encode()) for w in words) - found.sum())


def test_memory_that_starts_anew_keeps_counts(library):
    """Words of a call are counted from the call's own table, also where the task's memory has just been dropped."""
    small = TokenCounter(JSON, PATTERN)
    small.known.most = 1
    texts = [*ODD, *random_texts()[:40]]
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert small.counts(texts) == small.counts(texts) == expected
    assert [n for t in texts for n in small.counts([t])] == expected and not small.known


def test_a_megabyte_without_a_break(counter, codec, encoding):
    """In a few passes' time: with whole passes it would take minutes."""
    chance = random.Random(12)
    text = "".join(chance.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    began = time.perf_counter()
    n_tokens = counter.counts([text])
    ids = codec.encode([text])[0]
    assert time.perf_counter() - began < 60
    expected = encoding.encode_ordinary(text)
    assert ids == struct.pack(f"<{len(expected)}I", *expected)
    assert n_tokens == [len(expected)]
