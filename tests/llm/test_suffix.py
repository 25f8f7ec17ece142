"""Suffix-array deduplication against a table of all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from tillwatch.llm import suffix_dedup as S
from tillwatch.llm.queries import QUERIES


def brute(texts, length=200):
    """Bytes kept, bytes removed and runs of each text."""
    data = [(t or "").encode() for t in texts]
    often = Counter(hash(d[i : i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if often[hash(d[i : i + length])] > 1:
                gone[i : i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(d, gone.tolist(), strict=False) if not g)
        out.append((kept, len(d) - len(kept), runs))
    return out


def check(df, docs, **options):
    expected = sorted(((k, *b) for (k, _), b in zip(docs, brute([t for _, t in docs]), strict=True)), key=repr)
    rows = S.without_repeats(df, **options).collect()
    assert sorted(((r["doc_id"], bytes(r["_kept"]), r["_n_removed"], r["_n_spans"]) for r in rows), key=repr) == expected
    for r in rows:
        assert r["_kept_text"] == bytes(r["_kept"]).decode("utf-8", "ignore")


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab" * 9, b"\x00", b"\xff", b"abcab" * 5, b"x"]), min_size=1, max_size=25))
def test_suffix_arrays_and_common_prefixes(parts):
    text = b"".join(parts)
    data = np.frombuffer(text, np.uint8)
    order, ranks = S.suffix_array(data)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert ranks[order].tolist() == list(range(len(text)))
    common = S.common_prefixes(data, order, ranks, 30)
    for a, b in zip(order.tolist(), order.tolist()[1:], strict=False):
        same = 0
        while same < 30 and max(a, b) + same < len(text) and text[a + same] == text[b + same]:
            same += 1
        assert common[b] == same


def corpus(seed, count=60):
    rng = random.Random(seed)
    letters = "abcdefghij \né中"
    noise = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [noise(n) for n in (150, 198, 199, 200, 201, 260, 400, 700)]
    texts = []
    for _ in range(count):
        parts = [noise(rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(passages), noise(rng.randrange(0, 250))]
        texts.append("".join(parts))
    texts += [texts[0], texts[1] * 2, "a" * 199, "b" * 200, "c" * 201, "d" * 1000, "xy" * 300]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_strings(spark, docs_of, seed):
    docs = corpus(seed)
    check(docs_of(*docs), docs)


def test_several_shards_of_a_gram_are_merged(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 1500)
    docs = corpus(3)
    check(docs_of(*docs), docs)


def test_crowded_grams_are_counted_by_digest(spark, docs_of):
    docs = corpus(4)
    check(docs_of(*docs), docs, gram_stretches=2)


def test_long_texts_are_cut_into_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 500)
    docs = corpus(5)
    check(docs_of(*docs), docs)


def test_pieces_hold_each_string_once():
    rng = random.Random(7)
    text = bytes(rng.choice(b"abc") for _ in range(3000))
    whole = dict.fromkeys(range(len(text) - 199))
    for most in (300, 512, 10_000):
        seen = []
        for numbers, firsts, pieces in S.text_pieces([b"short", text], 200, most):
            piece, grams, first, last = S.chosen_grams(pieces, 200)
            for p, g, a, b in zip(piece.tolist(), grams.tolist(), first.tolist(), last.tolist(), strict=True):
                assert numbers[p] == 1
                seen += [(firsts[p] + i, g) for i in range(a, b + 1)]
        assert sorted(i for i, _ in seen) == list(whole)
        whole = whole if most > 300 and whole[0] is not None else dict(seen)
        assert dict(seen) == whole  # the gram of a string does not depend on the cuts


def test_shard_search():
    rng = random.Random(6)
    stretches = [bytes(rng.choice(b"ab") for _ in range(220)) for _ in range(30)]
    shard = S.Shard(stretches[:20], 200)
    queries = np.stack([np.frombuffer(s[7:207], np.uint8) for s in stretches])
    assert shard.holds(queries).tolist() == [True] * 20 + [False] * 10


@pytest.mark.parametrize("length", [3, 5, 12, 200])
def test_refinement_ends_at_the_length_of_a_string(length):
    """Ranks of strings, and which repeat, without sorting suffixes any deeper."""
    rng = random.Random(8)
    passages = [bytes(rng.choice(b"ab") for _ in range(length + 40)) for _ in range(4)]
    stretches = [b"x" * (3 * length), *(rng.choice(passages)[k : length + 2 * k] for k in range(20) for _ in range(2))]
    shard = S.Shard(stretches, length)
    strings = {a + k: s[k : k + length] for a, s in zip(shard.starts, stretches, strict=True) for k in range(len(s) - length + 1)}
    often = Counter(strings.values())
    assert {p for p, s in strings.items() if often[s] > 1} == set(np.flatnonzero(shard.repeated).tolist())
    ranks, repeated = S.string_ranks(shard.data, shard.left, length)
    assert sorted(repeated.tolist()) == np.flatnonzero(shard.repeated).tolist()
    assert len({(s, int(ranks[p])) for p, s in strings.items()}) == len(often) == len({int(ranks[p]) for p in strings})
    assert [strings[p] for p in shard.order.tolist()] == sorted(strings.values())


def test_texts_meet_their_runs_in_any_batch(spark, docs_of):
    """Equal rows, documents whose runs fill several batches, and grams whose stretches all occur as a whole elsewhere."""
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(6000))
    docs = [(1, long), (1, long), (1, long), (2, long[:3000]), (2, long[3000:]), (3, "z" + long[1000:1500]), (3, "z" + long[1000:1500]), (4, None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(docs_of(*docs), docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_of_every_kind(spark, docs_of):
    same = "shared passage " * 20 + "tail"
    docs = [
        (1, None), (2, ""), (3, "short"), (4, same), (4, same), (None, "null id " + same), (None, "null id " + same), (5, "x" * 5000),
        (6, "中" * 300), (7, "a" + "中" * 300), (8, "lone " * 10),
    ]
    df = docs_of(*docs).withColumns({"k1": F.lit("clash"), "row": F.lit("clash"), "_kept": F.lit("clash"), "spans": F.lit(1)})
    check(df, docs)
    out = S.without_repeats(df)
    assert {"k1", "row", "spans", "lang"} <= set(out.columns)
    assert S.without_repeats(df.limit(0)).count() == 0


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = by_id(QUERIES["op3_suffix_dedup"](spark, sf_dir))
    for r, (kept, removed, runs) in zip(docs, brute([r["text"] for r in docs]), strict=True):
        row = found[r["doc_id"]]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len((r["text"] or "").encode()), removed, runs)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
