"""MinHash near-duplicates against all pairs of full sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from tillwatch.llm import minhash as M
from tillwatch.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(docs, width, per_cent):
    sets = [(key, shingles(text, width)) for key, text in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = {}
    for n, (key, s) in enumerate(sets):
        seen = {}
        if key is not None:
            for value in s:
                for m in inverted.setdefault(value, []):
                    seen[m] = seen.get(m, 0) + 1
                inverted[value].append(n)
        for m, common in seen.items():
            if 100 * common >= per_cent * (len(s) + len(sets[m][1]) - common):
                parent[find(n)] = find(m)
    least = {}
    for n, (key, _) in enumerate(sets):
        if key is not None:
            least[find(n)] = min(least.get(find(n), key), key)
    return sorted(
        ((key, len(s), None if key is None else least[find(n)]) for n, (key, s) in enumerate(sets)), key=repr
    )


def got(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=repr)


def corpus(seed, originals=60):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    docs = []
    for _ in range(originals):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 8, 20, 60, 150, 400]))]
        if rng.random() < 0.4:
            words[len(words) // 2 : len(words) // 2] = passage
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, len(copy) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text = " ".join(copy)
            docs.append(text.upper() if rng.random() < 0.2 else text.replace(" ", rng.choice([" ", "  ", "\n", "\x0b"])))
    keys = list(range(len(docs)))
    rng.shuffle(keys)
    return list(zip(keys, docs, strict=True))


@pytest.mark.parametrize(("seed", "width", "per_cent"), [(1, 3, 85), (2, 5, 80), (3, 3, 85)])
def test_equals_all_pairs(spark, docs_of, seed, width, per_cent):
    docs = corpus(seed)
    assert got(M.near_duplicates(docs_of(*docs), width, per_cent / 100)) == brute(docs, width, per_cent)


def test_one_large_group(spark, docs_of, monkeypatch):
    """More near copies than a block holds, few of them linked with the first."""
    monkeypatch.setattr(M, "BLOCK", 16)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for key in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs.append((key, " ".join(words)))
    expected = brute(docs, 3, 85)
    assert 1 < len({c for _, _, c in expected}) < 100
    assert got(M.near_duplicates(docs_of(*docs), 3, 0.85)) == expected


def test_rows_of_every_kind(spark, docs_of):
    long_text = " ".join(f"w{i}" for i in range(40_000))
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two"), (8, "a b c"), (9, "A b\x0cc"),
        (10, long_text), (11, long_text + " end"), (None, "a b c"), (None, None), (12, "É b c"), (13, "é b c"), (14, "a b c"),
    ]
    df = docs_of(*docs).withColumns({"id": F.lit("clash"), "kept": F.lit("clash"), "component_id": F.lit("clash")})
    assert got(M.near_duplicates(df, 3, 0.85)) == brute(docs, 3, 85)
    assert M.near_duplicates(df.limit(0)).count() == 0
    assert M.one_of_each(df.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark, docs_of):
    docs = [*corpus(5, 20), (3, None), (None, "alone"), (None, "alone")]
    docs = [(k, t) for k, t in docs if k != 3] + [(3, None)] + [docs[0]]  # a repeated row
    df = docs_of(*docs)
    kept = M.one_of_each(df)
    assert kept.columns == df.columns
    expected = {c for k, n, c in brute(docs, 5, 80) if k is not None}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2


def test_sketch_estimates():
    rng = np.random.default_rng(3)
    for _ in range(50):
        size = int(rng.integers(1, 200))
        x = rng.integers(0, 2**63, size).astype(np.uint64)
        y = np.concatenate([x[: int(size * rng.random())], rng.integers(0, 2**63, int(rng.integers(1, 30))).astype(np.uint64)])
        x, y = np.unique(x), np.unique(y)
        pad = lambda s: np.concatenate([s[: M.SKETCH], np.full(max(0, M.SKETCH - len(s)), 2**64 - 1, np.uint64)])[None]
        union = np.unique(np.concatenate([x, y]))[: M.SKETCH]
        expected = sum(1 for v in union if v in x and v in y) / len(union)
        assert M._estimates(pad(x), pad(y))[0] == pytest.approx(expected)


def test_overlap_bound_holds_for_small_sets():
    """No set as similar as asked for shares fewer sketch values than the bound says."""
    rng = random.Random(8)
    for _ in range(3000):
        threshold = rng.choice([0.8, 0.85])
        size = rng.randrange(1, 64)
        x = {rng.random() for _ in range(size)}
        y = set(rng.sample(sorted(x), rng.randrange(int(0.7 * size), size + 1))) | {rng.random() for _ in range(rng.randrange(12))}
        if y and len(x & y) >= threshold * len(x | y):
            common = len(set(sorted(x)[: M.SKETCH]) & set(sorted(y)[: M.SKETCH]))
            assert common >= M.least_overlap(size, threshold)


def test_registered_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = by_id(QUERIES["op5_minhash_neardup"](spark, sf_dir))
    assert sorted(((k, r["n_shingles"], r["component_id"]) for k, r in found.items()), key=repr) == brute(docs, 3, 85)
