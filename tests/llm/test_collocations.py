from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillwatch.llm import collocations as col


def brute(rows, max_words=5, min_count=3, top=2000):
    """Collocations of (lang, text) rows, counted phrase by phrase."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            here = counts.setdefault(lang, Counter())
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    here[tuple(words[i : i + k])] += 1
    out = []
    for lang, here in counts.items():
        candidates = {p: a for p, a in here.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in candidates.items():
            cuts = [(1000 * a * total[lang] // (here[p[:c]] * here[p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            inside = any(
                len(q) > len(p) and f >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, f in candidates.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), here[p[:c]], here[p[c:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def made(df):
    return sorted(tuple(r) for r in df.collect())


ROWS = [
    (1, "New York, new york! NEW YORK\tis big. is big", "en"),
    (2, "a a a a a a a a. a a a", "en"),
    (3, None, "en"),
    (4, "", "fr"),
    (5, "... \t ,,", "fr"),
    (6, "x y z x y z x y z x y z", None),
    (7, "x y z", "und"),
    (8, "Ä b c d É; Ä b c d É\x0cÄ b c d É\x00 \x1c", "de"),
    (None, "x y z x y z", None),
    (1, "new york is big", "en"),
]


def test_small_texts(docs_of):
    rows = ROWS + [(1, "new york is big", "en")]
    got = made(col.collocations(docs_of(*rows), min_count=3))
    assert got == brute([(r[2], r[1]) for r in rows])
    assert any(g[2] == "new york" for g in got) and any(g[0] == "und" for g in got)


@pytest.mark.parametrize("modulus,longest", [(1, 4096), (3, 4096), (64, 7), (1 << 40, 4096)])
def test_random_texts_any_parse(docs_of, modulus, longest):
    rng = random.Random(7)
    words = ["the", "of", "and", "cat", "dog", "Sat", "mat", "on", "a"]
    shared = " ".join(rng.choices(words, k=60))
    rows = []
    for n in range(40):
        parts = ["".join(w + rng.choice([" ", " ", " ", "  ", ". ", "\n"]) for w in rng.choices(words, k=30))]
        if n % 3 == 0:
            parts.insert(rng.randrange(2), shared)
        rows.append((n, " ".join(parts), rng.choice(["en", "de", None])))
    got = made(col.collocations(docs_of(*rows), min_count=5, top=40, modulus=modulus, longest=longest))
    assert got == brute([(r[2], r[1]) for r in rows], min_count=5, top=40)


def test_chunks_overlap_and_own_each_place_once():
    rng = random.Random(3)
    text = " ".join(rng.choices(["a", "b", "c", "d."], k=500))
    words = col.Words(pa.array([col.cleaned(text), col.cleaned(""), col.cleaned("e f")], pa.binary()), col.MARK)
    first, owner = col.cuts(words, 4, modulus=8)
    assert owner.tolist() == sorted(owner.tolist()) and set(owner.tolist()) == {0, 2}
    assert first[0] == 0 and np.all(np.diff(first) > 0) and len(first) > 30
    # The same passage behind another beginning is cut at the same words.
    again = col.Words(pa.array([col.cleaned("q r s t u " + text)], pa.binary()), col.MARK)
    moved, _ = col.cuts(again, 4, modulus=8)
    assert set((first[owner == 0][1:] + 5).tolist()) <= set(moved.tolist())


def test_equal_texts_are_one_chunk_each(docs_of, spark):
    text = " ".join(random.Random(5).choices("abcdefgh", k=3000))
    parse = col.parsed(docs_of(*[(n, text) for n in range(20)]), 5, "text", "lang", 64, 4096)
    assert parse.count() == 20 * parse.distinct().count()
    assert parse.agg({"n_words": "sum"}).first()[0] == 20 * 3000


def test_long_text_and_clashing_columns(docs_of):
    from pyspark.sql import functions as F

    text = ("lorem ipsum dolor " * 40_000) + "z" * 100_000
    docs = docs_of((1, text)).withColumns({c: F.lit(1) for c in ("_text", "chunk", "phrase", "h", "f", "freq", "owned")})
    assert made(col.collocations(docs, min_count=100)) == brute([("en", text)], min_count=100)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    frequent = [
        spark.createDataFrame([("en", "a", big + 7), ("en", "b", big + 1)], "lang string, phrase string, f long"),
        spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, f long"),
    ]
    totals = spark.createDataFrame([("en", 900_000_000_000_123)], "lang string, n long")
    row = col.scored(frequent, totals).first()
    assert row["score"] == 1000 * big * 900_000_000_000_123 // ((big + 7) * (big + 1))


def test_empty_table(docs_of, spark):
    empty = docs_of((1, "a")).where("doc_id > 1")
    assert col.collocations(empty).count() == 0


def test_bitmap_holds_all_and_little_else(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(h),) for h in hashes], "h long")
    bits = col._bits(frame)
    assert col._has(bits, hashes.view(np.uint64)).all()
    assert col._has(bits, rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.1


def test_shares_of_a_language_are_cut_before_they_meet(spark):
    rows = spark.range(1000).selectExpr("'en' AS lang", "CAST(id AS STRING) AS phrase", "id AS a", "id % 10 AS score")
    ranked = {(r["rank"], r["phrase"]) for r in col._first_rows(rows, 5).collect()}
    assert ranked == {(1, "999"), (2, "989"), (3, "979"), (4, "969"), (5, "959")}
