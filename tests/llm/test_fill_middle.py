from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwatch.llm import fill_middle as fim


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


ALPHABET = "ab \n\t<PSM>é漢😀́ \x00"


def texts(count):
    rng = random.Random(11)
    out = ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 40))) for _ in range(count)]
    return out + ["", None, "<P>", "x<S>y", "<", "<P", "S>", "<<M", "😀" * 5000, "word " * 60_000, "a"]


def test_against_plain_python_and_back(docs_of):
    rows = [(n, t) for n, t in enumerate(texts(600))] + [(None, "nobody's text"), (3, "again"), (3, "again")]
    docs = docs_of(*rows).withColumns({"output": F.lit(1), "form": F.lit(2), "_text": F.lit(3), "_h1": F.lit(4)})
    made = fim.fill_in_middle(docs)
    got = made.select(*made.columns, fim.restored(made).alias("back")).collect()
    want = sorted(((i, *brute(i, t), t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert {r["form"] for r in got} == set(fim.FORMS)


@pytest.mark.parametrize("unit,pattern", [("word", r"[^ \t\n\x0b-\r]+"), ("line", r"\n")])
def test_other_units(docs_of, unit, pattern):
    rows = [(n, t) for n, t in enumerate(texts(200))]
    made = fim.fill_in_middle(docs_of(*rows), unit=unit, plain_percent=0)
    back = made.select(*made.columns, fim.restored(made).alias("back")).collect()
    for row in back:
        text = rows[row["doc_id"]][1] or ""
        assert row["back"] == text
        places = [m.start() if unit == "word" else m.end() for m in re.finditer(pattern, text)]
        assert row["n"] == len(places)
        if row["form"] == "psm":
            prefix = row["output"][3:].partition("<S>")[0]
            cut = row["prefix_units"]
            starts = [*places, len(text)] if unit == "word" else [0, *places]
            assert len(prefix) == starts[cut]


def test_ranks_and_located_boundaries():
    rng = random.Random(2)
    parts = ["".join(rng.choices(ALPHABET, k=k)) for k in (0, 1, 200, 0, 77, 5)]
    data = [p.encode() for p in parts]
    ends = np.cumsum([len(d) for d in data])
    starts = np.concatenate([[0], ends[:-1]])
    joined = np.frombuffer(b"".join(data), np.uint8)
    classes = fim.byte_classes(joined, starts)
    matrix = fim.WaveletMatrix(classes, fim.CLASS_BITS)
    place = np.arange(len(joined) + 1)
    for symbol in range(8):
        assert matrix.rank(symbol, place).tolist() == [int((classes[:p] == symbol).sum()) for p in place]
    chars = fim.Boundaries(joined, starts, ends, "char")
    assert chars.counts().tolist() == [len(p) for p in parts]
    for k in range(201):
        want = [s + len(p[:k].encode()) for s, p in zip(starts.tolist(), parts, strict=True)]
        assert chars.locate(np.full(len(parts), k)).tolist() == want


def test_empty_table_and_unknown_unit(docs_of):
    docs = docs_of((1, "a"))
    assert fim.fill_in_middle(docs.where("doc_id > 1")).count() == 0
    with pytest.raises(ValueError, match="unit"):
        fim.fill_in_middle(docs, unit="page")


def test_large_cuts_do_not_depend_on_slices(docs_of, monkeypatch):
    rows = [(n, "añb c\n" * (n * 50)) for n in range(60)]
    want = {(i, brute(i, t)[4]) for i, t in rows}
    assert {(r["doc_id"], r["output"]) for r in fim.fill_in_middle(docs_of(*rows, partitions=1)).collect()} == want
