"""Quality rules against plain Python, and their bounds against exact binomial sums."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from tillwatch.llm import quality_rules as Q
from tillwatch.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def exact_tail(n, k, risk):
    p = Fraction(risk)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def words(n, seed=0):
    return " ".join(f"w{random.Random(seed * 1000 + i).randrange(10**6)}" for i in range(n))


ODD = [
    None, "", " \n\t", "one", words(19), words(20), words(21) + "\n" + words(21), "a b c d e f g h " * 40, "x\n\nx\n \nx\r\ny",
    "\x0b\x0c\x1c  word", "# $ % & | < > * #", "\U0001f600 éé " * 30, words(30_000),
    "a " * 7, "a " * 8, "a " * 9, " ".join(["p q r s t u v w"] + [words(60, 5)] + ["p q r s t u v w"]),
]


def test_base_measures(spark, docs_of):
    docs = docs_of(*enumerate(ODD), (3, "one"), (None, "no id")).withColumn("kept", F.lit("clash")).withColumn("_m", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = Q.quality_report(docs, labels).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r["doc_id"] is not None:
            want = base(ODD[r["doc_id"]])
            assert {k: r[k] for k in want} == want
            assert r["kept"] == (not r["base_failed"])  # without labels only the base rules reject
    assert Q.quality_report(docs.limit(0), labels).count() == 0
    assert Q.kept_documents(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("risk", [0.01, 0.05])
def test_binomial_tail_is_exact(spark, risk):
    cases = [(n, k) for n in (0, 1, 5, 100, 255, 256, 300, 1000, 4000) for k in (0, 1, 2, 5, 9, 30) if k <= n]
    df = spark.createDataFrame(cases, "n long, k long").withColumn("p", Q.binomial_tail(F.col("n"), F.col("k"), risk))
    for r in df.collect():
        if r["k"] >= r["n"] * risk:
            assert r["p"] == 1.0
        else:
            assert r["p"] == pytest.approx(exact_tail(r["n"], r["k"], risk), rel=1e-8)


def labelled_corpus(docs_of, spark, goods=2500):
    good = [(i, words(60, i), "en" if i % 5 else "de") for i in range(goods)]
    bad = [(10**6 + i, words(50, i) + " ###" * 9 + f" {i}", "en") for i in range(40)]
    few = [(2 * 10**6 + i, words(50, i) + " ###" * 9, "fr") for i in range(5)]
    labels = [(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad] + [(None, 1, 0), (7, None, 0), (5, 1, 0)]
    return docs_of(*good, *bad, *few), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_cutoffs_reject_junk_and_keep_the_bound(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark)
    rows = by_id(Q.quality_report(docs, labels))
    assert all(rows[i]["kept"] for i in range(2500))
    assert not any(rows[10**6 + i]["kept"] for i in range(40))
    # Too few labels in a stratum: no cutoff can be guaranteed, so none is used.
    assert all(rows[2 * 10**6 + i]["kept"] for i in range(5))
    kept = Q.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {k for k, r in rows.items() if r["kept"]}


def test_cutoffs_equal_brute_force(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark, 1500)
    measured = Q.with_measures(docs)
    grid = {"symbols": (0.0, 0.01, 0.5), "long_words": (5.0, 6.0, 6.5, 7.0)}
    cuts = {r["stratum"]: r.asDict() for r in Q.cutoffs(measured, Q.good_ids(labels), grid=grid, risk=0.02).collect()}
    texts = {r["doc_id"]: (r["lang"], base(r["text"])) for r in docs.collect()}
    # Row 7 has a null label next to its good one, which the null does not undo.
    goods = {i: texts[i] for i in range(1500)}
    strata = sorted({s for s, m in goods.values() if not m["base_failed"]})
    assert sorted(cuts) == strata
    for stratum in strata:
        own = [m for s, m in goods.values() if s == stratum and not m["base_failed"]]
        for rule, values in grid.items():
            accepted = []
            for cut in values:
                score = {"symbols": lambda m: m["n_symbols"] / m["word_chars"],
                         "long_words": lambda m: m["word_chars"] / m["n_words"]}[rule]
                lost = sum(score(m) > cut for m in own)
                if lost < len(own) * 0.02 and exact_tail(len(own), lost, 0.02) <= 0.05 / (len(strata) * 7):
                    accepted.append(cut)
            assert cuts[stratum][f"cut_{rule}"] == (min(accepted) if accepted else None)


def test_no_python_in_the_plan(spark, docs_of):
    docs, labels = labelled_corpus(docs_of, spark, 50)
    plan = Q.quality_report(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_registered_query(spark, sf_dir):
    got = by_id(QUERIES["op8_quality_rules"](spark, sf_dir))
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        want = base(r["text"])
        assert {k: got[r["doc_id"]][k] for k in want} == want
        assert not (want["base_failed"] and got[r["doc_id"]]["kept"])


def test_columns_of_any_name(spark, docs_of):
    from pyspark.sql import functions as F

    own = ["kept", "_m", "_s", "_row", "_id", "_stratum", "_text", "stratum", *(f"cut_{r}" for r in Q.GRID), "c0", "a.b"]
    docs = docs_of(*enumerate(ODD)).withColumns({c: F.lit("clash") for c in own})
    labels = spark.createDataFrame([(11, 1, 0)], "doc_id long, quality int, toxic int")
    kept = Q.kept_documents(docs, labels)
    assert kept.columns == docs.columns and {r["kept"] for r in kept.collect()} == {"clash"}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(ODD) if not base(t)["base_failed"]}
    assert Q.quality_report(docs, labels).count() == len(ODD)
