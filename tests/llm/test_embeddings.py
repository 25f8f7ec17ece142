"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from tillwatch.llm import embeddings as E
from tillwatch.llm.components import components
from tillwatch.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """Links and smallest reachable id by all pairs."""
    ok = []
    for n, (key, vec, label) in enumerate(rows):
        if key is None or label is None or not vec or None in vec:
            continue
        if not all(map(math.isfinite, vec)) or not any(vec):
            continue
        v = np.array(vec, np.float32).astype(float)
        ok.append((n, key, label, v / np.linalg.norm(v)))
    links = {n: 0 for n in range(len(rows))}
    parent = {n: n for n in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (n, _, label, v) in enumerate(ok):
        for m, _, other, w in ok[:i]:
            if label == other and len(v) == len(w) and v @ w >= threshold:
                links[n] += 1
                links[m] += 1
                parent[find(n)] = find(m)
    least = {}
    for n, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(n)] = min(least.get(find(n), key), key)
    return sorted(((key, links[n], None if key is None else least[find(n)]) for n, (key, _, _) in enumerate(rows)), key=repr)


def got(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=repr)


def groups(rng, spec, dim=24, noise=0.08):
    rows, key = [], 0
    for size, label in spec:
        centre = rng.standard_normal(dim)
        for _ in range(size):
            vec = centre + noise * rng.standard_normal(dim)
            rows.append((key * 7 % 100_003, vec.astype(np.float32).tolist(), label))
            key += 1
    return rows


def test_groups_of_every_size(spark):
    rng = np.random.default_rng(1)
    spec = [(1, i % 3) for i in range(300)] + [(2, i % 3) for i in range(60)] + [(5, 0)] * 5 + [(300, 1)]
    rows = groups(rng, spec)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(E.near_vectors(df)) == brute(rows)


def test_blocks_of_a_group_meet(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rows = groups(np.random.default_rng(2), [(90, 0), (40, 0)], noise=0.12)
    assert got(E.near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_rows_of_every_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0), (2, [2.0, 4.0], 0), (3, [1.0, 2.0], 1), (4, [1.0, 2.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
        (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [], 0), (10, [1.0, 2.0, 0.0], 0), (11, [1.0, 2.0], 0), (12, [-1.0, -2.0], 0),
        (13, [1e-30, 2e-30], 0), (14, [1e30, 2e30], 0), (None, [1.0, 2.0], 0), (15, [1.0, None], 0), (16, [5.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("clash"), "n_links": F.lit("clash")})
    assert got(E.near_vectors(df.repartition(3))) == brute(rows)
    twice = rows[:3] + rows[:1]
    found = {r[0]: r[1] for r in got(E.near_vectors(spark.createDataFrame(twice, SCHEMA)))}
    assert found == {1: 2, 2: 2, 3: 0}
    assert E.near_vectors(df.limit(0)).count() == 0


def test_threshold_is_met_exactly(spark):
    # 3-4-5: the cosine of the two is 0.6 to the last bit.
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [3.0, 4.0], 0)], SCHEMA)
    assert [r[1] for r in got(E.near_vectors(df, threshold=0.6))] == [1, 1]
    assert [r[1] for r in got(E.near_vectors(df, threshold=0.601))] == [0, 0]


def clustered(rng, size, planted, dim=64, mean_cosine=0.8, cosine=0.981):
    """Unit vectors of one label around a centre, the last ones each beside one of the first."""
    centre = rng.standard_normal(dim)
    centre *= np.sqrt(mean_cosine) / np.linalg.norm(centre)
    rows = centre + rng.standard_normal((size - planted, dim)) * np.sqrt((1 - mean_cosine) / dim)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    aside = rng.standard_normal((planted, dim))
    aside -= (aside * rows[:planted]).sum(1, keepdims=True) * rows[:planted]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return np.concatenate([rows, cosine * rows[:planted] + np.sqrt(1 - cosine**2) * aside])


@pytest.mark.parametrize("mean_cosine", [0.0, 0.8, 0.97])
def test_no_pair_of_a_large_or_clustered_label_is_missed(spark, mean_cosine):
    vectors = clustered(np.random.default_rng(3), 6000, 1500, mean_cosine=mean_cosine).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA)
    unit = vectors.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    found = {r["vec_id"]: r["n_links"] for r in E.near_vectors(df, window=8).collect()}
    assert [found[i] for i in range(len(vectors))] == near.sum(1).tolist()


@pytest.mark.parametrize("seed", range(4))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 150, (120, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2000 + i) for i in range(1, 200)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    expected = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    df = spark.createDataFrame([*edges, edges[0], (None, 1)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(df).collect()} == expected


def test_registered_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = by_id(QUERIES["op1_embedding_neardup"](spark, sf_dir), "vec_id")
    assert sorted(((k, r["n_links"], r["component_id"]) for k, r in found.items()), key=repr) == brute(rows)
