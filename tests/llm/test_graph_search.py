from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm import graph_search as gs

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(partitions)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, asked, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q, p in good:
        if not asked(q):
            continue
        near = out.setdefault(q, {})
        for c, v in good:
            if c != q and len(v) == len(p):
                far = 0.0
                for a, b in zip(p.tolist(), v.tolist(), strict=True):
                    far += (a - b) * (a - b)
                near[c] = min(near.get(c, np.inf), float(np.sqrt(far)))
    return {(q, n + 1, c, s) for q, near in out.items() for n, (s, c) in enumerate(sorted((s, c) for c, s in near.items())[:k])}


def found(df):
    return {tuple(r) for r in df.collect()}


def test_odd_vectors_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(n, rng.standard_normal(4).astype(np.float32).tolist()) for n in range(40)]
    rows += [(n, rows[7][1]) for n in range(100, 130)]  # one vector under many ids
    rows += [rows[3], rows[3], (5, [9.0, 9.0, 9.0, 9.0])]  # repeated rows; an id with two vectors
    rows += [
        (200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 1.0, 1.0]), (204, [float("nan"), 1.0, 1.0, 1.0]),
        (205, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (206, [1.0, 2.0]), (207, [1.0, 2.5]),
        (208, [3e38, -3e38, 3e38, 1e-38]), (209, [-0.0, 1.0, 0.0, 1.0]), (210, [0.0, 1.0, -0.0, 1.0]),
    ]
    df = frame(spark, rows).withColumns({c: F.lit(1) for c in ("id", "v", "part", "node", "ids", "score", "rank")})
    assert found(gs.nearest(df, df)) == brute(rows, lambda q: True)


@pytest.mark.parametrize("count", [0, 1, 2, 7, 64, 65, 70])
def test_small_tables_give_all_candidates(spark, count):
    rng = np.random.default_rng(count)
    rows = [(n, rng.standard_normal(3).tolist()) for n in range(count)]
    df = frame(spark, rows, 1)
    got = found(gs.nearest(df, df, shard_rows=30))
    assert got == brute(rows, lambda q: True)


def test_recall_in_several_shards(spark):
    """Clusters, a dense lump and noise, in 7 shards."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 32)) * 3
    parts = [centres[rng.integers(12, size=2500)] + rng.standard_normal((2500, 32)) * 0.3, rng.standard_normal((400, 32)) * 1e-3 + 5, rng.standard_normal((100, 32)) * 50]
    rows = [(n, v.tolist()) for n, v in enumerate(np.concatenate(parts))]
    df = frame(spark, rows)
    got = found(gs.nearest(df, df.where("vec_id % 10 = 0"), shard_rows=450))
    want = brute(rows, lambda q: q % 10 == 0)
    assert len(got) == len(want)
    assert len({g[0::2] for g in got} & {w[0::2] for w in want}) >= 0.99 * len(want)


def test_recall_and_reach_of_one_hard_graph():
    """Directionless noise in 64 dimensions, where no structure helps a search."""
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((4000, 64))
    graph = gs.Graph(vectors).grow().connect()
    assert graph.reached().all()
    assert (graph.edges >= 0).sum(1).max() <= graph.edges.shape[1]
    queries = vectors[::40] + 0.1 * rng.standard_normal((100, 64))
    near = graph.search(queries, gs.BEAM)[:, :10]
    far = ((queries[:, None, :] - vectors[None]) ** 2).sum(2)
    want = far.argsort(1)[:, :10]
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(near.tolist(), want.tolist(), strict=True)])
    assert recall >= 0.97


def test_lost_nodes_get_an_edge():
    vectors = np.random.default_rng(2).standard_normal((300, 8))
    graph = gs.Graph(vectors).grow()
    cut = np.setdiff1d(np.arange(300), graph.entry)[:40]
    graph.edges[np.isin(graph.edges, cut)] = -1
    graph.edges = -np.sort(-graph.edges, axis=1)
    assert not graph.reached().all()
    assert graph.connect().reached().all()


def test_pruning_keeps_diverse_edges():
    line = np.array([[0.0, 0], [1, 0], [1.1, 0], [1.2, 0], [-1, 0], [0, 5]])
    graph = gs.Graph(line)
    kept = graph._pruned(np.array([0]), np.array([[1, 2, 3, 4, 5, -1]]), 1.2)[0]
    assert set(kept[kept >= 0].tolist()) == {1, 4, 5}


def test_index_is_reused_for_several_query_sets(spark):
    rng = np.random.default_rng(3)
    rows = [(n, rng.standard_normal(6).tolist()) for n in range(200)]
    df = frame(spark, rows)
    index, shards = gs.build_index(df, 6, shard_rows=60)
    assert shards == 4 and index.selectExpr("size(ids)").agg({"size(ids)": "sum"}).first()[0] == 200
    got = gs.search_index(index, shards, df.where("vec_id < 10"), k=5, query_block=3)
    best = {}
    for r in got.collect():
        best.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    want = brute(rows, lambda q: q < 10, 5)
    assert {(q, n + 1, c, s) for q, all_of in best.items() for n, (s, c) in enumerate(sorted(all_of)[:5])} == want
