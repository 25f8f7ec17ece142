"""Approximate nearest neighbours by beam search on robust-pruned directed graphs.

Distinct vectors are dealt over shards of bounded size by hash. A task builds each shard's graph: vectors enter in
batches, a greedy search of the graph so far proposes neighbours, and a neighbour is kept only if no kept one
is nearer to it by a factor than the vector itself, so that edges point in diverse directions. Every query
runs a beam search on the graph of every shard, and the nearest of all shards are the answer, measured in double
precision on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, staged, tidy
from tillwatch.llm.runs import key_runs

DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
SLACK = 1.2
"""A neighbour goes if a kept one is nearer to it than the vector, even after lengthening by this factor."""
SHARD_ROWS = 8192
"""Vectors of a shard on average; the index of a shard is held by one task."""
QUERY_BLOCK = 65_536
"""Queries that one task runs against a shard; more are dealt over several tasks."""
STEP = 4
"""Nodes that a search opens at a time."""
BATCH = 256
FIRST = 64
"""Vectors that are compared with each other to begin a graph."""
TRACE = 24  # a multiple of STEP
"""Opened nodes, besides the beam, that a search proposes as neighbours: the far ones on its way."""


SAFE = 1e15
"""Vectors of single precision below this steer in it: their differences round to 24 bits, squares stay finite."""
NOTHING = np.uint64(0xFFFFFFFFFFFFFFFF)
"""An empty place of a beam; it sorts behind all others."""


def exact_distances(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows in double precision, squares added in order of the components."""
    total = np.zeros(len(one))
    for j in range(one.shape[1]):
        apart = one[:, j] - many[:, j]
        total += apart * apart
    return np.sqrt(total)


def _squares(apart: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", apart, apart)


def _packed(far: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Places of a beam as single numbers that sort by distance (24 significant bits), then node; the last bit
    marks opened ones."""
    near = np.minimum(np.sqrt(far), np.finfo(np.float32).max).astype(np.float32)
    return near.view(np.uint32).astype(np.uint64) << np.uint64(32) | nodes.astype(np.uint64) << np.uint64(1)


def _nodes(places: np.ndarray) -> np.ndarray:
    """Nodes of places, -1 for empty ones."""
    return np.where(places == NOTHING, -1, (places & np.uint64(0xFFFFFFFF)).astype(np.int64) >> 1)


class Graph:
    """Directed graph over vectors (n, d); ``edges`` (n, width) are filled up with -1 behind each node's own."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, degree: int = DEGREE):
        self.total, self.degree = len(vectors), degree
        single = vectors.astype(np.float32) if np.abs(vectors).max(initial=0) < SAFE else vectors
        self.points = single if (single == vectors).all() else vectors
        order = np.random.default_rng(self.total).permutation(self.total)
        middle = _squares(vectors - vectors.mean(0)).argmin()
        self.order = np.concatenate([[middle], order[order != middle]])
        self.entry = self.order[:4]
        self.edges = np.full((self.total, 2 * degree), -1) if edges is None else edges

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes in the beam of each query, nearest first; -1 fills up."""
        return _nodes(self._search(queries.astype(self.points.dtype), beam, 0)[0])

    def _search(self, points: np.ndarray, beam: int, trace: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the beams, and the first ``trace`` nodes that each search opened."""
        count, one = len(points), np.uint64(1)
        seen = np.zeros((count, self.total + 1), bool)  # the last column stands for no node
        seen[:, -1] = True
        seen[:, self.entry] = True
        places = np.full((count, beam), NOTHING)
        first = self.entry[:beam]
        places[:, : len(first)] = _packed(_squares(points[:, None, :] - self.points[first]), first)
        places.sort(axis=1)
        way, steps = np.full((count, trace), -1), 0
        live = np.arange(count)
        while len(live):
            shut = places[live] & one == 0
            has = shut.any(1)
            live, shut = live[has], shut[has]
            if not len(live):
                break
            turn = np.cumsum(shut, axis=1)
            at, place = np.nonzero(shut & (turn <= STEP))
            picked = np.full((len(live), STEP), -1)
            picked[at, turn[at, place] - 1] = _nodes(places[live[at], place])
            places[live[at], place] |= one
            if steps < trace:
                way[live, steps : steps + STEP] = picked[:, : trace - steps]
                steps += STEP
            near = np.where(picked[:, :, None] >= 0, self.edges[picked], -1).reshape(len(live), -1)
            near[seen[live[:, None], near]] = -1
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh, column = np.nonzero(near >= 0)
            found = near[fresh, column]
            seen[live[fresh], found] = True
            reach = np.full(near.shape, NOTHING)
            reach[fresh, column] = _packed(_squares(self.points[found] - points[live[fresh]]), found)
            both = np.concatenate([places[live], reach], axis=1)
            both.sort(axis=1)
            places[live] = both[:, :beam]
        return places, way

    def _pruned(self, node: np.ndarray, options: np.ndarray, slack: float) -> np.ndarray:
        """Of each node's ``options`` (-1: none) those that robust pruning keeps, at most ``degree``."""
        options = np.where(options == node[:, None], -1, options)
        options.sort(axis=1)
        options[:, 1:][options[:, 1:] == options[:, :-1]] = -1
        aside = self.points[options] - self.points[node][:, None, :]
        places = np.where(options >= 0, _packed(_squares(aside), np.maximum(options, 0)), NOTHING)
        order = np.argsort(places, axis=1)
        places = np.take_along_axis(places, order, 1)
        aside = np.take_along_axis(aside, order[:, :, None], 1)
        options, alive = _nodes(places), places != NOTHING
        far = np.where(alive, _squares(aside), 0)
        between = far[:, :, None] + far[:, None, :] - 2 * np.matmul(aside, aside.transpose(0, 2, 1))
        kept = np.full((len(node), self.degree), -1)
        rows = np.arange(len(node))
        for place in range(self.degree):
            some = alive.any(1)
            if not some.any():
                break
            best = alive.argmax(1)
            kept[some, place] = options[rows[some], best[some]]
            alive &= slack * slack * between[rows, best] > far
            alive[rows, best] = False
        return kept

    def _point_back(self, made: np.ndarray, slack: float) -> None:
        """Edges in the other direction; a node whose places are full is pruned."""
        width = self.edges.shape[1]
        target, source = self.edges[made].ravel(), np.repeat(made, width)
        source, target = source[target >= 0], target[target >= 0]
        new = ~(self.edges[target] == source[:, None]).any(1)
        source, target = source[new], target[new]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, start, sizes = np.unique(target, return_index=True, return_counts=True)
        held = (self.edges[nodes] >= 0).sum(1)
        place = np.arange(len(target)) - np.repeat(start - held, sizes)
        full = held + sizes > width
        fits = ~np.repeat(full, sizes)
        self.edges[target[fits], place[fits]] = source[fits]
        for at in range(0, int(full.sum()), BATCH):
            part = np.flatnonzero(full)[at : at + BATCH]
            options = np.full((len(part), held[part].max() + sizes[part].max()), -1)
            options[:, :width] = self.edges[nodes[part]]
            for row, n in enumerate(part):
                options[row, held[n] : held[n] + sizes[n]] = source[start[n] : start[n] + sizes[n]]
            kept = self._pruned(nodes[part], options, slack)
            self.edges[nodes[part]] = -1
            self.edges[nodes[part], : self.degree] = kept

    def grow(self, beam: int = BUILD_BEAM, slack: float = SLACK) -> Graph:
        """Insert all vectors in a fixed random order, in batches no larger than what is there."""
        start = self.order[:FIRST]
        self.edges[start, : self.degree] = self._pruned(start, np.tile(start, (len(start), 1)), slack)
        done = len(start)
        while done < self.total:
            made = self.order[done : done + min(BATCH, done)]
            done += len(made)
            places, way = self._search(self.points[made], beam, TRACE)
            options = np.concatenate([_nodes(places), way], axis=1)
            self.edges[made, : self.degree] = self._pruned(made, options, slack)
            self._point_back(made, slack)
        return self

    def reached(self) -> np.ndarray:
        """Which nodes some path of edges leads to."""
        found = np.zeros(self.total, bool)
        found[self.entry] = True
        front = self.entry
        while len(front):
            ahead = np.unique(self.edges[front])
            ahead = ahead[ahead >= 0]
            front = ahead[~found[ahead]]
            found[front] = True
        return found

    def connect(self, beam: int = BUILD_BEAM) -> Graph:
        """Give each node that no path leads to an edge from the nearest node found; pruning may have cut it off."""
        lost = np.flatnonzero(~self.reached())
        while len(lost):
            made = lost[:BATCH]
            near = _nodes(self._search(self.points[made], beam, 0)[0][:, 0])
            order = np.argsort(near, kind="stable")
            near, made = near[order], made[order]
            nodes, start, sizes = np.unique(near, return_index=True, return_counts=True)
            held = (self.edges[nodes] >= 0).sum(1)
            place = np.arange(len(near)) - np.repeat(start - held, sizes)
            wider = place.max() + 1 - self.edges.shape[1]
            if wider > 0:
                self.edges = np.pad(self.edges, ((0, 0), (0, wider)), constant_values=-1)
            self.edges[near, place] = made
            lost = np.flatnonzero(~self.reached())
        return self


def _usable(vector: Column) -> Column:
    """Vectors with components, all of them finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` of the rows that take part, each pair once."""
    slim = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return slim.where(F.col("id").isNotNull() & F.coalesce(_usable(F.col("v")), F.lit(False))).distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build_index(
    vectors: DataFrame,
    members: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    degree: int = DEGREE,
    shard_rows: int = SHARD_ROWS,
) -> tuple[DataFrame, int]:
    """The graphs as a written table, and the number of shards.

    One row per distinct vector: ``part`` (length of the vector times shards, plus shard), ``node``, ``v``, ``ids`` (its
    smallest ids, at most ``members``) and ``edges`` (nodes of the same part). A vector that many rows share is
    one node; shares of its rows are cut to the smallest ids before they meet.
    """
    order = F.expr("row_number() OVER (PARTITION BY v ORDER BY id)")
    smallest = _vectors(vectors, id_col, vector_col).withColumn("place", order).where(F.col("place") <= members)
    distinct = staged(smallest.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "graph-vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    part = F.size("v") * F.lit(shards).cast("long") + F.pmod(F.xxhash64("v"), F.lit(shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in key_runs(batches, ["part"]):
            graph = Graph(_matrix(rows.column("v")), degree=degree).grow().connect()
            own = graph.edges >= 0
            offsets = np.concatenate([[0], np.cumsum(own.sum(1))]).astype(np.int32)
            edges = pa.ListArray.from_arrays(pa.array(offsets), pa.array(graph.edges[own].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [rows.column("part"), pa.array(np.arange(rows.num_rows)), rows.column("v"), rows.column("ids"), edges],
                names=["part", "node", "v", "ids", "edges"],
            )

    kind = distinct.schema["ids"].dataType.simpleString()
    built = (
        distinct.withColumn("part", part)
        .repartition(min(shards, 4 * part_count(vectors.sparkSession)), "part")
        .sortWithinPartitions("part", F.col("ids")[0])
        .mapInArrow(tidy(run), f"part long, node long, v array<double>, ids {kind}, edges array<int>")
    )
    return staged(built, "graph-index"), shards


def _graph(rows: pa.RecordBatch) -> Graph:
    edges = rows.column("edges")
    sizes = np.diff(edges.offsets.to_numpy())
    table = np.full((len(sizes), max(1, sizes.max(initial=0))), -1)
    table[np.arange(table.shape[1]) < sizes[:, None]] = edges.flatten().to_numpy()
    return Graph(_matrix(rows.column("v")), table)


def _first_ids(rows: list[int], scores: list[float], members: list[list], asking: list, k: int) -> list[tuple]:
    """Asking id, id and score of the ``k`` nearest other ids of each row; nodes come sorted by row and score."""
    out, best, now, last = [], {}, -1, 0.0

    def close() -> None:
        out.extend((asking[now], i, s) for s, i in sorted((s, i) for i, s in best.items())[:k])

    for row, score, ids in zip(rows, scores, members, strict=True):
        if row != now:
            close()
            best, now, last = {}, row, 0.0
        if len(best) >= k and score > last:
            continue
        for i in ids:
            if i != asking[row]:
                best.setdefault(i, score)
        last = score
    close()
    return out


def search_index(
    index: DataFrame,
    shards: int,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``vec_id``, ``score``: for each query the ``k`` nearest found in each shard."""
    asked = staged(_vectors(queries, id_col, vector_col), "graph-queries")
    blocks = max(1, -(-asked.count() // query_block))
    none = F.lit(None)
    kind = index.schema["ids"].dataType.simpleString()
    nodes = index.withColumns(
        {"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "kind": F.lit(0), "id": none.cast(asked.schema["id"].dataType)}
    )
    first = F.size("v") * F.lit(shards).cast("long")
    points = asked.select(
        F.explode(F.sequence(first, first + shards - 1)).alias("part"),
        F.lit(0).cast("long").alias("node"),
        "v",
        none.cast(kind).alias("ids"),
        none.cast("array<int>").alias("edges"),
        F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(1).alias("kind"),
        "id",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, held, of = None, None, None
        for (part, block, what), rows in key_runs(batches, ["part", "block", "kind"]):
            if what == 0:
                graph, held, of = _graph(rows), rows.column("ids"), (part, block)
                vectors = _matrix(rows.column("v"))
                continue
            if of != (part, block):
                continue  # a shard without vectors
            for start in range(0, rows.num_rows, BATCH):
                some = rows.slice(start, BATCH)
                points = _matrix(some.column("v"))
                near = graph.search(points, max(beam, k + 1))
                row, place = np.nonzero(near >= 0)
                nodes = near[row, place]
                far = exact_distances(points[row], vectors[nodes])
                order = np.lexsort([nodes, far, row])
                ids = held.take(pa.array(nodes[order])).to_pylist()
                asking = some.column("id").to_pylist()
                out = _first_ids(row[order].tolist(), far[order].tolist(), ids, asking, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], some.schema.field("id").type),
                        pa.array([o[1] for o in out], some.schema.field("id").type),
                        pa.array([o[2] for o in out], pa.float64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    kind_of_id = asked.schema["id"].dataType.simpleString()
    tasks = min(shards * blocks, 4 * part_count(index.sparkSession))
    return (
        nodes.unionByName(points)
        .repartition(tasks, "part", "block")
        .sortWithinPartitions("part", "block", "kind", "node")
        .mapInArrow(tidy(run), f"query_id {kind_of_id}, vec_id {kind_of_id}, score double")
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = BEAM,
    degree: int = DEGREE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Each query's ``k`` nearest vectors found: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean).

    Every row of ``vectors`` is a candidate but those with the query's own id; ties go to the smaller id. Null ids,
    and vectors that are null, empty, zero or hold null or non-finite components, take no part on either side.
    Vectors of another length than the query's are no candidates. A repeated row counts once; of an id with
    several vectors the nearest counts, for queries and candidates alike. Empty tables give no rows. Other
    columns are not read.
    """
    index, shards = build_index(vectors, k + 1, id_col, vector_col, degree, shard_rows)
    found = search_index(index, shards, queries, k, id_col, vector_col, beam)
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)")
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
