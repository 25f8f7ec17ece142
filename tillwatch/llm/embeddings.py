"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors of a label, less the label's centre, are sorted by a row of random hyperplane signs,
and each is compared with a window of its neighbours; verified pairs of all passes are united into groups. A
label gets as many passes as its size and spread need for a bound on missed pairs; where all pairs are
fewer than the passes would compare, all are compared in blocks instead. Within a group, whose size no window
can hold, all members are then compared in blocks, so that every link is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, staged, tidy
from tillwatch.llm.components import components, least_in_group
from tillwatch.llm.runs import key_runs

WINDOW = 64
MISS = 1e-5
"""Largest expected share of pairs at the threshold that all passes of a label may miss."""
SAMPLE = 2048
PROBES = 8
BITS = 62
BLOCK = 1024
CELL = ("component", "c1", "c2")


def hyperplanes(dim: int, number: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dim]).standard_normal((dim, BITS))


def sort_keys(vectors: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Signs against random hyperplanes, the first one in the highest bit."""
    signs = vectors @ hyperplanes(vectors.shape[1], number, seed) > 0
    return signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def unit_rows(column: pa.Array, dtype: str) -> np.ndarray:
    """Vectors of one length, in double precision and of length one."""
    rows = np.frombuffer(b"".join(column.to_pylist()), dtype).astype(np.float64).reshape(len(column), -1)
    return scaled(rows)


def scaled(rows: np.ndarray) -> np.ndarray:
    # The largest component goes first, so that no square over- or underflows.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def vector_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str]:
    """``id``, ``label``, ``dim``, ``vec`` (bytes) of each row, and the bytes' type; ``vec`` is null where the
    vector can link with nothing."""
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    dtype = "<f4" if element == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, dims = [], []
            linkable = zip(
                batch.column("v").to_pylist(), batch.column("id").is_valid().to_pylist(),
                batch.column("label").is_valid().to_pylist(), strict=True,
            )
            for values, has_id, has_label in linkable:
                vec = None
                if has_id and has_label and values and None not in values:
                    row = np.array(values, dtype)
                    if np.isfinite(row).all() and row.any():
                        vec = row.tobytes()
                vecs.append(vec)
                dims.append(len(values) if vec else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                names=["id", "label", "dim", "vec"],
            )

    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v")
    )
    return rows.mapInArrow(tidy(run), "id long, label long, dim int, vec binary"), dtype


def passes_needed(rows: np.ndarray, total: int, threshold: float, window: int, seed: int) -> int:
    """Passes after which the windows of a label miss a share of :data:`MISS` of its pairs at the threshold.

    ``rows`` is a sample of the label's ``total`` vectors. Each gets a planted partner; a pass finds the two if
    they share so many leading signs that no more rows than the window do. How many those are is counted
    in the sample, around each row apart, and carried on at the sample's own rate below what it resolves.
    """
    rng, (count, dim) = np.random.default_rng([seed, total]), rows.shape
    centre = rows.mean(0)
    aside = rng.standard_normal((count, dim))
    aside -= (aside * rows).sum(1, keepdims=True) * rows
    length = np.sqrt((aside * aside).sum(1, keepdims=True))
    aside = np.where(length > 1e-9, aside / np.maximum(length, 1e-9), 0)
    partners = threshold * rows + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside
    one, two = rows - centre, partners - centre
    scale = np.sqrt((one * one).sum(1) * (two * two).sum(1))
    cosine = np.where(scale > 0, (one * two).sum(1) / np.maximum(scale, 1e-300), -1)
    same = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi  # chance that one plane leaves the two together

    share = np.zeros((BITS + 1, count))  # of the other rows that share the first j signs
    for number in range(PROBES):
        keys = sort_keys(one, number, seed)
        for bits in range(BITS + 1):
            _, group, sizes = np.unique(keys >> (BITS - bits), return_inverse=True, return_counts=True)
            share[bits] += (sizes[group] - 1) / max(1, count - 1) / PROBES
            if len(sizes) == count:
                break
    wanted = window / total
    resolved = max(wanted, min(1.0, 16 / count))
    reached = share <= resolved
    bits = np.where(reached.any(0), reached.argmax(0), BITS).astype(float)
    left = np.log2(np.maximum(share[bits.astype(int), np.arange(count)], resolved) / wanted)
    means = share.mean(1)
    deep = np.flatnonzero(means * count >= 1)[-1]
    rate = min(1.0, max(np.log2(1 / means[deep]) / deep if deep else 0.0, 1e-3))
    chance = same ** (bits + np.maximum(left, 0) / rate)

    low, high = 0, 1
    while high * window < total and ((1 - chance) ** high).mean() > MISS:
        low, high = high, high * 2
    while high - low > 1:
        middle = (low + high) // 2
        if ((1 - chance) ** middle).mean() > MISS:
            low = middle
        else:
            high = middle
    return high


def label_plans(heads: DataFrame, dtype: str, threshold: float, window: int, seed: int) -> DataFrame:
    """``passes`` and ``centre`` of each label and length with more vectors than a window holds; 0 passes
    where all pairs are to be compared. From a sample of about :data:`SAMPLE` vectors each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (label, dim, total), part in key_runs(batches, ("label", "dim", "n")):
            rows = unit_rows(part.column("vec"), dtype)
            passes = passes_needed(rows, total, threshold, window, seed)
            if passes * window >= total:
                passes = 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label], pa.int64()), pa.array([dim], pa.int32()), pa.array([passes], pa.int32()),
                    pa.array([rows.mean(0).tobytes()], pa.binary()),
                ],
                names=["label", "dim", "passes", "centre"],
            )

    sizes = staged(heads.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > window), "vec-labels")
    sample = heads.join(sizes, ["label", "dim"]).where(F.pmod(F.xxhash64("id"), F.col("n")) < SAMPLE)
    plans = (
        sample.select("label", "dim", "n", "id", "vec")
        .repartition(part_count(heads.sparkSession), "label", "dim")
        .sortWithinPartitions("label", "dim", "id")
        .mapInArrow(tidy(run), "label long, dim int, passes int, centre binary")
    )
    # A label of which the sample has nothing has all its pairs compared.
    return staged(
        sizes.select("label", "dim").join(plans, ["label", "dim"], "left").withColumn("passes", F.coalesce("passes", F.lit(0))),
        "vec-plans",
    )


def window_links(heads: DataFrame, plans: DataFrame, dtype: str, threshold: float, window: int, seed: int) -> DataFrame:
    """Edges ``a``, ``b`` that tie together what the windows of all passes link.

    A task ties each row to the first row of its local group, one edge per row and pass at most. It hands on
    its first and last rows, whose windows go over the border to the next task. A label without a plan fits
    a window and needs one pass.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_dim = batch.column("dim").to_numpy()
            for dim in np.unique(of_dim).tolist():
                part = batch.filter(pa.array(of_dim == dim))
                rows = unit_rows(part.column("vec"), dtype)
                none = np.zeros(dim).tobytes()
                centres = b"".join(c or none for c in part.column("centre").to_pylist())
                rows = rows - np.frombuffer(centres, np.float64).reshape(rows.shape)
                passes = part.column("passes").to_numpy()
                for number in range(int(passes.max())):
                    wanted = np.flatnonzero(passes > number)
                    keys = pa.array(sort_keys(rows[wanted], number, seed), pa.int64())
                    numbers = pa.array(np.full(len(wanted), number, np.int32))
                    own = part.take(pa.array(wanted))
                    yield pa.RecordBatch.from_arrays(
                        [numbers, *(own.column(c) for c in ("label", "dim")), keys, own.column("id"), own.column("vec")],
                        names=["pass", "label", "dim", "key", "id", "vec"],
                    )

    def tied(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch | None:
        left, right = [], []
        for step in range(1, min(window, len(ids) - 1) + 1):
            near = np.flatnonzero(np.einsum("ij,ij->i", rows[:-step], rows[step:]) >= threshold)
            left.append(near)
            right.append(near + step)
        if not left:
            return None
        least = least_in_group(len(ids), np.concatenate(left), np.concatenate(right))
        at = np.flatnonzero(least != np.arange(len(ids)))
        if not len(at):
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[least[at]]), pa.array(ids[at])], names=["a", "b"])

    def tie_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
        now, ids, rows = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            for key, part in key_runs([batch], keys):
                new_ids, new_rows = part.column("id").to_numpy(), unit_rows(part.column("vec"), dtype)
                if key == now:  # the group goes on: its last rows are neighbours of the new ones
                    new_ids = np.concatenate([ids[-window:], new_ids])
                    new_rows = np.concatenate([rows[-window:], new_rows])
                now, ids, rows = key, new_ids, new_rows
                found = tied(ids, rows)
                if found is not None:
                    yield found

    border = ["pass", "label", "dim", "id", "vec"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        first, last, seen = [], None, 0

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal last, seen
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = pa.Table.from_batches([batch.select(border)])
                if seen < window:
                    first.append(own.slice(0, window - seen))
                rest = own.slice(max(0, window - seen))
                seen += batch.num_rows
                last = rest if last is None else pa.concat_tables([last, rest])
                last = last.slice(max(0, last.num_rows - window)).combine_chunks()
                yield batch

        for found in tie_runs(watched(), ("pass", "label", "dim")):
            n = found.num_rows
            yield pa.RecordBatch.from_arrays(
                [*found.columns, *(pa.nulls(n, k) for k in (pa.int32(), pa.int64(), pa.bool_(), *kinds))],
                names=["a", "b", "task", "place", "gap", *border],
            )
        if seen:
            rows = pa.concat_tables([*first, last]).combine_chunks()
            n = rows.num_rows
            # Where rows in between stay behind, a new stretch begins.
            gap = (np.arange(n) == window) & (seen > n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, number, np.int32)),
                    pa.array(np.arange(n)), pa.array(gap), *(rows.column(c).combine_chunks() for c in border),
                ],
                names=["a", "b", "task", "place", "gap", *border],
            )

    def over_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = 0

        def numbered() -> Iterator[pa.RecordBatch]:
            nonlocal stretch
            for batch in batches:
                numbers = stretch + np.cumsum(batch.column("gap").to_numpy(False).astype(np.int64))
                stretch = int(numbers[-1]) if len(numbers) else stretch
                yield batch.append_column("stretch", pa.array(numbers))

        yield from tie_runs(numbered(), ("stretch", "pass", "label", "dim"))

    keyed_rows = (
        heads.join(plans, ["label", "dim"], "left")
        .select("id", "label", "dim", "vec", F.coalesce("passes", F.lit(1)).alias("passes"), "centre")
        .where("passes > 0")
        .mapInArrow(tidy(keyed), "pass int, label long, dim int, key long, id long, vec binary")
    )
    order = ["pass", "label", "dim", "key", "id"]
    found = staged(
        keyed_rows.repartitionByRange(part_count(heads.sparkSession), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            linked,
            "a long, b long, task int, place long, gap boolean, pass int, label long, dim int, id long, vec binary",
        ),
        "vec-windows",
    )
    # Two windows of rows at most for each task that holds rows of a pass and label.
    run = ("pass", "label", "dim")
    borders = (
        found.where("task IS NOT NULL")
        .repartition(part_count(heads.sparkSession), *run)
        .sortWithinPartitions(*run, "task", "place")
    )
    return found.where("task IS NULL").select("a", "b").unionAll(borders.mapInArrow(tidy(over_borders), "a long, b long"))


def placed_rows(heads: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of each group (``node``, ``component``) dealt over cells that compare two of its blocks each,
    sorted by cell."""
    sizes = staged(groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n")), "vec-sizes")
    placed = (
        groups.join(sizes, "component")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
        .select(F.col("node").alias("id"), "component", "block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("with"))
        .select("id", "component", "block", F.least("block", "with").alias("c1"), F.greatest("block", "with").alias("c2"))
    )
    rows = placed.join(heads.select("id", "copies", "vec"), "id")
    return rows.repartition(part_count(heads.sparkSession), *CELL).sortWithinPartitions(*CELL, "id")


def all_pair_links(heads: DataFrame, plans: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """Edges ``a``, ``b`` that tie together all linked rows of the labels whose plan is to compare all pairs."""
    whole = heads.join(plans.where("passes = 0").select("label", "dim"), ["label", "dim"])
    first = staged(whole.groupBy("label", "dim").agg(F.min("id").alias("component")), "vec-whole")
    groups = whole.join(first, ["label", "dim"]).select(F.col("id").alias("node"), "component")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cell in key_runs(batches, CELL):
            ids, vectors = cell.column("id").to_numpy(), unit_rows(cell.column("vec"), dtype)
            left, right = np.nonzero(np.triu(vectors @ vectors.T >= threshold, 1))
            least = least_in_group(len(ids), left, right)
            at = np.flatnonzero(least != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[least[at]]), pa.array(ids[at])], names=["a", "b"])

    return placed_rows(heads, groups).mapInArrow(tidy(run), "a long, b long")


def counted_links(heads: DataFrame, groups: DataFrame, dtype: str, threshold: float) -> DataFrame:
    """``id`` and ``links`` (rows linked with it, copies counted) of every member of a group, and the edges
    between groups' members as ``least`` (smallest id linked).

    A group is cut into blocks of bounded size; a cell compares two of them and returns a count per row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, c1, c2), cell in key_runs(batches, CELL):
            ids, copies, block = (cell.column(c).to_numpy() for c in ("id", "copies", "block"))
            vectors = unit_rows(cell.column("vec"), dtype)
            one, two = np.flatnonzero(block == c1), np.flatnonzero(block == c2)
            near = vectors[one] @ vectors[two].T >= threshold
            if c1 == c2:
                np.fill_diagonal(near, False)
                out = [(one, near @ copies[two])]
            else:
                out = [(one, near @ copies[two]), (two, near.T @ copies[one])]
            for at, links in out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(links.astype(np.int64))], names=["id", "links"]
                )

    counts = placed_rows(heads, groups).mapInArrow(tidy(run), "id long, links long")
    return counts.groupBy("id").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    window: int = WINDOW,
    seed: int = 11,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of each row.

    Vectors of equal label and length are linked if their cosine, in double precision, is ``threshold`` or
    more. Rows whose vector is null, empty, zero or holds a null or non-finite value, or whose label is null,
    link with nothing and are kept. Rows without id as well, with a null component. Equal vectors of a label
    are one class, whose rows are all linked; repeated rows are such copies. An empty table gives no rows.
    Other columns are not read.
    """
    rows, dtype = vector_rows(vectors, id_col, vector_col, label_col)
    rows = staged(rows.withColumn("digest", F.sha2("vec", 256)), "vec-rows")
    usable = rows.where("vec IS NOT NULL")
    classes = staged(
        usable.groupBy("label", "digest").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("copies")), "vec-classes"
    )
    named = classes.select("label", "digest", F.col("head").alias("id"), "copies")
    heads = staged(usable.join(named, ["label", "digest", "id"]).dropDuplicates(["id", "digest"]), "vec-heads")
    plans = label_plans(heads, dtype, threshold, window, seed)
    links = window_links(heads, plans, dtype, threshold, window, seed)
    if not plans.where("passes = 0").isEmpty():
        links = links.unionAll(all_pair_links(heads, plans, dtype, threshold))
    groups = staged(components(links), "vec-groups")
    counts = counted_links(heads, groups, dtype, threshold)
    found = (
        classes.join(groups.toDF("head", "component"), "head", "left")
        .join(counts.withColumnRenamed("id", "head"), "head", "left")
        .select(
            "label", "digest",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "head").alias("component"),
        )
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(staged(found, "vec-found"), ["label", "digest"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
