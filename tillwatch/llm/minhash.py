"""Near-duplicates by bottom-k sketches from one hash function.

A document's sketch is the k smallest hashes of its word shingles. Inverted lists of retained values give
pairs that overlap, the sketch of the union estimates their similarity, and exact sets confirm it.

Only the rarest values of a sketch are listed: a pair as similar as asked for shares at least t of them, so
it must meet in the first k - t + 1 in order of rarity. Values that occur once cannot meet, and most
documents list nothing. Of those that do, the full sets tell exactly which can still have a partner: a
document shares with any other at most the shingles that others have at all. Documents with equal sets are
one class from the start, so that copies cost one row. What is sought are groups: a pair that other links
already join needs no check.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, slices, staged, text_or_empty, tidy
from tillwatch.llm.components import components, least_in_group
from tillwatch.llm.runs import key_runs, release

SKETCH = 64
DEVIATIONS = 6.0
"""Standard deviations below the expected overlap of two sketches that still count as overlap."""
BLOCK = 256
"""Documents that one task compares with as many others; longer lists are cut into blocks."""
COLUMNS = 4096
"""Shingles of a block that are compared at once."""

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(count: int, seed: int) -> np.ndarray:
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed)) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, A-Z lowered, and the number of words of each text."""
    data = np.frombuffer(b"\n" + b"\n".join(texts).lower() + b"\n", np.uint8)
    space = IS_SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - starts
    offsets = np.cumsum(lengths) - lengths
    letters = data[~space].astype(np.uint64) + np.uint64(1)
    places = np.arange(len(letters)) - np.repeat(offsets, lengths)
    hashes = np.add.reduceat(coefficients(int(lengths.max()), 1)[places] * letters, offsets)
    hashes = mixed(hashes + lengths.astype(np.uint64))
    text_starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) + 1
    counts = np.bincount(np.searchsorted(text_starts, starts, "right") - 1, minlength=len(texts))
    return hashes, counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; all words as one where there are fewer."""
    hashes, counts = word_hashes(texts)
    factors = coefficients(width, 2)
    sets, at = [], 0
    for count in counts.tolist():
        words = hashes[at : at + count]
        at += count
        used = min(count, width)
        if not count:
            sets.append(words)
            continue
        total = np.zeros(count - used + 1, np.uint64)
        for i in range(used):
            total += words[i : count - used + 1 + i] * factors[i]
        sets.append(np.unique(mixed(total + np.uint64(used))))
    return sets


def least_overlap(size: int, threshold: float, k: int = SKETCH) -> int:
    """Values that the sketch of a set of ``size`` shares with that of any set as similar as asked for.

    Exact for sets that fit their sketch; for others at six standard deviations below the mean.
    """
    if size < k:
        return max(1, min(math.ceil(threshold * size - 1e-9), math.ceil(k - (1 - threshold) * k / threshold)))
    return max(1, math.floor(k * threshold - DEVIATIONS * math.sqrt(k * threshold * (1 - threshold))))


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` (of the whole set; null if empty) and ``sketch`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            sets = shingle_sets(part.column("_text").to_pylist(), width)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "digest", "sketch"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.encode(text_or_empty(text_col), "utf-8").alias("_text"))
    return rows.mapInArrow(tidy(run), "id long, n_shingles long, digest binary, sketch array<long>")


def inverted_lists(heads: DataFrame, threshold: float) -> DataFrame:
    """``value``, ``id``, ``n``: the rarest retained values of each class, without those that meet nothing."""
    postings = heads.select(F.explode("sketch").alias("value"), "id", F.col("n_shingles").alias("n"))
    shared = staged(postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "sketch-df")
    small = {size: least_overlap(size, threshold) for size in range(1, SKETCH + 1)}
    least = F.element_at(
        F.array(*(F.lit(small[s]) for s in sorted(small))), F.least(F.col("n"), F.lit(SKETCH)).cast("int")
    )
    held = F.least(F.col("n"), F.lit(SKETCH)).cast("int")
    # Values that occur once come first in order of rarity and fill places of the prefix.
    listed = (
        postings.join(shared, "value")
        .groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
        .select("id", "n", "v", (held - least + 1 - (held - F.size("v"))).alias("places"))
        .where("places > 0")
        .select("id", "n", F.explode(F.slice("v", F.lit(1), F.col("places"))).alias("v"))
        .select(F.col("v.value").alias("value"), "id", "n")
    )
    return staged(listed, "sketch-lists")


def _can_link(n1: str, c1: str, n2: str, c2: str, threshold: float) -> Column:
    """Exact: what two sets share is at most what the less shared of them shares with anyone."""
    most = F.least(c1, c2, n1, n2)
    return most * 1000 >= round(threshold * 1000) * (F.col(n1) + F.col(n2) - most)


def full_sets(docs: DataFrame, lists: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n`` and ``shingles`` (all of them, sorted) of the listed documents."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            sets = shingle_sets(part.column("_text").to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "n", "shingles"],
            )

    listed = staged(lists.select("id").distinct(), "near-listed")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.encode(text_or_empty(text_col), "utf-8").alias("_text"))
    made = texts.join(listed, "id", "left_semi").mapInArrow(tidy(make), "id long, n long, shingles array<long>")
    return staged(made.dropDuplicates(["id"]), "near-sets")


def linkable(sets: DataFrame, threshold: float) -> DataFrame:
    """``id``, ``n`` and ``c``, the number of its shingles that other listed documents have as well, of
    documents for which that number leaves a link possible."""
    each = sets.select("id", "n", F.explode("shingles").alias("shingle"))
    common = staged(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("shingle"), "near-common")
    counted = each.join(common, "shingle").groupBy("id", "n").agg(F.count(F.lit(1)).alias("c"))
    return staged(counted.where(F.col("c") * 1000 >= round(threshold * 1000) * F.col("n")), "near-linkable")


def with_leaders(lists: DataFrame, able: DataFrame) -> DataFrame:
    """Lists of linkable documents, with their length and their leader: one document picked by hash."""
    kept = staged(lists.select("value", "id").join(able, "id"), "near-kept")
    leaders = staged(
        kept.groupBy("value")
        .agg(F.min(F.struct(F.xxhash64("value", "id").alias("h"), "id", "n", "c")).alias("l"), F.count(F.lit(1)).alias("m"))
        .where("m > 1")
        .select("value", "m", F.col("l.id").alias("lead"), F.col("l.n").alias("lead_n"), F.col("l.c").alias("lead_c")),
        "near-leaders",
    )
    return staged(kept.join(leaders, "value"), "near-lists")


def leader_pairs(lists: DataFrame, threshold: float) -> DataFrame:
    """Each document of a list beside the list's leader: as many pairs as there are entries."""
    able = _can_link("n", "c", "lead_n", "lead_c", threshold)
    pairs = lists.where("id <> lead").where(able)
    return pairs.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()


def _estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of paired sketches (rows of equal number), from the sketch of each union.

    Rows are sorted and filled up with the largest integer.
    """
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    none = np.iinfo(np.uint64).max
    repeated = np.zeros(both.shape, bool)
    repeated[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != none)
    distinct = np.cumsum(~repeated & (both != none), axis=1)
    # The union's sketch ends where k values are distinct, or where a whole smaller union ends.
    inside = distinct <= SKETCH
    shared = (repeated & inside).sum(1)
    total = np.minimum(distinct[:, -1], SKETCH)
    return shared / np.maximum(total, 1)


def estimate_floor(threshold: float) -> float:
    return threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / SKETCH)


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    """Sketches as rows of unsigned integers, filled up with the largest."""
    flat = column.flatten().to_numpy().view(np.uint64)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.full((len(lengths), SKETCH), np.iinfo(np.uint64).max)
    out[np.arange(SKETCH) < lengths[:, None]] = flat
    return out


def likely_pairs(pairs: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose sketches estimate a similarity near the threshold or above it."""
    floor = estimate_floor(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_sketch_matrix(batch.column(c)) for c in ("sa", "sb"))
                likely = pa.array(_estimates(x, y) >= floor)
                yield batch.select(["a", "b"]).filter(likely)

    sketch = heads.select("id", "sketch")
    joined = pairs.join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(tidy(run), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose full sets are as similar as asked for."""
    # The threshold in thousandths keeps the comparison in whole numbers.
    per_mille = round(threshold * 1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (one, two))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(1000 * common >= per_mille * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    only = sets.select("id", "shingles")
    joined = pairs.join(only.toDF("a", "xa"), "a").join(only.toDF("b", "xb"), "b")
    return joined.select("a", "b", "xa", "xb").mapInArrow(tidy(run), "a long, b long")


def list_pairs(lists: DataFrame, heads: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs in lists of a block at most that no links join yet."""
    floor, per_mille = estimate_floor(threshold), round(threshold * 1000)
    short = lists.where(F.col("m") <= BLOCK).select("value", "id", "n", "c")
    tied = short.join(groups.toDF("id", "g"), "id", "left").withColumn("g", F.coalesce("g", "id"))
    tied = staged(tied, "near-tied")
    split = tied.groupBy("value").agg(F.min("g").alias("least"), F.max("g").alias("most")).where("least <> most").select("value")
    rows = tied.join(staged(split, "near-split"), "value").join(heads.select("id", "sketch"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in key_runs(batches, ("value",)):
            ids, n, c, g = (part.column(x).to_numpy() for x in ("id", "n", "c", "g"))
            i, j = np.triu_indices(len(ids), 1)
            most = np.minimum(np.minimum(c[i], c[j]), np.minimum(n[i], n[j]))
            able = (g[i] != g[j]) & (1000 * most >= per_mille * (n[i] + n[j] - most))
            i, j = i[able], j[able]
            if not len(i):
                continue
            sketch = _sketch_matrix(part.column("sketch"))
            near = _estimates(sketch[i], sketch[j]) >= floor
            one, two = ids[i[near]], ids[j[near]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"]
            )

    count = part_count(lists.sparkSession)
    found = rows.repartition(count, "value").sortWithinPartitions("value", "id").mapInArrow(tidy(run), "a long, b long")
    return found.distinct()


def _shared(sets: list[np.ndarray], rows: int) -> np.ndarray:
    """Number of shingles that each of the first ``rows`` sets has in common with each of the others."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    kept = often[column] > 1
    owner, column = owner[kept], np.unique(column[kept], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((rows, len(sets) - rows), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        start, stop = np.searchsorted(column, [first, first + COLUMNS])
        there = np.zeros((len(sets), COLUMNS), np.float32)
        there[owner[start:stop], column[start:stop] - first] = 1
        total += there[:rows] @ there[rows:].T
    return total.astype(np.int64)


def crowd_links(lists: DataFrame, sets: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Links, as a forest of each cell, among documents that meet in lists longer than a block.

    Such lists overlap, so the documents that they tie together are compared once, not list by list. Most
    of them are joined by leaders already: the largest group among them meets only the others, and the
    others meet everyone. Both are cut into blocks; a cell compares the full sets of two blocks.
    """
    per_mille = round(threshold * 1000)
    long_lists = lists.where(F.col("m") > BLOCK)
    crowds = staged(components(long_lists.select(F.col("lead").alias("a"), F.col("id").alias("b"))), "near-crowds")
    tied = crowds.toDF("id", "crowd").join(groups.toDF("id", "g"), "id", "left")
    tied = staged(tied.withColumn("g", F.coalesce("g", "id")), "near-crowded")
    largest = (
        tied.groupBy("crowd", "g").agg(F.count(F.lit(1)).alias("size"))
        .groupBy("crowd").agg(F.max(F.struct("size", "g")).alias("l")).select("crowd", F.col("l.g").alias("main"))
    )
    marked = staged(tied.join(staged(largest, "near-largest"), "crowd").withColumn("other", F.col("g") != F.col("main")), "near-marked")
    blocks = staged(
        marked.groupBy("crowd")
        .agg(
            F.ceil(F.count_if("other") / BLOCK).cast("int").alias("others"),
            F.ceil(F.count_if(~F.col("other")) / BLOCK).cast("int").alias("mains"),
        )
        .where("others > 0"),
        "near-blocks",
    )
    # Blocks are numbered: the others from 0, then the largest group.
    placed = marked.join(blocks, "crowd").withColumn(
        "block",
        F.when(F.col("other"), F.pmod(F.xxhash64("id"), F.col("others"))).otherwise(
            F.col("others") + F.pmod(F.xxhash64("id"), F.col("mains"))
        ).cast("int"),
    )
    last = F.when(F.col("other"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    cells = placed.withColumn("with", F.explode(F.sequence(F.lit(0), last))).select(
        "crowd", "id", "g", "block", F.least("block", "with").alias("c1"), F.greatest("block", "with").alias("c2")
    )
    rows = cells.join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, first, second), cell in key_runs(batches, ("crowd", "c1", "c2")):
            ids, g, n, block = (cell.column(x).to_numpy() for x in ("id", "g", "n", "block"))
            one, two = np.flatnonzero(block == first), np.flatnonzero(block == second)
            every = [v.values.to_numpy() for v in cell.column("shingles")]
            common = _shared([every[i] for i in one] + [every[i] for i in two], len(one))
            near = 1000 * common >= per_mille * (n[one][:, None] + n[two][None] - common)
            near &= g[one][:, None] != g[two][None]
            i, j = np.nonzero(near)
            least = least_in_group(len(ids), one[i], two[j])
            tied_rows = np.flatnonzero(least != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[least[tied_rows]]), pa.array(ids[tied_rows])], names=["a", "b"]
            )

    keys = ["crowd", "c1", "c2"]
    count = part_count(lists.sparkSession)
    return rows.repartition(count, *keys).sortWithinPartitions(*keys, "id").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept`` of each row.

    Documents are linked if their sets of word shingles have a Jaccard similarity of ``threshold`` or more;
    a component is named after its smallest id, which is kept. A null, empty or blank text has an empty
    set and no links. Rows without id stay alone and kept, without component. Repeated rows get equal
    results. An empty table gives no rows. Other columns are not read.
    """
    rows = staged(sketches(docs, width, id_col, text_col), "sketches")
    named = rows.where("digest IS NOT NULL AND id IS NOT NULL")
    classes = staged(named.groupBy("digest").agg(F.min("id").alias("head")), "near-classes")
    heads = staged(
        named.join(classes, (named["id"] == classes["head"]) & (named["digest"] == classes["digest"]), "left_semi")
        .select("id", "n_shingles", "sketch")
        .dropDuplicates(["id"]),
        "near-heads",
    )
    listed = inverted_lists(heads, threshold)
    sets = full_sets(docs, listed, width, id_col, text_col)
    release(docs.sparkSession)
    lists = with_leaders(listed, linkable(sets, threshold))
    likely = staged(likely_pairs(leader_pairs(lists, threshold), heads, threshold), "near-led")
    links = staged(confirmed(likely, sets, threshold), "near-links")
    groups = staged(components(links), "near-groups")
    crossing = staged(list_pairs(lists, heads, groups, threshold), "near-crossing")
    crowded = crowd_links(lists, sets, groups, threshold)
    groups = components(links.unionAll(confirmed(crossing, sets, threshold)).unionAll(crowded))
    groups = staged(groups.toDF("head", "component"), "near-groups")
    heads_of = classes.join(groups, "head", "left").select(
        "digest", F.coalesce("component", "head").alias("component_id")
    )
    return rows.join(staged(heads_of, "near-components"), "digest", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` that stay if one document of each group does: that with the smallest id.

    Of rows that repeat an id one stays. Rows without id and texts without words stay. Cases are those of
    :func:`near_duplicates`.
    """
    found = staged(near_duplicates(docs, width, threshold, id_col, text_col), "near-found")
    gone = found.where("NOT kept").select(F.col(id_col).alias("_id"))
    repeated = staged(
        found.where(f"kept AND `{id_col}` IS NOT NULL").groupBy(F.col(id_col).alias("_id")).count().where("count > 1").select("_id"),
        "near-repeated",
    )
    leaving = staged(gone.union(repeated), "near-leaving")
    once = docs.join(leaving, docs[id_col] == leaving["_id"], "left_anti")
    one = docs.join(repeated, docs[id_col] == repeated["_id"], "left_semi").dropDuplicates([id_col])
    return once.unionByName(one)
