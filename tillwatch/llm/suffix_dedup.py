"""Removal of repeated byte strings by suffix arrays of shards.

A string of ``length`` bytes can only repeat if the gram chosen in it repeats: the gram with the smallest hash
of all grams in the string, which is the same wherever the string stands. So

1. chosen grams are counted over the whole corpus, about one in 85 bytes;
2. around each gram that occurs twice or more, the stretch whose strings chose it is cut out, and equal
   stretches become one row, so that copies of any number cost one;
3. the stretches of a gram come together in shards, whose suffix arrays are sorted by Larsson-Sadakane
   refinement as deep as a string is long: suffixes still tied then start with the same string. A gram with more
   stretches than a shard holds has several shards, merged by binary search of each one's strings in the
   others' suffix arrays. For a gram with more stretches than a task may hold, its strings are counted by
   digest instead, as an aggregation that splits over tasks;
4. the repeated places go back to their documents, where the bytes they cover are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, slices, staged, text_or_empty, tidy
from tillwatch.llm.minhash import coefficients, mixed
from tillwatch.llm.runs import release
from tillwatch.sources.staging import remove

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1_000_000
GRAM_STRETCHES = 50_000
"""Distinct stretches of one gram that a task merges; the strings of more common grams are counted by digest."""
SEPARATOR = b"\xff"
"""A byte that UTF-8 text never holds: no string that crosses it can equal one of a text."""
SLICE = 2 << 20
BLOCK = 256 << 10
"""Bytes hashed at once: their arrays stay in a core's cache."""
PLACE_BITS = 23
SEEN_LIMIT = 100_000
ADDED = ("_kept", "_kept_text", "_n_bytes", "_n_removed", "_n_spans")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on, built up by doubling."""
    table, factors = coefficients(256, 5), coefficients(8, 6)
    hashes, width = table[data], 1
    while width < GRAM:
        hashes = hashes[:-width] * factors[width.bit_length()] + hashes[width:]
        width *= 2
    return mixed(hashes)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    low, have = keys, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def chosen_grams(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Text number, gram hash, and first and last start of the strings that choose the gram, of each run.

    Starts are places inside the text. Texts together hold fewer than 2**PLACE_BITS bytes.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(sizes) - sizes
    none = np.empty(0, np.int64)
    if sizes.sum() < length or sizes.max() < length:
        return none, none, none, none
    hashes = gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    window = length - GRAM + 1
    # The hash comes first, then the place: of equal hashes the leftmost is chosen, wherever the string is.
    low = np.uint64((1 << PLACE_BITS) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    chosen = (window_minima((hashes & ~low) | places, window) & low).astype(np.int64)
    long_enough = np.flatnonzero(sizes >= length)
    counts = sizes[long_enough] - length + 1
    owner = np.repeat(long_enough, counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + firsts[owner]
    chosen = chosen[starts]
    change = np.flatnonzero((chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])) + 1
    heads = np.concatenate([[0], change])
    tails = np.concatenate([change, [len(starts)]]) - 1
    text = owner[heads]
    return text, hashes[chosen[heads]].view(np.int64), starts[heads] - firsts[text], starts[tails] - firsts[text]


def text_pieces(texts: list[bytes], length: int, most: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of bounded size: number, first byte and bytes of each piece.

    A long text is cut into pieces that overlap, so that each of its strings lies in exactly one.
    """
    numbers, firsts, pieces, size = [], [], [], 0
    for number, text in enumerate(texts):
        for first in range(0, max(1, len(text) - length + 1), most):
            piece = text[first : first + most + length - 1]
            if pieces and size + len(piece) > most:
                yield numbers, firsts, pieces
                numbers, firsts, pieces, size = [], [], [], 0
            numbers.append(number)
            firsts.append(first)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield numbers, firsts, pieces


def stable_order(keys: np.ndarray, bits: int) -> np.ndarray:
    """Order of keys below 2**bits. Key and place sort as one number where they fit into it."""
    return sorted_keys(keys, bits)[0]


def sorted_keys(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys below 2**bits, and the keys in this order."""
    places = max(1, (len(keys) - 1).bit_length())
    if bits + places > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    packed = (keys.astype(np.int64) << places) | np.arange(len(keys))
    packed.sort()
    return packed & ((1 << places) - 1), packed >> places


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks by Larsson-Sadakane refinement.

    Suffixes are sorted by their first five bytes, then only groups that are still tied are sorted by the
    rank of the suffix as many bytes further on, twice as many each time.
    """
    n, depth = len(data), 5
    padded = np.concatenate([data, np.zeros(depth, np.uint8)]).astype(np.int64)
    first = np.zeros(n, np.int64)
    for i in range(depth):
        first = (first << 8) | padded[i : i + n]
    order = stable_order(first, 8 * depth)
    edge = np.concatenate([[True], first[order[1:]] != first[order[:-1]]])
    heads = np.flatnonzero(edge)
    sizes = np.diff(np.append(heads, n))
    ranks = np.empty(n, np.int64)
    ranks[order] = np.repeat(heads, sizes)
    tied = np.flatnonzero(np.repeat(sizes, sizes) > 1)  # places in the order that belong to tied groups
    bits = (2 * n).bit_length()
    while len(tied):
        suffixes = order[tied]
        beyond = suffixes + depth
        # Of two suffixes alike up to the end of one, the shorter sorts first.
        later = n + np.where(beyond < n, ranks[np.minimum(beyond, n - 1)], -suffixes - 1)
        group = ranks[suffixes]
        number = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
        sorting = stable_order((number << bits) | later, bits + int(number[-1]).bit_length())
        suffixes, later = suffixes[sorting], later[sorting]
        order[tied] = suffixes
        edge = np.concatenate([[True], (group[1:] != group[:-1]) | (later[1:] != later[:-1])])
        heads = np.flatnonzero(edge)
        sizes = np.diff(np.append(heads, len(tied)))
        ranks[suffixes] = np.repeat(tied[heads], sizes)
        tied = tied[np.repeat(sizes, sizes) > 1]
        depth *= 2
    return order, ranks


def common_prefixes(data: np.ndarray, order: np.ndarray, ranks: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix, ``cap`` at most, of each suffix (by place in the text) with the one sorted before it.

    Kasai's walk through the text, in many stretches side by side: each step, a stretch either compares one
    more byte or goes on to its next suffix with one byte less in common.
    """
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    lane = max(64, int(np.sqrt(n)) // 2)
    at = np.arange(0, n, lane)
    stop = np.minimum(at + lane, n)
    have = np.zeros(len(at), np.int64)
    found = np.zeros(n, np.int64)
    while len(at):
        other = before[at]
        here, there = at + have, other + have
        more = (other >= 0) & (have < cap) & (here < n) & (there < n)
        more &= data[np.minimum(here, n - 1)] == data[np.minimum(there, n - 1)]
        done = ~more
        found[at[done]] = have[done]
        have = np.where(more, have + 1, np.maximum(have - 1, 0))
        at = at + done
        if (ended := at >= stop).any():
            at, have, stop = at[~ended], have[~ended], stop[~ended]
    return found


def string_ranks(data: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each string of ``length`` bytes, by the place where it starts, and the places of those that repeat.

    The refinement of :func:`suffix_array`, but no deeper than ``length``. ``left`` are the bytes from each place
    to the end of its stretch: a suffix with fewer than the depth reached is part of no string, and leaves.
    """
    depth, bits = min(5, length), len(data).bit_length()
    first = np.zeros(max(0, len(data) - depth + 1), np.int64)
    for i in range(depth):
        first = (first << 8) | data[i : i + len(first)]
    tied = np.flatnonzero(left >= depth)
    order, keys = sorted_keys(first[tied], 8 * depth)
    tied, group = tied.astype(np.int32), np.zeros(len(tied), np.int64)
    ranks = np.zeros(len(data), np.int32)
    while len(tied):
        tied = tied[order]
        # Groups stay where they are; inside one, suffixes rank by the number of those before them.
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(heads, len(tied)))
        of = group[heads]
        opens = np.concatenate([[True], of[1:] != of[:-1]])
        rank = of + heads - np.maximum.accumulate(np.where(opens, heads, 0))
        ranks[tied] = np.repeat(rank, sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        if depth == length:
            break
        step = min(depth, length - depth)
        depth += step
        tied = tied[left[tied] >= depth]
        group = ranks[tied].astype(np.int64)
        order, keys = sorted_keys((group << bits) | ranks[tied + step], 2 * bits)
    return ranks, tied


class Shard:
    """Suffix array of some stretches, and which strings of ``length`` bytes repeat in it."""

    def __init__(self, stretches: list[bytes], length: int):
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches)) + 1
        ends = np.cumsum(sizes)
        self.starts = (ends - sizes).tolist()
        self.length = length
        self.data = np.frombuffer(SEPARATOR.join([*stretches, b""]), np.uint8)
        self.left = (np.repeat(ends - 1, sizes) - np.arange(len(self.data))).astype(np.int32)
        self.ranks, again = string_ranks(self.data, self.left, length)
        self.repeated = np.zeros(len(self.data), bool)
        self.repeated[again] = True

    @cached_property
    def order(self) -> np.ndarray:
        """Places where strings start, sorted by string."""
        places = np.flatnonzero(self.left >= self.length)
        return places[np.argsort(self.ranks[places], kind="stable")]

    def holds(self, queries: np.ndarray) -> np.ndarray:
        """Whether the shard has a suffix that starts with each row of ``queries`` (bytes), by binary search."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.order))
        while (low < high).any():
            mid = (low + high) // 2
            below = self._compare(self.order[np.minimum(mid, len(self.order) - 1)], queries) < 0
            open_ = low < high
            low = np.where(open_ & below, mid + 1, low)
            high = np.where(open_ & ~below, mid, high)
        at = np.minimum(low, len(self.order) - 1)
        return (low < len(self.order)) & (self._compare(self.order[at], queries) == 0)

    def _compare(self, suffixes: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Sign of each suffix's first bytes against the query of equal row number."""
        sign = np.zeros(len(queries), np.int8)
        open_ = np.arange(len(queries))
        for i in range(queries.shape[1]):
            places = suffixes[open_] + i
            mine = np.where(places < len(self.data), self.data[np.minimum(places, len(self.data) - 1)], -1).astype(np.int16)
            theirs = queries[open_, i].astype(np.int16)
            sign[open_] = np.sign(mine - theirs)
            open_ = open_[mine == theirs]
            if not len(open_):
                break
        return sign

    def strings(self, places: np.ndarray) -> np.ndarray:
        return self.data[places[:, None] + np.arange(self.length)]


def merge_shards(shards: list[Shard], parts: list[list[tuple]]) -> None:
    """Mark strings that repeat in another shard of the same gram, by search in its suffix array."""
    for i, shard in enumerate(shards):
        open_ = [
            start + k
            for start, (_, _, stretch, often) in zip(shard.starts, parts[i], strict=True)
            for k in range(len(stretch) - shard.length + 1)
            if not often and not shard.repeated[start + k]
        ]
        places = np.array(open_, np.int64)
        for step in range(0, len(places), 4096):
            part = places[step : step + 4096]
            queries = shard.strings(part)
            hit = np.zeros(len(part), bool)
            for j, other in enumerate(shards):
                if j != i and not hit.all():
                    rest = np.flatnonzero(~hit)
                    hit[rest] = other.holds(queries[rest])
            shard.repeated[part[hit]] = True


def true_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Start and end (exclusive) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def _grams(docs: DataFrame, length: int) -> DataFrame:
    """``gram``, document key and run of each chosen gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE):
            for numbers, firsts, pieces in text_pieces(part.column("_text").to_pylist(), length, min(BLOCK, SLICE)):
                piece, grams, first, last = chosen_grams(pieces, length)
                if not len(piece):
                    continue
                rows = pa.array(np.array(numbers)[piece])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams, pa.int64()),
                        part.column("k1").take(rows),
                        part.column("k2").take(rows),
                        pa.array(((first + np.array(firsts)[piece]) << 16) | (last - first), pa.int64()),
                    ],
                    names=["gram", "k1", "k2", "run"],
                )

    return docs.mapInArrow(tidy(run), "gram long, k1 long, k2 long, run long")


def _stretches(docs: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """Stretch of each candidate run: its digest, and its bytes where a task has not met them before."""

    names = ("gram", "digest", "k1", "k2", "first", "stretch")
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        out: list[list] = [[] for _ in names]
        size, now = 0, None
        found: dict[int, int] = {}  # gram of each run of the document
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "gram", "run", "_text"))
            for k1, k2, gram, one, text in zip(*columns, strict=True):
                if (k1, k2) != now:
                    now, found = (k1, k2), {}
                if text is None:
                    found[one] = gram
                    continue
                digests = []
                for one in found:
                    first = one >> 16
                    stretch = text[first : first + (one & 0xFFFF) + length]
                    digest = hashlib.blake2b(stretch, digest_size=16).digest()
                    digests.append(digest)
                    if digest in seen:
                        out[5].append(None)
                        continue
                    if len(seen) > SEEN_LIMIT:
                        seen.clear()
                    seen.add(digest)
                    out[5].append(stretch)
                    size += len(stretch)
                out[0] += found.values()
                out[1] += digests
                out[2] += [k1] * len(found)
                out[3] += [k2] * len(found)
                out[4] += [one >> 16 for one in found]
                if size > SLICE or len(out[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)
                    out, size = [[] for _ in names], 0
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    # The runs of a document come before its text. Equal rows have equal keys: each of them finds the runs of both.
    nothing = F.lit(None)
    runs = candidates.select("k1", "k2", "gram", "run", nothing.cast("binary").alias("_text"))
    texts = docs.select("k1", "k2", nothing.cast("long").alias("gram"), nothing.cast("long").alias("run"), "_text")
    return (
        runs.unionByName(texts)
        .repartition(part_count(docs.sparkSession), "k1", "k2")
        .sortWithinPartitions("k1", "k2", F.col("_text").isNotNull())
        .mapInArrow(tidy(run), "gram long, digest binary, k1 long, k2 long, first long, stretch binary")
    )


def _judged_in_shards(distinct: DataFrame, length: int) -> DataFrame:
    """``gram``, ``digest``, ``start``, ``stop``: runs of repeated strings, by start inside the stretch."""
    names = ["gram", "digest", "start", "stop"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
        columns = zip(*rows, strict=True) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def results(shard: Shard, held: list[tuple]) -> Iterator[tuple]:
        often = np.array([h[3] for h in held])  # these occur elsewhere as a whole
        for number in np.flatnonzero(often).tolist():
            gram, digest, stretch, _ = held[number]
            yield gram, digest, 0, len(stretch) - length + 1
        # Strings start so far from the next stretch that no run of them goes on there.
        runs = np.array(true_runs(shard.repeated), np.int64).reshape(-1, 2)
        starts = np.array(shard.starts)
        owner = np.searchsorted(starts, runs[:, 0], "right") - 1
        runs, owner = runs[~often[owner]], owner[~often[owner]]
        runs -= starts[owner][:, None]
        for number, (first, stop) in zip(owner.tolist(), runs.tolist(), strict=True):
            yield *held[number][:2], first, stop

    def shard_of(held: list[tuple]) -> Shard:
        return Shard([h[2] for h in held], length)

    def of_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        own: list[tuple] = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("gram", "digest", "stretch", "n"))
            for gram, digest, stretch, n in zip(*columns, strict=True):
                if own and own[0][0] != gram:
                    yield own
                    own = []
                own.append((gram, digest, stretch, n > 1))
        if own:
            yield own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        alone: list[tuple] = []
        size = 0
        for own in of_grams(batches):
            if len(own) == 1 or all(often for *_, often in own):
                # Strings of one stretch choose the gram at different offsets, so they differ: nothing to sort. Nor
                # where every stretch occurs elsewhere as a whole.
                alone += [(gram, digest, 0, len(stretch) - length + 1) for gram, digest, stretch, often in own if often]
                if len(alone) >= 4096:
                    yield batch_of(alone)
                    alone = []
                continue
            weight = sum(len(s) + 1 for _, _, s, _ in own)
            if held and size + weight > SHARD_BYTES:
                yield batch_of(list(results(shard_of(held), held)))
                held, size = [], 0
            if weight <= SHARD_BYTES:
                held += own
                size += weight
                continue
            # One gram fills several shards: sort each, then search every shard's strings in the others.
            parts: list[list[tuple]] = [[]]
            filled = 0
            for row in own:
                if filled > SHARD_BYTES:
                    parts.append([])
                    filled = 0
                parts[-1].append(row)
                filled += len(row[2]) + 1
            shards = [shard_of(p) for p in parts]
            merge_shards(shards, parts)
            for shard, part in zip(shards, parts, strict=True):
                yield batch_of(list(results(shard, part)))
        if held:
            yield batch_of(list(results(shard_of(held), held)))
        if alone:
            yield batch_of(alone)

    return (
        distinct.repartition(part_count(distinct.sparkSession), "gram")
        .sortWithinPartitions("gram", "digest")
        .mapInArrow(tidy(run), "gram long, digest binary, start int, stop int")
    )


def _judged_by_digest(distinct: DataFrame, length: int) -> DataFrame:
    """The same for grams with too many stretches for a task: every string is counted by its digest."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "stretch", 64 << 10):
            out: list[list] = [[] for _ in range(5)]
            columns = (part.column(c).to_pylist() for c in ("gram", "digest", "stretch", "n"))
            for gram, digest, stretch, n in zip(*columns, strict=True):
                for start in range(len(stretch) - length + 1):
                    string = hashlib.blake2b(stretch[start : start + length], digest_size=16).digest()
                    for column, value in zip(out, (gram, digest, start, string, n), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                names=["gram", "digest", "start", "string", "n"],
            )

    every = distinct.mapInArrow(tidy(strings), "gram long, digest binary, start int, string binary, n long")
    often = staged(every.groupBy("string").agg(F.sum("n").alias("total")).where("total > 1"), "suffix-strings")
    return every.join(often, "string", "left_semi").select(
        "gram", "digest", "start", (F.col("start") + 1).cast("int").alias("stop")
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram_stretches: int = GRAM_STRETCHES) -> DataFrame:
    """``k1``, ``k2`` and ``spans`` (start and stop of covered bytes, unmerged) of documents with repeats.

    ``docs`` has the keys and the whole text as bytes in ``_text``.
    """
    spark = docs.sparkSession
    used: list[str] = []  # tables of finished steps

    def clear() -> None:
        release(spark)
        while used:
            remove(spark, used.pop())

    grams = staged(_grams(docs, length), "suffix-all-grams", used)
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    after: list[str] = []
    candidates = staged(grams.join(often, "gram"), "suffix-candidates", after)
    clear()
    used += after
    found = staged(_stretches(docs, candidates, length), "suffix-stretches")
    clear()
    distinct = staged(
        found.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("n"), F.any_value("stretch", True).alias("stretch")),
        "suffix-distinct",
        used,
    )
    release(spark)
    crowded = staged(
        distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > gram_stretches).select("gram"),
        "suffix-crowded",
        used,
    )
    repeats = _judged_in_shards(distinct.join(crowded, "gram", "left_anti"), length).unionByName(
        _judged_by_digest(distinct.join(crowded, "gram", "left_semi"), length)
    )
    repeats = staged(repeats, "suffix-repeats")
    clear()
    spans = found.drop("stretch").join(repeats, ["gram", "digest"]).select(
        "k1",
        "k2",
        F.struct(
            (F.col("first") + F.col("start")).alias("start"),
            (F.col("first") + F.col("stop") - 1 + length).alias("stop"),
        ).alias("span"),
    )
    return staged(spans.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans")), "suffix-spans")


def merged_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", gram_stretches: int = GRAM_STRETCHES
) -> DataFrame:
    """All columns of ``docs`` but the text, and ``_kept`` (bytes that remain), ``_kept_text`` (the same without
    characters that a cut split), ``_n_bytes``, ``_n_removed``, ``_n_spans``.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else in the table as well, in
    the same text or another; overlaps count, and no string crosses texts. A null text is empty. Null ids
    stay. Repeated rows repeat each other: of a text of ``length`` bytes or more nothing remains. An empty
    table gives no rows. Input columns stay, whatever their names, but for those that are added.
    """
    columns = [c for c in docs.columns if c not in ADDED]
    whole = F.encode(text_or_empty(text_col), "utf-8")
    k1 = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long"))
    slim = docs.select(k1.alias("k1"), F.xxhash64(text_or_empty(text_col)).alias("k2"), whole.alias("_text"))
    spans = repeated_spans(slim, length, gram_stretches)
    release(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE):
            kept, sizes, removed, counts = [], [], [], []
            for text, found in zip(part.column("_text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                runs = merged_spans(found or [])
                at, pieces = 0, []
                for start, stop in runs:
                    pieces.append(text[at:start])
                    at = stop
                kept.append(b"".join([*pieces, text[at:]]))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                counts.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    pa.array(kept, pa.binary()),
                    pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
                    *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)),
                ],
                names=["row", *ADDED],
            )

    others = [c for c in columns if c != text_col]
    row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)))
    keyed = docs.select(row.alias("row"), k1.alias("k1"), F.xxhash64(text_or_empty(text_col)).alias("k2"), whole.alias("_text"))
    joined = keyed.join(spans, ["k1", "k2"], "left").select("row", "_text", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(tidy(cut), f"row {kind}, _kept binary, _kept_text string, _n_bytes long, _n_removed long, _n_spans long")
    return out.select(
        *(F.col(f"row.c{i}").alias(c) for i, c in enumerate(others)), *ADDED
    )
