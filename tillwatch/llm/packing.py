"""Best-fit packing into sequences of several permitted lengths.

Pieces are placed longest first, each into the open bin it fills best. Where none has room, the bin size
is opened whose cost per token it can expect to hold is least, given what is still to be placed; at the
end each bin shrinks to the smallest permitted length that holds its contents. Shards of bounded size
are packed apart, so that no task holds more than one shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, staged, text_or_empty, tidy
from tillwatch.llm.token_counts import count_tokens

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_PIECES = 50_000
OPENING_COST = 64.0
"""Cost of one sequence besides its length, in tokens."""


def estimated_tokens(text_col: str = "text", bytes_per_token: int = 4) -> Column:
    """A guess at a text's tokens from its UTF-8 bytes; a null or empty text has none.

    Bins packed by it may hold more real tokens than their capacity; see :func:`pack_tokens`.
    """
    return F.ceil(F.octet_length(text_or_empty(text_col)) / bytes_per_token).cast("long")


def opening_size(
    length: int, capacities: Sequence[int], opening_cost: float, smaller: Sequence[int]
) -> int:
    """Capacity of least cost per token it can expect to hold; the smaller one in a tie.

    ``smaller[i]``: tokens, not spoken for by open bins, that could still fill the gap that
    ``capacities[i]`` leaves.
    """
    best, least = 0, float("inf")
    for capacity, supply in zip(capacities, smaller, strict=True):
        if capacity < length:
            continue
        cost = (opening_cost + capacity) / min(capacity, length + supply)
        if cost < least:
            best, least = capacity, cost
    return best


def best_fit(
    lengths: np.ndarray, capacities: Sequence[int] = CAPACITIES, opening_cost: float = OPENING_COST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, and the final capacity of each bin.

    ``lengths`` are sorted, longest first, positive and at most the largest capacity. Of open bins with
    the same room, the one opened last is taken.
    """
    capacities = sorted(capacities)
    left = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]]).tolist()  # tokens from i on
    ascending = -lengths
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_gap: dict[int, list[int]] = {}  # room -> bins with that room
    gaps: list[int] = []  # rooms that occur, sorted
    filled: list[int] = []
    room = 0
    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps[at]
            number = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap], gaps[at]
            room -= length
        else:
            supply = []
            for capacity in capacities:
                first = int(np.searchsorted(ascending, -(capacity - length), "left"))
                supply.append(max(0, left[max(first, i + 1)] - room))
            gap = opening_size(length, capacities, opening_cost, supply)
            number = len(filled)
            filled.append(0)
            room += gap - length
        bins[i], offsets[i] = number, filled[number]
        filled[number] += length
        if gap := gap - length:
            if gap not in by_gap:
                by_gap[gap] = []
                insort(gaps, gap)
            by_gap[gap].append(number)
    sizes = np.array(capacities)
    final = sizes[np.searchsorted(sizes, np.array(filled, np.int64))] if filled else sizes[:0]
    return bins, offsets, final


def pack(
    docs: DataFrame,
    length: Column | None = None,
    id_col: str = "doc_id",
    capacities: Sequence[int] = CAPACITIES,
    opening_cost: float = OPENING_COST,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece of a document: id, ``piece``, ``piece_start``, ``n_tokens``, ``bin_id``,
    ``bin_offset``, ``capacity``.

    ``length`` is a column of ``docs`` in tokens (default: the guess of :func:`estimated_tokens`). A document longer than
    the largest capacity is cut into pieces of that length and a rest, so that its whole text is packed.
    A document without tokens (null or empty text) has one row with ``n_tokens`` 0 and no bin. Null ids
    stay; repeated rows are packed as often as they occur; an empty table gives no rows. Other columns
    are not read. The result does not depend on how the table is stored.
    """
    spark, largest = docs.sparkSession, max(capacities)
    n = length if length is not None else estimated_tokens()
    lengths = docs.select(F.col(id_col).alias("_id"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))
    last = F.greatest(F.floor((F.col("n") - 1) / largest), F.lit(0)).cast("long")
    pieces = lengths.select("_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        "_id",
        "piece",
        (F.col("piece") * largest).alias("piece_start"),
        F.least(F.col("n") - F.col("piece") * largest, F.lit(largest)).alias("n_tokens"),
    )
    pieces = staged(pieces, "pieces")
    shards = max(1, -(-pieces.where("n_tokens > 0").count() // shard_pieces))
    sharded = pieces.where("n_tokens > 0").withColumn(
        "shard", F.pmod(F.xxhash64("_id", "piece"), F.lit(shards))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, shard, run_no = 0, None, 0

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bins, offsets, final = best_fit(
                rows.column("n_tokens").to_numpy(), capacities, opening_cost
            )
            # A shard is packed in runs of bounded size; as a rule it is one run.
            number = ((shard << 16) + run_no << 24) + bins
            names = ["_id", "piece", "piece_start", "n_tokens"]
            return pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in names), pa.array(number), pa.array(offsets), pa.array(final[bins])],
                names=[*names, "bin_id", "bin_offset", "capacity"],
            )

        for batch in batches:
            of = batch.column("shard").to_numpy()
            start = 0
            while start < batch.num_rows:
                if of[start] != shard:
                    if held:
                        yield close()
                    held, count, shard, run_no = [], 0, int(of[start]), 0
                elif count >= 4 * shard_pieces:
                    yield close()
                    held, count, run_no = [], 0, run_no + 1
                stop = int(np.searchsorted(of[start:], shard, "right")) + start
                stop = min(stop, start + 4 * shard_pieces - count)
                held.append(batch.slice(start, stop - start))
                count += stop - start
                start = stop
        if held:
            yield close()

    kind = pieces.schema["_id"].dataType.simpleString()
    packed = (
        sharded.repartition(min(shards, part_count(spark)), "shard")
        .sortWithinPartitions("shard", F.desc("n_tokens"), "_id", "piece")
        .mapInArrow(
            tidy(run),
            f"_id {kind}, piece long, piece_start long, n_tokens long, bin_id long, bin_offset long, "
            "capacity long",
        )
    )
    nothing = F.lit(None).cast("long")
    without = pieces.where("n_tokens <= 0").select(
        "_id",
        "piece",
        "piece_start",
        F.lit(0).cast("long").alias("n_tokens"),
        *(nothing.alias(c) for c in ("bin_id", "bin_offset", "capacity")),
    )
    return packed.unionByName(without).withColumnRenamed("_id", id_col)


def pack_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: Sequence[int] = CAPACITIES,
    opening_cost: float = OPENING_COST,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """:func:`pack` by the tokens that the tokenizer gives each text, counted by :func:`count_tokens`.

    A piece holds the tokens from ``piece_start`` on of its document's ids, so long documents are cut at
    token borders and no bin holds more tokens than its capacity. Cases are those of the two.
    """
    counted = count_tokens(docs, tokenizer_path, pattern, id_col=id_col, text_col=text_col)
    return pack(counted, F.col("n_tokens"), id_col, capacities, opening_cost, shard_pieces)
