"""Token counts by rank-synchronous merging of ragged arrays.

A batch of distinct pre-tokens lies in one flat symbol array. In each round every sequence applies
its own lowest-ranked pair at all places at once, left to right; the symbols that survive are
counted. Merges only ever form pairs of a higher rank, so this gives the counts of one-by-one merging.
A long sequence has as many rounds as it has different pairs, so its places are kept by rank and a round looks at
its own places only.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import Memory, slices, text_or_empty, tidy
from tillwatch.llm.pretokens import splitter

NO_PAIR = np.iinfo(np.int64).max
KNOWN_BYTES = 16 << 20
"""What a task remembers of distinct pre-tokens and their counts; beyond it the memory starts anew."""
LONG_BYTES = 2048
"""Sequences above this length are merged each by itself."""


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


class RaggedMerger:
    """Symbols left of byte sequences under the merges of a byte-level tokenizer file."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.symbol_of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        one = self.symbol_of_byte
        self.byte_ranks = self._ranks_of(np.repeat(one, 256), np.tile(one, 256)).reshape(256, 256)

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        long = [n for n, s in enumerate(sequences) if len(s) > LONG_BYTES]
        if long:
            counts = self._counts([b"" if len(s) > LONG_BYTES else s for s in sequences])
            counts[long] = [self.long_count(sequences[n]) for n in long]
            return counts
        return self._counts(sequences)

    def long_count(self, sequence: bytes) -> int:
        """Symbols left of one sequence; its live symbols are linked, and places wait under their pair's rank."""
        size = len(sequence)
        symbols = np.full(size + 1, -1)  # the last one stands for the end
        symbols[:size] = self.symbol_of_byte[np.frombuffer(sequence, np.uint8)]
        after, before = np.arange(1, size + 2), np.arange(-1, size)
        ranks = np.full(size + 1, NO_PAIR)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            """Set the rank of the pairs that start at places, and put the places under it."""
            found = self._ranks_of(symbols[places], symbols[after[places]])
            ranks[places] = found
            places, found = places[found != NO_PAIR], found[found != NO_PAIR]
            if not len(places):
                return
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            starts = np.flatnonzero(np.diff(found, prepend=-1)).tolist()
            for a, b in zip(starts, [*starts[1:], len(found)], strict=True):
                rank = int(found[a])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(heap, rank)
                waiting[rank].append(places[a:b])

        wait(np.arange(size))
        left = size
        while heap:
            rank = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(rank)))
            places = places[ranks[places] == rank]
            if not len(places):
                continue
            # Overlaps are runs of one repeated symbol: every second place of a run merges.
            number = np.arange(len(places))
            first = np.ones(len(places), bool)
            first[1:] = after[places[:-1]] != places[1:]
            places = places[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]
            gone = after[places]
            following = after[gone]
            symbols[places] = self.made[rank]
            after[places] = following
            before[following] = places
            ranks[gone] = NO_PAIR
            left -= len(places)
            behind = before[places]
            wait(np.unique(np.concatenate([places, behind[behind >= 0]])))
        return left

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; none where the right symbol is the end."""
        if not len(self.keys):
            return np.full(len(left), NO_PAIR)
        pairs = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where((right >= 0) & (self.keys[at] == pairs), self.ranks[at], NO_PAIR)

    def _counts(self, sequences: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        counts = np.zeros(len(sequences), np.int64)
        alive = np.flatnonzero(lengths)
        lengths = lengths[alive]
        data = np.frombuffer(b"".join(sequences), np.uint8)
        symbols = self.symbol_of_byte[data]
        if not len(alive):
            return counts
        ranks = np.full(len(data), NO_PAIR)
        ranks[:-1] = self.byte_ranks[data[:-1], data[1:]]
        ranks[np.cumsum(lengths) - 1] = NO_PAIR
        while True:
            lowest = np.minimum.reduceat(ranks, np.cumsum(lengths) - lengths)
            merging = lowest != NO_PAIR
            counts[alive[~merging]] = lengths[~merging]
            if not merging.all():
                held = np.repeat(merging, lengths)
                symbols, ranks = symbols[held], ranks[held]
                alive, lengths, lowest = alive[merging], lengths[merging], lowest[merging]
                if not len(alive):
                    break
            owner = np.repeat(np.arange(len(alive)), lengths)
            chosen = ranks == np.repeat(lowest, lengths)
            places = np.flatnonzero(chosen)
            # Overlaps are runs of one repeated symbol: every second place of a run merges.
            first = np.ones(len(places), bool)
            first[1:] = np.diff(places) > 1
            run_start = places[np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))]
            places = places[(places - run_start) % 2 == 0]
            symbols[places] = self.made[ranks[places]]
            lengths = lengths - np.bincount(owner[places], minlength=len(alive))
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            symbols, ranks = symbols[keep], ranks[keep]
            # Only pairs with a new symbol have another rank than before.
            places = places - np.arange(len(places))
            ends = np.zeros(len(symbols) + 1, bool)
            ends[np.cumsum(lengths) - 1] = True
            ends[-1] = True  # what stands before the first symbol
            for at in (places, places[~ends[places - 1]] - 1):
                right = np.where(ends[at], -1, symbols[np.minimum(at + 1, len(symbols) - 1)])
                ranks[at] = self._ranks_of(symbols[at], right)
        return counts


class TokenCounter:
    """Counts of whole texts; strings of added tokens inside a text count as one token each."""

    def __init__(self, tokenizer_path: str, pattern: str):
        with open(tokenizer_path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merger = RaggedMerger(model["vocab"], pairs)
        self.split = splitter(pattern)
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.known = Memory(KNOWN_BYTES)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        if self.added is None or not self.added.search(text):
            return self.split(text), 0
        found: list[str] = []
        parts = self.added.split(text)
        for part in parts:
            found += self.split(part)
        return found, len(parts) - 1

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.pre_tokens(text) for text in texts]
        known = self.known
        # The words of this call have a table of their own: most come often, and a small table is quick.
        here = dict.fromkeys(chain.from_iterable(words for words, _ in split))
        here = dict(zip(here, map(known.get, here), strict=True))
        new = [word for word, count in here.items() if count is None]
        counted = self.merger.counts([w.encode() for w in new]).tolist()
        here.update(zip(new, counted, strict=True))
        known.learn(new, counted)
        counts = [sum(map(here.__getitem__, words)) + special for words, special in split]
        known.shrink()
        return counts


@lru_cache(maxsize=2)
def _counter(tokenizer_path: str, pattern: str) -> TokenCounter:
    return TokenCounter(tokenizer_path, pattern)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of each row's whole text.

    A null text counts as empty (0 tokens); null ids stay; repeated rows give repeated rows; an
    empty table gives no rows. Columns other than id and text are not read, so their names may
    clash. ``tokenizer_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path, pattern)
        for part in slices(batches, "_text"):
            counts = counter.counts(part.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pc.binary_length(part.column("_text")).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    def forget() -> None:
        _counter(tokenizer_path, pattern).known.forget()

    return rows.mapInArrow(tidy(run, forget=forget), schema)
