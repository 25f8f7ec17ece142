"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A leaf holds the rank of the pair that starts at its byte, the root the lowest rank and its leftmost
place. A merge changes the leaves of the merged pair, its right part and its left neighbour, each in
logarithmic time. Many pieces of a size are merged in step, one merge of each a round; where there are few, as with
long runs, each has a tree of its own.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import Memory, slices, text_or_empty, tidy
from tillwatch.llm.pretokens import splitter

NO_PAIR = np.iinfo(np.int64).max
KNOWN_BYTES = 16 << 20
"""What a task remembers of distinct pieces and their ids; beyond it the memory starts anew."""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in file if x.strip())}


class TreeMerger:
    """Merges batches of byte pieces in step: each round does one merge in every live piece.

    All pieces of a batch have trees of one size. Pieces of any length are merged whole; a batch is
    bounded by its bytes. A round costs as much as some ten merges one by one, so fewer pieces do without rounds.
    """

    BATCH_CELLS = 1 << 16
    IN_STEP = 10

    def __init__(self, ranks: dict[bytes, int]):
        self.id_of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # The same numbers for reading one at a time.
        self.key_list, self.rank_list = array("q", self.keys.tobytes()), array("q", self.ranks.tobytes())

    def nodes(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, bits: int):
        """Rank and place in one number, so that the smaller node is the one to merge first."""
        pairs = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        found = (right >= 0) & (left >= 0) & (self.keys[at] == pairs)
        return np.where(found, (self.ranks[at] << bits) | place, NO_PAIR)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(pieces)
        by_bits: dict[int, list[int]] = {}
        for n, piece in enumerate(pieces):
            if piece:
                by_bits.setdefault((len(piece) - 1).bit_length(), []).append(n)
        for bits, members in by_bits.items():
            step = max(1, self.BATCH_CELLS >> bits)
            for start in range(0, len(members), step):
                batch = members[start : start + step]
                if len(batch) < self.IN_STEP:
                    for n in batch:
                        out[n] = self.merge_one(pieces[n])
                    continue
                for n, ids in zip(batch, self._merge([pieces[n] for n in batch], bits), strict=True):
                    out[n] = ids
        return out

    def merge_one(self, piece: bytes) -> bytes:
        """Token ids of one piece, merge by merge; an update ends at the first node that stays as it is."""
        length = len(piece)
        bits = (length - 1).bit_length()
        size = 1 << bits
        start = np.full(size + 1, -1)
        start[:length] = self.id_of_byte[np.frombuffer(piece, np.uint8)]
        nodes = np.full(2 * size, NO_PAIR)
        if size > 1:
            nodes[size:-1] = self.nodes(start[: size - 1], start[1:size], np.arange(size - 1), bits)
            for level in range(bits - 1, -1, -1):
                a = 1 << level
                nodes[a : 2 * a] = np.minimum(nodes[2 * a : 4 * a : 2], nodes[2 * a + 1 : 4 * a : 2])
        none, mask = NO_PAIR, size - 1
        tree, ids = array("q", nodes.tobytes()), array("q", start.tobytes())
        after = array("q", range(1, length + 1))
        before = array("q", range(-1, length))
        keys, ranks, last = self.key_list, self.rank_list, len(self.key_list)

        def put(node: int, value: int) -> None:
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        def pair(left: int, right: int, place: int) -> int:
            key = (left << 32) | right
            at = bisect_left(keys, key)
            return (ranks[at] << bits) | place if at < last and keys[at] == key else none

        while size > 1 and tree[1] != none:
            here, made = tree[1] & mask, tree[1] >> bits
            gone = after[here]
            following = after[gone]
            previous = before[here]
            after[here] = following
            before[following] = here
            ids[here], ids[gone] = made, -1
            put(size + gone, none)
            put(size + here, pair(made, ids[following], here) if following < length else none)
            if previous >= 0:
                put(size + previous, pair(ids[previous], made, previous))
        found = np.frombuffer(ids, np.int64)
        return found[found >= 0].astype("<u4").tobytes()

    def _merge(self, pieces: list[bytes], bits: int) -> list[bytes]:
        size, count = 1 << bits, len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, count)
        places = np.arange(size)
        ids = np.full((count, size + 1), -1)  # the last column stands for the end
        ids[:, :size][places < lengths[:, None]] = self.id_of_byte[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        after = np.minimum(places + 1, lengths[:, None])
        after = np.concatenate([after, np.full((count, 1), size)], axis=1)
        after[after == lengths[:, None]] = size
        before = np.tile(np.arange(-1, size), (count, 1))
        tree = np.full((count, 2 * size), NO_PAIR)
        if size > 1:
            spread = np.broadcast_to(places[:-1], (count, size - 1))
            tree[:, size:-1] = self.nodes(ids[:, : size - 1], ids[:, 1:size], spread, bits)
            for level in range(bits - 1, -1, -1):
                a = 1 << level
                tree[:, a : 2 * a] = np.minimum(tree[:, 2 * a : 4 * a : 2], tree[:, 2 * a + 1 : 4 * a : 2])
        live = np.flatnonzero(tree[:, 1] != NO_PAIR)
        while len(live):
            root = tree[live, 1]
            here, made = root & (size - 1), root >> bits
            gone = after[live, here]
            following = after[live, gone]
            previous = before[live, here]
            after[live, here] = following
            before[live, following] = here
            ids[live, here] = made
            ids[live, gone] = -1
            tree[live, size + gone] = NO_PAIR
            tree[live, size + here] = self.nodes(made, ids[live, following], here, bits)
            has = previous >= 0
            behind, at = live[has], previous[has]
            tree[behind, size + at] = self.nodes(ids[behind, at], made[has], at, bits)
            rows = np.concatenate([live, live, behind])
            touched = np.concatenate([here, gone, at]) + size
            for _ in range(bits):
                touched >>= 1
                tree[rows, touched] = np.minimum(tree[rows, 2 * touched], tree[rows, 2 * touched + 1])
            live = live[tree[live, 1] != NO_PAIR]
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = read_ranks(ranks_path)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.split = splitter(pattern)
        self.merger = TreeMerger(self.ranks)
        self.known = Memory(KNOWN_BYTES)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        known = self.known
        new = list({piece for pieces in split for piece in pieces if piece not in known})
        merged = self.merger.merge([piece.encode() for piece in new])
        known.learn(new, merged)
        ids = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        known.shrink()
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _rows(df: DataFrame, id_col: str, value) -> tuple[DataFrame, str]:
    rows = df.select(F.col(id_col).alias("_id"), value)
    return rows, rows.schema["_id"].dataType.simpleString()


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` of each row's whole text.

    A null text is empty and has no ids; null ids of rows stay; repeated rows give repeated rows; an
    empty table gives no rows. Columns other than id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for part in slices(batches, "_text"):
            ids = codec.encode(part.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=[id_col, "n_tokens", "ids"],
            )

    rows, kind = _rows(docs, id_col, text_or_empty(text_col).alias("_text"))

    def forget() -> None:
        _codec(ranks_path, pattern).known.forget()

    return rows.mapInArrow(tidy(run, forget=forget), f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode_ids(
    encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``decoded`` (binary) beside the row's id, ``n_tokens`` and ``ids``; null ids decode to empty bytes.

    An id outside the vocabulary fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for part in slices(batches, "ids"):
            ids = part.column("ids").to_pylist()
            decoded = [codec.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    part.column("ids"),
                    pa.array(decoded, pa.binary()),
                ],
                names=[id_col, "n_tokens", "ids", "decoded"],
            )

    value = F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids")
    rows, kind = _rows(encoded, id_col, value)
    return rows.mapInArrow(tidy(run), f"`{id_col}` {kind}, n_tokens long, ids binary, decoded binary")
