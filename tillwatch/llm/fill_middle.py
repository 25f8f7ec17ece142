"""Fill-in-the-middle rearrangement, cut with a wavelet matrix over character classes.

The bytes of a batch of texts are mapped to classes: bytes inside a character, line ends, blanks, first
characters of words and others. The wavelet matrix holds the classes in three bit rows with running counts, so
the number of bytes of any class before a place is a few lookups (rank). Sums of ranks count the boundaries of
a unit (characters, words, lines) before a place, and bisection on such counts locates the byte at which the
k-th unit begins. All cuts of a batch are located side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import slices, text_or_empty, tidy

# Classes of bytes. A character is any byte but INNER; a word begins at WORD or WIDE_WORD.
INNER, LINE_END, BLANK, WORD, WIDE_WORD, OTHER, WIDE = range(7)
CLASS_BITS = 3
UNITS = {
    "char": (LINE_END, BLANK, WORD, WIDE_WORD, OTHER, WIDE),
    "word": (WORD, WIDE_WORD),
    "line": (LINE_END,),
}
MARKS = ("<P>", "<S>", "<M>")
"""Prefix, suffix, middle."""
SLICE = 1 << 20
FORMS = ("plain", "psm", "spm")


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each byte of texts laid end to end; ``starts`` are the first bytes of the texts."""
    table = np.full(256, OTHER, np.uint8)
    table[0x80:0xC0] = INNER
    table[0xC0:] = WIDE
    table[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
    table[0x0A] = LINE_END
    classes = table[data]
    between = (classes == BLANK) | (classes == LINE_END)
    first = np.zeros(len(data), bool)
    first[1:] = between[:-1]
    first[starts[starts < len(data)]] = True
    classes[first & (classes == OTHER)] = WORD
    classes[first & (classes == WIDE)] = WIDE_WORD
    return classes


class WaveletMatrix:
    """Rank of small symbols in a sequence, for many places at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.rows = bits, []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level & 1).astype(bool)
            packed = np.zeros((len(ones) >> 6) + 1, np.uint64)
            raw = np.packbits(ones, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            zeros = len(ones) - int(np.count_nonzero(ones))
            self.rows.append((packed, before, zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, place: np.ndarray) -> np.ndarray:
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = packed[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return before[word] + np.bitwise_count(below)

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each place."""
        low, high = np.zeros_like(place), place
        for level, (packed, before, zeros) in enumerate(self.rows):
            low_ones, high_ones = self._ones(packed, before, low), self._ones(packed, before, high)
            if symbol >> (self.bits - 1 - level) & 1:
                low, high = zeros + low_ones, zeros + high_ones
            else:
                low, high = low - low_ones, high - high_ones
        return high - low


class Boundaries:
    """Units of texts laid end to end: how many there are, and where the k-th begins."""

    def __init__(self, data: bytes | np.ndarray, starts: np.ndarray, ends: np.ndarray, unit: str):
        data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        self.matrix = WaveletMatrix(byte_classes(data, starts), CLASS_BITS)
        self.classes, self.starts, self.ends = UNITS[unit], starts, ends
        self.at_start = self.before(starts)

    def before(self, place: np.ndarray) -> np.ndarray:
        """Boundaries before each place: the ranks of the unit's classes, or all bytes less those of the others."""
        others = [c for c in range(WIDE + 1) if c not in self.classes]
        if len(others) < len(self.classes):
            return place - sum(self.matrix.rank(c, place) for c in others)
        return sum(self.matrix.rank(c, place) for c in self.classes)

    def counts(self) -> np.ndarray:
        return self.before(self.ends) - self.at_start

    def locate(self, number: np.ndarray) -> np.ndarray:
        """Place at which unit ``number`` (from 0) of each text begins; the text's end if there is none.

        Bisection for the last place with at most ``number`` boundaries before it.
        """
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.at_start + number
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.before(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2 ** 32 of an id: hex groups of the SHA-256 of ``seed:id`` (a null id is empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def arranged(prefix: bytes, middle: bytes, suffix: bytes, form: str, marks: Sequence[bytes]) -> bytes:
    """The output; plain texts keep their order without marks."""
    p, s, m = marks
    if form == "plain":
        return prefix + middle + suffix
    if form == "psm":
        return p + prefix + s + suffix + m + middle
    return s + suffix + p + prefix + m + middle


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "char",
    plain_percent: int = 10,
    spm_percent: int = 20,
    seed: int = 1,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """Each text rearranged: id, ``n`` units, ``form``, ``prefix_units``, ``middle_units``, ``output``.

    Two numbers drawn from the id, modulo ``n + 1``, are the cuts: the smaller ends the prefix, the larger the
    middle. A unit is a character, a word with the blanks after it, or a line; what stands before the first
    word belongs to the prefix, a cut behind a text's last unit is its end. ``plain`` are empty texts, texts that
    hold a mark, and ``plain_percent`` of the others; of the rest ``spm_percent`` put the suffix first (spm), the others
    the prefix (psm). Plain texts are their own output and have null unit counts.

    A null text is empty; a null id draws as an empty one; repeated rows give equal rows; an empty table
    gives none. Other columns are not read.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}")
    signs = [m.encode() for m in marks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text", SLICE):
            texts = [t.encode() for t in part.column("_text").to_pylist()]
            ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            places = Boundaries(b"".join(texts), starts, ends, unit)
            n = places.counts()
            h1, h2, h3, h4 = (part.column(f"_h{i}").to_numpy() for i in range(1, 5))
            one, two = h1 % (n + 1), h2 % (n + 1)
            low, high = np.minimum(one, two), np.maximum(one, two)
            cut = [_cut(places, k, unit) - starts for k in (low, high)]
            plain = h3 % 100 >= 100 - plain_percent
            kind = np.where(h4 % 100 < spm_percent, 2, 1)
            forms, outputs = [], []
            for row, text in enumerate(texts):
                bare = plain[row] or not text or any(m in text for m in signs)
                forms.append(FORMS[0 if bare else kind[row]])
                a, b = int(cut[0][row]), int(cut[1][row])
                outputs.append(arranged(text[:a], text[a:b], text[b:], forms[-1], signs))
            bare = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    pa.array(n.astype(np.int64)),
                    pa.array(forms, pa.string()),
                    pa.array(low.astype(np.int64), mask=bare),
                    pa.array((high - low).astype(np.int64), mask=bare),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                names=[id_col, "n", "form", "prefix_units", "middle_units", "output"],
            )

    drawn = [h.alias(f"_h{i}") for i, h in enumerate(draws(F.col(id_col), seed), 1)]
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), *drawn)
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        tidy(run), f"`{id_col}` {kind}, n long, form string, prefix_units long, middle_units long, output string"
    )


def _cut(places: Boundaries, number: np.ndarray, unit: str) -> np.ndarray:
    """Where unit ``number`` of each text begins. A line begins behind the end of the one before it."""
    if unit == "line":
        behind = np.minimum(places.locate(np.maximum(number - 1, 0)) + 1, places.ends)
        return np.where(number == 0, places.starts, behind)
    return places.locate(number)


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form", marks: Sequence[str] = MARKS) -> Column:
    """The exact text, rebuilt from an output and its form alone, as a column of ``rows``; null if either is.

    No part holds a mark, and none can arise where a part meets one, so the first of each is the right one.
    """
    out, form = rows[output_col], rows[form_col]

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(out, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, marks[2], 1)
        return one, F.substr(rest, F.length(two) + len(marks[2]) + 1), two

    prefix, middle, suffix = parts(marks[0], marks[1])
    spm_suffix, spm_middle, spm_prefix = parts(marks[1], marks[0])
    return (
        F.when(form == "plain", out)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(spm_prefix, spm_middle, spm_suffix))
    )
