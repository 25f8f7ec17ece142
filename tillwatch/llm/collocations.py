"""Phrase collocations by prefix-free parsing.

A text is a row of words, with a mark between its pieces. Wherever the hash of a window of words is a multiple
of ``MODULUS`` a chunk begins; it reaches over the whole window that begins the next one, so that neighbours
overlap by one word less than the longest phrase. Equal passages give equal chunks whatever stands around
them, and the dictionary holds each distinct chunk once, with its frequency in the parse. Phrases are then
counted inside distinct chunks, weighted by frequency; a phrase belongs to the chunk that owns its first word,
so overlaps count once.

Phrases are counted by length, and one is looked at only where the two phrases one word shorter inside it
may be frequent. That test is a bitmap of hashes of bounded size: a false hit costs a row and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, slices, staged, text_or_empty, tidy
from tillwatch.sources.staging import remove

MODULUS = 64
"""Words of an average chunk."""
LONGEST = 4096
"""A chunk without a trigger ends after so many words, counted from its own start."""
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"
"""Stands between pieces; no UTF-8 text holds it. Written chunks have a line feed instead."""
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
"""Size of the bitmap: sixteen bits for each frequent phrase within these bounds, so at most 32 MB."""

_TO_MARK = bytes.maketrans(PIECE_ENDS + b"\t", MARK * len(PIECE_ENDS) + b" ")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def cleaned(text: str) -> bytes:
    """Words in lower case (A-Z only) between blanks, with a mark wherever a piece ends."""
    return text.encode().lower().translate(_TO_MARK).replace(MARK, b" \xff ")


class Words:
    """Words of a batch of texts as numbers in one flat array."""

    def __init__(self, texts: pa.Array, mark: bytes):
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        self.vocabulary = coded.dictionary
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes = coded.indices.to_numpy().astype(np.int64)
        words = self.vocabulary.to_pylist()
        empty = np.array([not w for w in words], bool)
        marks = np.array([w == mark for w in words], bool)
        self.hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        real = ~empty[codes] if len(codes) else np.zeros(0, bool)
        before = np.concatenate([[0], np.cumsum(real)])
        self.starts = before[offsets - offsets[0]]  # of each text, and the end of the last one
        self.codes = codes[real]
        self.is_mark = marks[self.codes] if len(self.codes) else np.zeros(0, bool)

    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; shorter at the end of the batch."""
    out = np.zeros(len(hashes), np.uint64)
    for step in range(width):
        out[: len(hashes) - step] = _mixed(out[: len(hashes) - step] * _FACTOR + hashes[step:])
    return out


def cuts(words: Words, overlap: int, modulus: int = MODULUS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """Places where chunks begin, and the text each one belongs to."""
    lengths = words.lengths()
    owner = np.repeat(np.arange(len(lengths)), lengths)
    end = words.starts[1:][owner] if len(owner) else owner
    place = np.arange(len(owner))
    hashes = window_hashes(words.hashes[words.codes], overlap)
    begins = (hashes % np.uint64(modulus) == 0) & (place + overlap <= end)
    begins[words.starts[:-1][lengths > 0]] = True
    last = np.maximum.accumulate(np.where(begins, place, 0))
    begins |= (place - last) % longest == 0
    first = np.flatnonzero(begins)
    return first, owner[first]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def parsed(
    docs: DataFrame, max_words: int, text_col: str, lang_col: str, modulus: int, longest: int
) -> DataFrame:
    """The parse of every text: ``lang``, ``chunk``, ``owned`` places, and ``n_words`` words among these."""
    overlap = max_words - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            texts = pa.array([cleaned(t) for t in part.column("_text").to_pylist()], pa.binary())
            words = Words(texts, MARK)
            if not len(words.codes):
                continue
            first, owner = cuts(words, overlap, modulus, longest)
            end = words.starts[1:][owner]
            stop = np.minimum(np.append(first[1:], end[-1]), end)  # the next chunk's start
            sizes = np.minimum(stop + overlap, end) - first
            spelled = pa.array([b"\n" if w == MARK else w for w in words.vocabulary.to_pylist()], pa.binary())
            flat = spelled.take(pa.array(words.codes[_ranges(first, sizes)]))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            chunks = pc.binary_join(pa.ListArray.from_arrays(offsets, flat), b" ")
            real = np.concatenate([[0], np.cumsum(~words.is_mark)])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("lang").take(pa.array(owner)),
                    chunks.cast(pa.string()),
                    pa.array((stop - first).astype(np.int64)),
                    pa.array((real[stop] - real[first]).astype(np.int64)),
                ],
                names=["lang", "chunk", "owned", "n_words"],
            )

    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("_text")
    )
    return rows.mapInArrow(tidy(run), "lang string, chunk string, owned long, n_words long")


def _bits(frequent: DataFrame) -> np.ndarray:
    """Bitmap of the hashes of frequent phrases, one bit a byte position; its length is a power of two."""
    wanted = 16 * frequent.count()
    size = MIN_BITS
    while size < min(wanted, MAX_BITS):
        size *= 2
    place = F.pmod("h", F.lit(size)) + 1
    parts = (
        frequent.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()  # at most MAX_BITS bits in all
    )
    out = np.zeros(size // 8, np.uint8)
    for row in parts:
        piece = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["bucket"] - 1) * len(piece)
        room = min(len(piece), len(out) - start)
        out[start : start + room] = piece[:room]
    return out


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _counted(
    dictionary: DataFrame, size: int, among: DataFrame | None = None, width: int = 0, by_hash: bool = False
) -> DataFrame:
    """``lang``, ``phrase``, its hash ``h`` and frequency ``f`` of phrases of ``size`` words in the dictionary.

    All of them, or those of which every part of ``width`` words may be in ``among``. With ``by_hash``, ``h`` and
    ``f`` alone: an upper bound that moves no text.
    """
    bits = None
    if among is not None:
        bits = dictionary.sparkSession.sparkContext.broadcast(_bits(among))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "chunk"):
            words = Words(part.column("chunk").cast(pa.binary()), b"\n")
            lengths = words.lengths()
            langs = part.column("lang").dictionary_encode()
            names = langs.dictionary
            seeds = np.array([xxhash.xxh64_intdigest(n) for n in names.to_pylist()], np.uint64)
            lang_of = np.repeat(langs.indices.to_numpy().astype(np.int64), lengths)
            place = np.arange(len(words.codes))
            end = np.repeat(words.starts[1:], lengths)
            owned = np.repeat(part.column("owned").to_numpy() + words.starts[:-1], lengths)
            hashes = words.hashes[words.codes]

            def hash_of(width: int, words=words, hashes=hashes, seeds=seeds, lang_of=lang_of) -> np.ndarray:
                return _mixed(window_hashes(hashes, width) ^ seeds[lang_of])

            # A phrase lies in its chunk and holds no mark.
            marks = np.concatenate([[0], np.cumsum(words.is_mark)])
            stop = np.minimum(place + size, len(place))
            inside = (place + size <= end) & (marks[stop] == marks[place])
            good = inside & (place < owned)
            if bits is not None:
                may = _has(bits.value, hash_of(width))
                for step in range(size - width + 1):
                    good &= np.append(may[step:], np.zeros(step, bool))
            at = np.flatnonzero(good)
            if not len(at):
                continue
            weight = np.repeat(part.column("freq").to_numpy(), lengths)[at]
            if by_hash:
                codes, group = np.unique(hash_of(size)[at], return_inverse=True)
                total = np.zeros(len(codes), np.int64)
                np.add.at(total, group, weight)
                yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(total)], names=["h", "f"])
                continue
            group = lang_of[at]
            for step in range(size):
                key = group * len(words.vocabulary) + words.codes[at + step]
                _, first, group = np.unique(key, return_index=True, return_inverse=True)
            total = np.zeros(len(first), np.int64)
            np.add.at(total, group, weight)
            chosen = at[first]
            spelled = [words.vocabulary.take(pa.array(words.codes[chosen + step])) for step in range(size)]
            phrase = pc.binary_join_element_wise(*spelled, b" ") if size > 1 else spelled[0]
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(lang_of[chosen])),
                    phrase.cast(pa.string()),
                    pa.array(hash_of(size)[chosen].view(np.int64)),
                    pa.array(total),
                ],
                names=["lang", "phrase", "h", "f"],
            )

    keys = ["h"] if by_hash else ["lang", "phrase", "h"]
    schema = ", ".join(f"{k} {'long' if k == 'h' else 'string'}" for k in keys)
    found = dictionary.select("lang", "chunk", "owned", "freq").mapInArrow(tidy(run), f"{schema}, f long")
    return found.groupBy(*keys).agg(F.sum("f").alias("f"))


def _phrase(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(frequent: list[DataFrame], totals: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` at each candidate's lowest-scoring cut.

    ``frequent`` holds ``lang``, ``phrase``, ``f`` of the words, the pairs and so on; ``totals`` gives ``n``.
    Products are decimals of 38 digits, which hold 1000 times the square of any count below 10 ** 17.
    """
    phrases = reduce(DataFrame.unionAll, (f.select("lang", "phrase", "f") for f in frequent[1:]))
    known = reduce(DataFrame.unionAll, (f.select("lang", "phrase", "f") for f in frequent[:-1]))
    size = F.size("words")
    cut_up = (
        phrases.withColumn("words", F.split("phrase", " "))
        .withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
        .select(
            "lang",
            "phrase",
            F.col("f").alias("a"),
            "cut",
            _phrase(F.lit(1), F.col("cut")).alias("first"),
            _phrase(F.col("cut") + 1, size - F.col("cut")).alias("rest"),
        )
    )

    def wide(name: str) -> str:
        return f"CAST({name} AS DECIMAL(19, 0))"

    best = (
        cut_up.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    )
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def _contained(frequent: list[DataFrame]) -> DataFrame:
    """Largest frequency ``beyond`` of a longer candidate that holds the phrase."""
    parts = []
    for size, longer in enumerate(frequent[2:], 3):
        spans = [(start, width) for width in range(2, size) for start in range(1, size - width + 2)]
        shorter = F.array(*(_phrase(F.lit(start), F.lit(width)) for start, width in spans))
        parts.append(
            longer.withColumn("words", F.split("phrase", " ")).select("lang", "f", F.explode(shorter).alias("phrase"))
        )
    return reduce(DataFrame.unionAll, parts).groupBy("lang", "phrase").agg(F.max("f").alias("beyond"))


def _first_rows(rows: DataFrame, top: int) -> DataFrame:
    """Each language's first rows with their ``rank``. Shares of a language are ranked before the whole, so
    that no task holds more than the share and the first rows of every other one."""
    order = "ORDER BY score DESC, a DESC, phrase"
    shares = part_count(rows.sparkSession)
    near = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares))).withColumn(
        "place", F.expr(f"row_number() OVER (PARTITION BY lang, share {order})")
    )
    ranked = F.expr(f"row_number() OVER (PARTITION BY lang {order})").cast("long")
    return near.where(F.col("place") <= top).withColumn("rank", ranked).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    max_words: int = 5,
    min_count: int = 100,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
    modulus: int = MODULUS,
    longest: int = LONGEST,
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces, these at blanks and tabs
    into words. ``a`` is a phrase's count, ``n`` the language's words, ``l`` and ``r`` the counts of the two
    parts at the cut whose score ``1000 * a * n // (l * r)`` is least. Phrases counted less than ``min_count``
    times, and those inside a longer one of the same count, do not appear. Ties go by count and then by the
    phrase's bytes. A null text is empty, a null language ``und``; a repeated row counts as often as it occurs;
    an empty table, or one without words, gives no rows. Other columns are not read. The result depends
    neither on how the table is stored nor on ``modulus`` and ``longest``.
    """
    if max_words < 3:
        raise ValueError("the longest phrases must have three words or more")
    spark, paths = docs.sparkSession, []
    chunks = parsed(docs, max_words, text_col, lang_col, modulus, longest)
    dictionary = staged(
        chunks.groupBy("lang", "chunk", "owned", "n_words").agg(F.count(F.lit(1)).alias("freq")), "chunks", paths
    )
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("freq") * F.col("n_words")).alias("n"))
    frequent: list[DataFrame] = []
    for size in range(1, max_words + 1):
        among, width = (frequent[-1], size - 1) if frequent else (None, 0)
        if size == 2:
            # Pairs of frequent words are mostly rare: their hashes are counted before any text of theirs moves.
            rough = _counted(dictionary, size, among, width, by_hash=True).where(F.col("f") >= min_count)
            among, width = staged(rough, "pair-hashes", paths), size
        counted = _counted(dictionary, size, among, width)
        frequent.append(staged(counted.where(F.col("f") >= min_count), f"phrases-{size}", paths))
    best = scored(frequent, totals)
    kept = best.join(_contained(frequent), ["lang", "phrase"], "left").where(
        "beyond IS NULL OR 100 * beyond < 100 * a"
    )
    found = staged(_first_rows(kept, top), "collocations")
    for path in paths:
        remove(spark, path)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
