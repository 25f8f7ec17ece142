"""What several operators share: table access, bounded batches, staged tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.sources.staging import read_table, write_table
from tillwatch.session import shared_path

SLICE_BYTES = 1 << 20
Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def staged(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written once below the shared folder: cuts lineage, survives a lost executor.

    The path goes on ``paths``, for a caller that removes the table when nothing reads it any more.
    """
    path = shared_path(df.sparkSession, name)
    write_table(df, path)
    if paths is not None:
        paths.append(path)
    return read_table(df, path)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``max_bytes`` per slice, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > max_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library


def tidy(run: Callable[[Batches], Batches], *, forget: Callable[[], None] = lambda: None) -> Callable[[Batches], Batches]:
    """``run`` that gives its memory back when its task ends, since Spark keeps the worker for other stages.

    ``forget`` drops what the task remembers in the worker.
    """

    def whole(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            forget()
            _trim()

    return whole


class Memory(dict):
    """What a task remembers of strings, bounded in bytes: starts anew when it holds more."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held = most, 0

    def learn(self, keys: list[str], values: list) -> None:
        """The new keys stay for the caller's batch even where the older ones have to go."""
        self.update(zip(keys, values, strict=True))
        self.held += sum(map(len, keys)) + 160 * len(keys)

    def shrink(self) -> None:
        if self.held > self.most:
            self.forget()

    def forget(self) -> None:
        self.clear()
        self.held = 0


def part_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
