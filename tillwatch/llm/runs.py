"""Runs of equal keys in sorted batches, and release of what finished steps left behind."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession


def key_runs(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Key and rows of each run of equal integer keys. Rows come sorted, so a run is a whole group."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None

    def joined() -> pa.RecordBatch:
        if len(held) == 1:
            return held[0]
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            key = tuple(c[start].item() for c in columns)
            if held and key != now:
                yield now, joined()
                held = []
            now = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield now, joined()


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written.

    They go when the driver's JVM collects what refers to them, which by itself it may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
