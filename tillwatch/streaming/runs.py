"""Runs of streams into written tables.

Results go to files, never to the driver: appended rows through the transactional file sink,
updated aggregates as a log of changed rows with a base now and then.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwatch.session import child_session, shared_path
from tillwatch.sources import staging

# The state of keys and windows stays on disk, so it may outgrow executor memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for stateful streams that leaves the caller's settings alone.

    ``state_partitions`` is the number of state stores of each stateful step, fixed for the life of a
    checkpoint: by default the number of cores. The shuffle partitions of batch work do not count,
    for each store has a cost of its own.
    """
    session = child_session(spark)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def start_append(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def start_batches(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    **trigger,
) -> StreamingQuery:
    """Hand each batch to a writer; it must replace what it wrote if a batch is repeated."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_updates(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], compact_every: int = 16, **trigger
) -> StreamingQuery:
    """Log the changed rows of each batch below ``path``; the last row of a key is the valid one.

    A batch writes its own rows and nothing else, to a folder of its own that a repeated batch writes anew. Every
    ``compact_every`` batches the log up to there becomes a base, which counts once its mark is set; what a base
    replaced goes with the next one, so that a reader that began before it still finds its files.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            _compact(session, batch.schema, path, keys, batch_id)

    return start_batches(stream, write_batch, checkpoint, "update", **trigger)


def _logged(spark: SparkSession, schema: T.StructType, path: str, keys: Sequence[str], upto: int | None) -> DataFrame:
    """The last row of each key in the newest base and the batches after it."""
    bases = [n for n in staging.marks(spark, path, "_base-") if upto is None or n <= upto]
    base = max(bases, default=-1)
    batches = [n for n in _numbers(spark, path, "batch_id=") if n > base and (upto is None or n <= upto)]
    parts = [(base, f"{path}/base={base}")] if bases else []
    parts += [(n, f"{path}/batch_id={n}") for n in batches]
    if not parts:
        return spark.createDataFrame([], schema)
    # The folder's name tells the batch, so one scan reads the whole log.
    rows = spark.read.schema(schema).parquet(*[p for _, p in parts]).withColumn(
        "_batch", F.regexp_extract(F.col("_metadata.file_path"), r"(?:base|batch_id)=(\d+)", 1).cast("long")
    )
    values = [f.name for f in schema if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_last"))
    return last.select(*(F.col(c) if c in keys else F.col(f"_last.{c}") for c in schema.names))


def _compact(spark: SparkSession, schema: T.StructType, path: str, keys: Sequence[str], batch_id: int) -> None:
    marks = staging.marks(spark, path, "_base-")
    if batch_id in marks:
        return  # the batch is repeated, its base is there
    _logged(spark, schema, path, keys, batch_id).write.mode("overwrite").parquet(f"{path}/base={batch_id}")
    staging.mark(spark, f"{path}/_base-{batch_id}")
    for old in marks[:-1]:
        staging.remove(spark, f"{path}/_base-{old}")
        staging.remove(spark, f"{path}/base={old}")
    for number in _numbers(spark, path, "batch_id="):
        if marks and number <= marks[-1]:
            staging.remove(spark, f"{path}/batch_id={number}")


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    names = staging.folders(spark, path)
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def read_updates(spark: SparkSession, schema: T.StructType, path: str, keys: Sequence[str]) -> DataFrame:
    """The valid rows of the log of :func:`start_updates`."""
    return _logged(spark, schema, path, keys, None)


def finish(query: StreamingQuery, timeout: float | None = None, may_drop: bool = True) -> None:
    """Wait for a run over the available data.

    A run that takes longer than ``timeout`` seconds is stopped and reported; there is none by default.
    Unless it ``may_drop`` rows as late, a run that did fails.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    dropped: dict[int, int] = {}
    ended = False
    while not ended:
        left = 5.0 if deadline is None else min(5.0, deadline - time.monotonic())
        if left <= 0:
            query.stop()
            raise TimeoutError(f"stream did not finish within {timeout} s")
        ended = query.awaitTermination(max(1, round(left)))
        for progress in query.recentProgress:
            late = (s.numRowsDroppedByWatermark for s in progress.stateOperators)
            dropped[progress.batchId] = sum(late)
    if not may_drop and sum(dropped.values()):
        raise RuntimeError(f"{sum(dropped.values())} rows came later than the watermark and were dropped")


def append_available(
    spark: SparkSession, stream: DataFrame, name: str, timeout: float | None = None, may_drop: bool = False
) -> DataFrame:
    """Run the stream over all data there is, and read its output with ``spark``."""
    out, checkpoint = shared_path(spark, f"{name}-out"), shared_path(spark, f"{name}-checkpoint")
    finish(start_append(stream, out, checkpoint), timeout, may_drop)
    staging.remove(spark, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


def update_available(
    spark: SparkSession,
    stream: DataFrame,
    name: str,
    keys: Sequence[str],
    timeout: float | None = None,
    may_drop: bool = False,
) -> DataFrame:
    """The same for updated aggregates: the last row of each key."""
    out, checkpoint = shared_path(spark, f"{name}-out"), shared_path(spark, f"{name}-checkpoint")
    finish(start_updates(stream, out, checkpoint, keys), timeout, may_drop)
    staging.remove(spark, checkpoint)
    return read_updates(spark, stream.schema, out, keys)
