"""Suppression of repeated ids with a table of seen ids as state.

Each batch is reduced to one row per id inside its tasks, so that a hot id costs a row per task; what the table has
seen within the lateness is dropped by an anti-join that AQE may split. The table is a folder of ids and times per
batch, spread by id hash, with a Bloom filter of ids in each file. A folder goes as soon as the watermark has passed
all its ids by the lateness, so the state covers that span of event time whatever the length of the stream. A
repeated batch looks only at folders before its own and writes its own anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.session import shared_path
from tillwatch.sources import staging
from tillwatch.streaming.runs import finish, start_batches


class SeenIds:
    """The state below ``path``: ``ids/batch_id=N`` folders, and a note per batch of its time span."""

    def __init__(self, rows: DataFrame, path: str, key: str, time_col: str):
        self.spark, self.path, self.key, self.time_col = rows.sparkSession, path, key, time_col
        self.kind = rows.schema[key].dataType.simpleString()

    def notes(self) -> dict[int, dict]:
        """Smallest and largest time (seconds) of each remembered batch, and the largest time up to it."""
        folder = f"{self.path}/notes"
        paths = [f"{folder}/{name}" for name in staging.folders(self.spark, folder)]
        if not paths:
            return {}
        lines = [json.loads(row[0]) for row in self.spark.read.schema("note string").text(paths).collect()]
        return {note["batch"]: note for note in lines}

    def live(self, batch_id: int, watermark: float, lateness: float) -> DataFrame:
        """Ids of earlier batches that the watermark has not passed by the lateness."""
        noted = [n for n, note in self.notes().items() if n < batch_id and note["max"] + lateness > watermark]
        schema = f"`{self.key}` {self.kind}, seen_at double"
        if not noted:
            return self.spark.createDataFrame([], schema)
        ids = self.spark.read.schema(schema).parquet(*[f"{self.path}/ids/{n}" for n in sorted(noted)])
        return ids.where(F.col("seen_at") + lateness > watermark).select(self.key)

    def watermark(self, batch_id: int, lateness: float) -> float:
        """As a stream has it: the largest time of all earlier batches, less the lateness."""
        return max((note["top"] for n, note in self.notes().items() if n < batch_id), default=float("-inf")) - lateness

    def add(self, rows: DataFrame, batch_id: int, top: float, lateness: float) -> None:
        """Remember the ids of a batch whose largest time is ``top``, and forget folders that have expired."""
        path = f"{self.path}/ids/{batch_id}"
        seen = rows.select(self.key, F.col(self.time_col).cast("double").alias("seen_at")).where(F.col(self.key).isNotNull())
        writer = seen.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        writer.parquet(path)
        low, high = self.spark.read.parquet(path).agg(F.min("seen_at"), F.max("seen_at")).first()
        notes = self.notes()
        above = max([top, *(note["top"] for n, note in notes.items() if n < batch_id)])
        if high is None:
            low = high = float("-inf")
        note = json.dumps({"batch": batch_id, "min": low, "max": high, "top": above})
        self.spark.createDataFrame([(note,)], "note string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/notes/{batch_id}"
        )
        # A repeated batch needs the folders its first run saw, so what expires goes one batch later.
        mark = max((n["top"] for b, n in notes.items() if b < batch_id), default=float("-inf")) - lateness
        for number, old in notes.items():
            if number < batch_id - 1 and old["max"] + lateness <= mark:
                staging.remove(self.spark, f"{self.path}/ids/{number}")
                staging.remove(self.spark, f"{self.path}/notes/{number}")


def first_rows(rows: DataFrame, key: str, time_col: str) -> DataFrame:
    """The row of each id with the smallest time."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key).agg(F.min_by(whole, time_col).alias("_row")).select("_row.*")


def start_unique(
    stream: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    key: str = "tx_id",
    time_col: str = "event_time",
    lateness_seconds: float = 7200.0,
    may_drop: bool = True,
    then: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **trigger,
) -> StreamingQuery:
    """Write the first row of each id below ``out``, a folder per batch; ``then`` is applied to what is written.

    Of the rows of an id in one batch that of the smallest time is first. An id may come again once the watermark has
    passed its first time by the lateness. Rows behind the watermark are dropped, or fail the run unless it
    ``may_drop``. Rows without id or time are no rows of the stream.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        seen = SeenIds(batch, state, key, time_col)
        watermark = seen.watermark(batch_id, lateness_seconds)
        whole = batch.where(F.col(key).isNotNull() & F.col(time_col).isNotNull())
        seconds = F.col(time_col).cast("double")
        top, late = whole.agg(F.max(seconds), F.count_if(seconds < watermark)).first()
        if late and not may_drop:
            raise RuntimeError(f"{late} rows came later than the watermark")
        one = first_rows(whole.where(seconds >= watermark), key, time_col)
        new = one.join(seen.live(batch_id, watermark, lateness_seconds), key, "left_anti").select(*batch.columns)
        path = f"{out}/batch_id={batch_id}"
        new.write.mode("overwrite").parquet(f"{state}/new")
        new = batch.sparkSession.read.schema(batch.schema).parquet(f"{state}/new")
        then(new).write.mode("overwrite").parquet(path)
        if top is not None:
            seen.add(new, batch_id, top, lateness_seconds)

    return start_batches(stream, write_batch, checkpoint, "append", **trigger)


def unique_available(
    spark: SparkSession, stream: DataFrame, name: str, timeout: float | None = None, may_drop: bool = False, **options
) -> DataFrame:
    """Run over all data there is, remove the state, and read the rows that were written with ``spark``."""
    out, state, checkpoint = (shared_path(spark, f"{name}-{part}") for part in ("out", "state", "checkpoint"))
    finish(start_unique(stream, out, state, checkpoint, may_drop=may_drop, **options), timeout)
    staging.remove(spark, checkpoint)
    staging.remove(spark, state)
    return spark.read.parquet(out).drop("batch_id")
