"""Streaming DataFrame to streaming DataFrame; the stateless ones serve batch frames too."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.rules import large_transfer
from tillwatch.operators.models import score
from tillwatch.schema import LARGE_TRANSFER


def with_event_time(df: DataFrame, first_hour: str = "2024-01-01 00:00:00") -> DataFrame:
    """Event time of source rows: ``step`` counts hours, the first one being 1."""
    start = F.unix_timestamp(F.lit(first_hour).cast("timestamp"))
    return df.withColumn("event_time", F.timestamp_seconds(start + (F.col("step") - 1) * 3600))


def score_stream(stream: DataFrame, model: PipelineModel, null_policy: str = "fill") -> DataFrame:
    """Score arriving rows with the model and the type codes trained in batch."""
    return score(model, stream, null_policy)


def alert_stream(stream: DataFrame, threshold: float = LARGE_TRANSFER) -> DataFrame:
    return stream.filter(large_transfer(threshold))


def hourly_totals(
    stream: DataFrame, lateness: str | None = None, window: str = "1 hour"
) -> DataFrame:
    """Rows and amount per window and type.

    A live stream sets a ``lateness``: its watermark bounds the state and drops later rows. A backlog
    must not, since its files come in any order of event time; its state is windows times types.
    """
    if lateness is not None:
        stream = stream.withWatermark("event_time", lateness)
    return (
        stream.groupBy(F.window("event_time", window).alias("window"), "type")
        .agg(F.count("*").alias("n_rows"), F.sum("amount").alias("total_amount"))
        .select(
            F.col("window.start").alias("window_start"), "type", "n_rows", "total_amount"
        )
    )


def first_seen(stream: DataFrame, key: str = "tx_id", lateness: str = "2 hours") -> DataFrame:
    """Drop repeated ids that arrive within the watermark; older ids leave the state.

    One stateful step, so that an id has one expiry. For a backlog the lateness must cover its span of
    event time (``tables.event_span``), or rows count as late.
    """
    return stream.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark([key])
