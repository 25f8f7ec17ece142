"""A stored table as a stream in the order of event time.

A backlog's files come in any order, so that a stream over them needs a lateness as wide as the table, and state
for all of it. Dealt by ranges of event time, with files dated in that order, the table is a stream that is never
late, and a watermark of hours closes windows and forgets ids as in live operation.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.session import shared_path
from tillwatch.sources import staging

FILE_ROWS = 1_000_000
LEAST_FILES = 6


def file_number(rows: int, file_rows: int = FILE_ROWS, least: int = LEAST_FILES) -> int:
    """Files of a table: of at most ``file_rows`` rows each, and enough for a stream of several batches."""
    return max(least, -(-rows // file_rows))


def in_time_order(
    df: DataFrame, time_col: str, tie_col: str, files: int | None = None, close_after: str | None = None
) -> str:
    """Folder of the table's rows, written so that a file stream reads them by ``time_col``.

    Rows of one time may share several files, in the order of ``tie_col``. Rows without a time come first.
    ``close_after`` adds a last file with one row so much later, its other columns null: it moves a watermark
    past every window before it, while its own window stays open.
    """
    spark = df.sparkSession
    path = shared_path(spark, "replay")
    number = files or file_number(df.count())
    ordered = df.repartitionByRange(number, time_col, tie_col).sortWithinPartitions(time_col, tie_col)
    ordered.write.parquet(path)
    start = int(time.time() * 1000) - 86_400_000
    after = staging.date_in_order(spark, path, start)
    if close_after is not None:
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name != time_col]
        last = df.agg((F.max(time_col) + F.expr(f"INTERVAL {close_after}")).alias(time_col)).where(F.col(time_col).isNotNull())
        closing = last.select(time_col, *others).select(*df.columns)
        closing_path = f"{path}-closing"
        closing.coalesce(1).write.parquet(closing_path)
        staging.date_in_order(spark, closing_path, after)
        staging.move_parts(spark, closing_path, path)
    return path
