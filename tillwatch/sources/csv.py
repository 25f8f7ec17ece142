"""CSV ingest with an explicit reject split.

All columns are read as text, so one scan serves the blank tests, the typing and the reason of
each reject. Column pruning is off for this scan: a pruned CSV scan never sees the fields that
make a row malformed, so counts would depend on the columns a query happens to select.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.money import is_blank
from tillwatch.schema import TX_COLUMNS, TX_SCHEMA

CORRUPT = "_corrupt_record"
REASON = "reject_reason"
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*TX_COLUMNS, CORRUPT)]
)
CSV_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
    "enforceSchema": "false",
}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).options(**CSV_OPTIONS).csv(path)


def read_raw_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(RAW_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(path)
    )


NUMBERS = [f for f in TX_SCHEMA if not isinstance(f.dataType, T.StringType)]


def _typed(field: T.StructField) -> str:
    return f"typed_{field.name}"


def _unreadable(field: T.StructField) -> Column:
    """The cast gave nothing though there was something; blanks are missing, not unreadable."""
    raw = F.col(field.name)
    return F.col(_typed(field)).isNull() & raw.isNotNull() & ~is_blank(raw)


def classify(raw: DataFrame) -> DataFrame:
    """Add the typed numbers, and the reason a row is rejected for, NULL where it is good."""
    typed = {_typed(f): F.col(f.name).try_cast(f.dataType) for f in NUMBERS}
    reason = reduce(
        lambda chain, f: chain.when(_unreadable(f), F.lit(f"unreadable {f.name}")),
        NUMBERS,
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed record")),
    )
    return raw.withColumns(typed).withColumn(REASON, reason)


def _typed_columns() -> list[Column]:
    """The transaction columns of classified rows; blank numbers are NULL."""
    return [F.col(_typed(f)).alias(f.name) if f in NUMBERS else F.col(f.name) for f in TX_SCHEMA]


def good_rows(raw: DataFrame) -> DataFrame:
    return classify(raw).filter(F.col(REASON).isNull()).select(*_typed_columns())


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Rejects with their reason and the text they came from."""
    return (
        classify(raw)
        .filter(F.col(REASON).isNotNull())
        .select(REASON, _raw_line().alias("raw_line"))
    )


def reject_report(raw: DataFrame) -> DataFrame:
    return rejected_rows(raw).groupBy(REASON).agg(F.count("*").alias("n_rows"))


def _raw_line() -> Column:
    cells = [F.coalesce(F.col(c), F.lit("")) for c in TX_COLUMNS]
    return F.coalesce(F.col(CORRUPT), F.concat_ws(",", *cells))


def split_once(raw: DataFrame) -> DataFrame:
    """Good and rejected rows in one frame, to be written once, partitioned by ``rejected``.

    Typed columns for all rows; the raw text only for rejects, so it costs good rows nothing.
    """
    rejected = F.col(REASON).isNotNull()
    return classify(raw).select(
        *_typed_columns(),
        F.col(REASON),
        F.when(rejected, _raw_line()).alias("raw_line"),
        rejected.alias("rejected"),
    )


def write_lines(df: DataFrame, cells: list[Column], path: str) -> None:
    """Write rows as bare comma-joined lines under a header, without any quoting.

    Lets a caller write rows with more fields than the header names. The line is one column named
    like the header; its separator and quote are characters that the text cannot hold.
    """
    line = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])
    (
        df.select(line.alias(",".join(TX_COLUMNS)))
        .write.mode("errorifexists")
        .option("header", "true")
        .option("sep", "\u0001")
        .option("quote", "\u0002")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
