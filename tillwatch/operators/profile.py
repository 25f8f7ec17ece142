"""Counts, column profiles and label pivots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
)

from tillwatch.schema import LARGE_TRANSFER


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    return row_count(df.filter(predicate))


def _mean(field: StructField) -> Column:
    """Mean as double; for exact types from the exact sum, not from Spark's 6-digit decimal mean."""
    value = F.col(field.name)
    if isinstance(field.dataType, (DecimalType, IntegralType)):
        return F.try_divide(F.sum(value).cast("double"), F.count(value))
    return F.avg(value)


def _statistics(field: StructField, places: int) -> Column:
    value = F.col(field.name)
    nothing = F.lit(None)
    if isinstance(field.dataType, NumericType):
        mean, deviation = _mean(field), F.stddev_samp(value)
        low, high = F.min(value).cast("double"), F.max(value).cast("double")
        low_text = high_text = nothing.cast("string")
    elif isinstance(field.dataType, StringType):
        mean = deviation = low = high = nothing.cast("double")
        low_text, high_text = F.min(value), F.max(value)
    else:
        raise TypeError(f"cannot profile {field.name}: {field.dataType.simpleString()}")
    return F.struct(
        F.lit(field.name).alias("column_name"),
        F.count(value).alias("n"),
        F.round(mean, places).alias("mean"),
        F.round(deviation, places).alias("stddev"),
        low.alias("min_number"),
        high.alias("max_number"),
        low_text.alias("min_text"),
        high_text.alias("max_text"),
    )


def _profile_rows(df: DataFrame, fields: list[StructField], places: int) -> DataFrame:
    one_row = df.agg(*[_statistics(f, places).alias(f"p{i}") for i, f in enumerate(fields)])
    return one_row.select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(fields))])))


def profile(df: DataFrame, columns: Sequence[str] | None = None, places: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of every column.

    One typed row per column: numbers stay numbers, text columns have no mean, and their minimum
    and maximum are lexical. Text has an aggregation of its own: a lexical minimum takes Spark off
    code generation, and together the numbers would go the same slow way. Each column of a
    columnar table is still read once.
    """
    fields = [df.schema[c] for c in (columns or df.columns)]
    text = [f for f in fields if isinstance(f.dataType, StringType)]
    numbers = [f for f in fields if f not in text]
    parts = [_profile_rows(df, part, places) for part in (numbers, text) if part]
    return reduce(DataFrame.union, parts)


def count_by_type(df: DataFrame, flag: str) -> DataFrame:
    """Rows per type and value of a 0/1 flag; a pair that never occurs stays NULL.

    Rows without a value and rows with another one have columns of their own, so the counts of a type
    add up to its rows. The columns are given, so Spark needs no extra job to discover them.
    """
    value = F.col(flag)
    cases = {
        "n_0": value == 0,
        "n_1": value == 1,
        "n_other": ~value.isin(0, 1),
        "n_null": value.isNull(),
    }
    counts = [F.nullif(F.count_if(case), F.lit(0)).alias(name) for name, case in cases.items()]
    return df.groupBy("type").agg(*counts)


def large_transaction_counts(df: DataFrame, threshold: float = LARGE_TRANSFER) -> DataFrame:
    """Both large-amount counts in one pass over the rows above the threshold."""
    large = df.filter(F.col("amount") > F.lit(threshold))
    return large.agg(
        F.count_if(F.col("isFlaggedFraud") == 1).alias("n_flagged"),
        F.count_if(F.col("isFraud") == 1).alias("n_fraud"),
    )
