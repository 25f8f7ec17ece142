"""Missing values, fills, schema and preview."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillwatch.functions.money import is_blank
from tillwatch.schema import MONEY_COLUMNS


def _one_row_per_column(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


def missing_counts(df: DataFrame, columns: Sequence[str] = MONEY_COLUMNS) -> DataFrame:
    """NULL and blank counts of all columns in one pass; only text columns can be blank."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    blanks = [F.count_if(is_blank(F.col(c))).alias(f"blank_{c}") for c in columns if c in text]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"null_{c}").alias("n_null"),
            (F.col(f"blank_{c}") if c in text else F.lit(0).cast("bigint")).alias("n_blank"),
        )
        for c in columns
    ]
    return df.agg(*nulls, *blanks).select(_one_row_per_column(rows))


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def fill_balances(
    df: DataFrame, columns: Sequence[str] | None = ("oldbalanceDest", "newbalanceDest")
) -> DataFrame:
    """Put 0 in place of NULL; without columns, in all numeric ones."""
    return df.fillna(0, subset=None if columns is None else list(columns))


def complete(columns: Sequence[str] = MONEY_COLUMNS) -> Column:
    """True where none of the columns is NULL."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def presence_flag(df: DataFrame, column: str) -> DataFrame:
    """Replace a column by 1 where it has a value, else 0."""
    return df.withColumn(column, F.when(F.col(column).isNull(), 0).otherwise(1))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type, declared nullability and observed NULL count of every column, in one pass."""
    fields = list(df.schema)
    counts = df.agg(
        F.count("*").alias("n_rows"), *[F.count(F.col(f.name)).alias(f"present_{f.name}") for f in fields]
    )
    rows = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            (F.col("n_rows") - F.col(f"present_{f.name}")).alias("n_null"),
        )
        for i, f in enumerate(fields, start=1)
    ]
    return counts.select(_one_row_per_column(rows))


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a given order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)
