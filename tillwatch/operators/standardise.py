"""Money columns to exact decimals in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.money import overflows, to_money
from tillwatch.schema import MONEY_COLUMNS, MONEY_PRECISION


def standardise(
    df: DataFrame, precision: Mapping[str, tuple[int, int]] = MONEY_PRECISION
) -> DataFrame:
    """Replace money columns by decimals of the given (precision, scale); overflow gives NULL."""
    return df.withColumns({c: to_money(F.col(c), *ps) for c, ps in precision.items()})


def overflow_rows(
    df: DataFrame, precision: int, scale: int = 2, columns: Sequence[str] = MONEY_COLUMNS
) -> DataFrame:
    """Rows in which a narrower decimal loses a value, with one flag per money column."""
    flags = {f"{c}_overflow": overflows(F.col(c), precision, scale) for c in columns}
    fits = {c: F.when(~F.col(f"{c}_overflow"), to_money(F.col(c), precision, scale)) for c in columns}
    lost = reduce(Column.__or__, [F.col(flag) for flag in flags])
    return df.withColumns(flags).filter(lost).withColumns(fits)
