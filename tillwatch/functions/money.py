"""Exact money: overflow becomes NULL instead of failing the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def to_money(value: Column, precision: int = 12, scale: int = 2) -> Column:
    """A number as decimal, rounded half up; NULL where it does not fit."""
    return value.try_cast(DecimalType(precision, scale))


def overflows(value: Column, precision: int = 12, scale: int = 2) -> Column:
    """True where a present number does not fit the decimal.

    Spark's try_cast builds and drops an exception for each overflow, which is slow where they are
    many. So a comparison tells the numbers that are plainly too large, and the cast decides only
    those that rounding may carry over.
    """
    plainly = F.abs(value) >= F.lit(10 ** (precision - scale))
    return F.when(plainly, True).otherwise(
        value.isNotNull() & to_money(value, precision, scale).isNull()
    )


def is_blank(raw: Column) -> Column:
    """Blank test on the raw text; a typed column can never be blank."""
    return F.trim(raw) == F.lit("")
