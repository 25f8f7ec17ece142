"""Business rules as predicates, usable in batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwatch.schema import LARGE_CASH_OUT, LARGE_TRANSFER


def transfer_or_large_cash_out(threshold: float = LARGE_CASH_OUT) -> Column:
    """Every TRANSFER, but only those CASH_OUT rows above the threshold."""
    return (F.col("type") == "TRANSFER") | (
        (F.col("type") == "CASH_OUT") & (F.col("amount") > F.lit(threshold))
    )


def transfer_or_cash_out() -> Column:
    return F.col("type").isin("TRANSFER", "CASH_OUT")


def large_and_flagged(threshold: float = LARGE_TRANSFER) -> Column:
    return (F.col("amount") > F.lit(threshold)) & (F.col("isFlaggedFraud") == 1)


def large_and_fraud(threshold: float = LARGE_TRANSFER) -> Column:
    return (F.col("amount") > F.lit(threshold)) & (F.col("isFraud") == 1)


def large_transfer(threshold: float = LARGE_TRANSFER) -> Column:
    return (F.col("type") == "TRANSFER") & (F.col("amount") > F.lit(threshold))
