"""Projections and business subsets that feed training, scoring and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tillwatch.functions.rules import large_transfer, transfer_or_cash_out
from tillwatch.operators.standardise import standardise
from tillwatch.schema import LARGE_TRANSFER, MODEL_COLUMNS, SCORE_COLUMNS, SCORING_PRECISION


def _kept(df: DataFrame, keep: tuple[str, ...]) -> list[str]:
    return [c for c in keep if c in df.columns]


def model_columns(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*_kept(df, keep), *MODEL_COLUMNS)


def score_subset(df: DataFrame, rule: Column | None = None, *keep: str) -> DataFrame:
    """Rows to be scored: those the rule admits, money cast for scoring.

    Label-free unless ``keep`` asks for more columns than the scored ones.
    """
    admitted = df.filter(transfer_or_cash_out() if rule is None else rule)
    return standardise(admitted.select(*_kept(df, keep), *SCORE_COLUMNS), SCORING_PRECISION)


def large_transfer_alerts(df: DataFrame, threshold: float = LARGE_TRANSFER) -> DataFrame:
    return df.filter(large_transfer(threshold))
