"""Predictions joined back to the ground truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.quality import complete
from tillwatch.schema import SCORE_COLUMNS


def backtest(
    truth: DataFrame,
    scored: DataFrame,
    keys: Sequence[str] = SCORE_COLUMNS,
    label: str = "isFraud",
    prediction: str = "prediction",
    rule: Column | None = None,
    few_scored: bool = False,
) -> DataFrame:
    """Distinct (keys, prediction, label) of an inner join on values, not on an id.

    Rows with a NULL key match nothing; a key seen with both labels yields both rows. Equal rows
    would multiply in the join and collapse again afterwards, so each side is first reduced to
    one row per key, with the set of its labels or predictions, whatever they are. The
    reduction combines in each task before the shuffle, so a key that holds a third of all rows
    costs one row per task; and both sides leave it partitioned by the join keys, so neither the
    join nor the final distinct rows need another shuffle. Where ``scored`` was selected by a rule
    on key columns, give the rule: no other truth can match, so none is shuffled. Where the scored
    rows are few, say so: the truth is then reduced to their keys first, without a shuffle as long
    as the keys are below Spark's own size threshold for broadcasts.
    """
    if rule is not None:
        truth = truth.filter(rule)
    right = _one_row_per_key(_align(scored, truth, keys), keys, [prediction])
    if few_scored:
        truth = truth.join(right.select(*keys), list(keys), "left_semi")
    left = _one_row_per_key(truth, keys, [label]).alias("t")
    right = right.alias("s")
    same = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    matched = left.join(right, same).select(
        *[F.col(f"t.{k}") for k in keys], f"{label}_set", f"{prediction}_set"
    )
    for column in (prediction, label):
        matched = _unpack(matched, column)
    return matched


def backtest_labelled(
    scored: DataFrame,
    keys: Sequence[str] = SCORE_COLUMNS,
    label: str = "isFraud",
    prediction: str = "prediction",
) -> DataFrame:
    """The same result without a join, for scored rows that still carry their true label.

    Valid where the scored rows are all those of the truth that a rule on key columns admits, and
    that can match (see ``matchable``): then the rows that share a key are the same on both sides,
    and one aggregation in place of two and a join reads the truth once.
    """
    per_key = _one_row_per_key(matchable(scored, keys), keys, (label, prediction))
    for column in (prediction, label):
        per_key = _unpack(per_key, column)
    return per_key


def matchable(df: DataFrame, keys: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """Rows without a NULL key; select them before NULL balances are filled for scoring."""
    return df.filter(complete(keys))


def _one_row_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each key once, with its distinct values of each column, NULL among them.

    The values combine in each task before the shuffle. A structure around a value keeps its NULL.
    """
    sets = [F.collect_set(F.struct(F.col(c).alias("value"))).alias(f"{c}_set") for c in columns]
    return df.groupBy(*keys).agg(*sets)


def _unpack(df: DataFrame, column: str) -> DataFrame:
    """One row per value of the set."""
    each = df.withColumn(f"{column}_set", F.explode(f"{column}_set"))
    return each.withColumn(column, F.col(f"{column}_set.value")).drop(f"{column}_set")


def _align(scored: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give exact numeric keys the truth's type, or the join would shuffle the scored side again.

    Only where no digit can be lost; a value too large for the type equals no true value, and
    its NULL matches none.
    """
    casts = {}
    for key in keys:
        wanted, given = truth.schema[key].dataType, scored.schema[key].dataType
        if wanted != given and isinstance(wanted, T.DecimalType) and _scale(given) <= wanted.scale:
            casts[key] = F.col(key).try_cast(wanted)
    return scored.withColumns(casts) if casts else scored


def _scale(dtype: T.DataType) -> float:
    if isinstance(dtype, T.DecimalType):
        return dtype.scale
    return 0 if isinstance(dtype, T.IntegralType) else float("inf")


def backtest_by_id(
    truth: DataFrame,
    scored: DataFrame,
    key: str = "tx_id",
    label: str = "isFraud",
    rule: Column | None = None,
) -> DataFrame:
    """Every scored row with its true label, rows with NULL values and equal rows included.

    Where ``scored`` was selected by a rule, give it: no other truth can match, so none is shuffled.
    """
    if rule is not None:
        truth = truth.filter(rule)
    return scored.join(truth.select(key, label), key)


def predicted_fraud(df: DataFrame) -> DataFrame:
    return df.filter("prediction = 1")
