from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.functions.money import is_blank, overflows, to_money
from tillwatch.operators.standardise import overflow_rows, standardise
from tillwatch.schema import MONEY_COLUMNS, SCORING_PRECISION


def test_overflow_becomes_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([(99_999_999.99,), (100_000_000.0,), (None,)], "v double")
    result = df.select(to_money(F.col("v"), 10).alias("m"), overflows(F.col("v"), 10).alias("o"))
    assert [tuple(r) for r in result.collect()] == [
        (Decimal("99999999.99"), False),
        (None, True),
        (None, False),
    ]


def test_rounds_half_up(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.344,)], "v double")
    result = [r[0] for r in df.select(to_money(F.col("v"))).collect()]
    assert result == [Decimal("1.01"), Decimal("-1.01"), Decimal("2.34")]


def test_standardise_twice_changes_nothing(tx):
    once = standardise(tx)
    assert rows(standardise(once)) == rows(once)
    assert standardise(once).schema == once.schema


def test_precision_per_column(tx):
    result = dict(standardise(tx, SCORING_PRECISION).dtypes)
    assert result["amount"] == "decimal(10,2)"
    assert {result[c] for c in MONEY_COLUMNS if c != "amount"} == {"decimal(12,2)"}


def test_money_of_the_first_rows(tx):
    first = standardise(tx).select(*MONEY_COLUMNS).first()
    assert [str(v) for v in first] == ["9839.64", "170136.00", "160296.36", "0.00", "0.00"]


def test_overflow_rows_name_the_column(spark, tx):
    lost = overflow_rows(standardise(tx), 7).select("amount", "oldbalanceOrg", "oldbalanceOrg_overflow")
    assert rows(lost) == [(Decimal("9839.64"), None, True)]


def test_blank_is_not_null(spark):
    df = spark.createDataFrame([(" ",), ("",), ("0",), (None,)], "v string")
    assert [r[0] for r in df.select(is_blank(F.col("v"))).collect()] == [True, True, False, None]


def test_published_maximum_needs_twelve_digits(spark):
    df = spark.createDataFrame([(356179278.92,)], "v double")
    narrow, wide = df.select(to_money(F.col("v"), 10), to_money(F.col("v"), 12)).first()
    assert narrow is None and wide == Decimal("356179278.92")
