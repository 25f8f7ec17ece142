from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.functions import rules
from tillwatch.operators import profile, quality, subsets
from tillwatch.operators.standardise import standardise
from tillwatch.schema import MODEL_COLUMNS, MONEY_COLUMNS, SCORE_COLUMNS


@pytest.fixture
def with_nulls(spark):
    return standardise(
        spark.createDataFrame(
            [(1, 5.0, None, None), (2, None, 2.5, None), (3, 7.0, 1.0, 3.0)],
            "id int, amount double, oldbalanceDest double, newbalanceDest double",
        ),
        {c: (12, 2) for c in ("amount", "oldbalanceDest", "newbalanceDest")},
    )


def test_missing_counts_on_text(spark):
    raw = spark.createDataFrame([(" ", "1"), (None, ""), ("3", None)], "amount string, oldbalanceOrg string")
    assert rows(quality.missing_counts(raw, raw.columns)) == [("amount", 1, 1), ("oldbalanceOrg", 1, 1)]


def test_missing_counts_on_numbers(with_nulls):
    columns = ("amount", "oldbalanceDest", "newbalanceDest")
    assert rows(quality.missing_counts(with_nulls, columns)) == [
        ("amount", 1, 0),
        ("newbalanceDest", 2, 0),
        ("oldbalanceDest", 1, 0),
    ]


def test_missing_counts_of_no_rows(spark, tx):
    assert {tuple(r)[1:] for r in quality.missing_counts(tx.limit(0)).collect()} == {(0, 0)}


def test_null_rows_and_presence(with_nulls):
    assert [r.id for r in quality.null_rows(with_nulls, "oldbalanceDest").collect()] == [1]
    flags = quality.presence_flag(with_nulls, "oldbalanceDest").orderBy("id")
    assert [r.oldbalanceDest for r in flags.collect()] == [0, 1, 1]


def test_fill_only_touches_recipient_balances(with_nulls):
    filled = quality.fill_balances(with_nulls).orderBy("id").collect()
    assert [float(r.newbalanceDest) for r in filled] == [0.0, 0.0, 3.0]
    assert filled[1].amount is None


def test_schema_report(tx):
    report = quality.schema_report(standardise(tx)).orderBy("ordinal").collect()
    assert [r.column_name for r in report] == tx.columns
    assert report[2].data_type == "decimal(12,2)" and report[2].n_null == 0
    assert all(r.nullable for r in report)


def test_schema_report_tells_declared_nullability(spark):
    from tillwatch.sources.literals import manual_rows

    report = {r.column_name: r.nullable for r in quality.schema_report(manual_rows(spark)).collect()}
    assert not report["amount"] and report["type"]


def test_preview_is_ordered(tx):
    assert [r.amount for r in quality.preview(tx, 2, F.desc("amount")).collect()] == [11668.14, 9839.64]


@pytest.mark.parametrize("decimals", [False, True])
def test_profile_equals_describe(tx, decimals):
    df = standardise(tx) if decimals else tx
    described = {r["summary"]: r for r in df.describe().collect()}
    for row in profile.profile(df, places=9).collect():
        name = row.column_name
        assert row.n == int(described["count"][name])
        if row.min_text is not None:
            assert (row.min_text, row.max_text) == (described["min"][name], described["max"][name])
            assert row.mean is None and described["mean"][name] is None
        else:
            assert row.mean == pytest.approx(float(described["mean"][name]), abs=1e-6)
            assert row.stddev == pytest.approx(float(described["stddev"][name]))
            assert row.min_number == float(described["min"][name])
            assert row.max_number == float(described["max"][name])


def test_profile_of_no_rows(tx):
    result = profile.profile(standardise(tx).limit(0)).collect()
    assert {(r.n, r.mean, r.min_number, r.min_text) for r in result} == {(0, None, None, None)}


def test_pivot_leaves_missing_pairs_null(tx):
    assert rows(profile.count_by_type(tx, "isFraud")) == [
        ("CASH_OUT", None, 1, None, None),
        ("PAYMENT", 3, None, None, None),
        ("TRANSFER", None, 1, None, None),
    ]


def test_pivot_loses_no_row(spark):
    df = spark.createDataFrame(
        [("A", 0), ("A", None), ("A", 7), ("A", -1), ("B", None), (None, 1)], "type string, isFraud int"
    )
    assert rows(profile.count_by_type(df, "isFraud")) == [
        ("A", 1, None, 2, 1),
        ("B", None, None, None, 1),
        (None, None, 1, None, None),
    ]


def test_large_counts_agree_with_single_counts(spark, tx):
    df = tx.withColumns({"amount": F.col("amount") * 100, "isFlaggedFraud": F.lit(1)})
    both = profile.large_transaction_counts(df).first()
    assert both.n_flagged == profile.count_where(df, rules.large_and_flagged()).first().n_rows == 2
    assert both.n_fraud == profile.count_where(df, rules.large_and_fraud()).first().n_rows == 0


def test_subset_rule_binds_and_before_or(spark):
    df = spark.createDataFrame(
        [("TRANSFER", 5.0), ("TRANSFER", 2e6), ("CASH_OUT", 5.0), ("CASH_OUT", 2e6), ("DEBIT", 2e6)],
        "type string, amount double",
    )
    kept = rows(df.filter(rules.transfer_or_large_cash_out()))
    assert kept == [("CASH_OUT", 2e6), ("TRANSFER", 2e6), ("TRANSFER", 5.0)]
    text = "type ='TRANSFER' OR type = 'CASH_OUT' AND amount > 1000000"
    assert kept == rows(df.filter(text))
    assert kept != rows(df.filter("(type ='TRANSFER' OR type = 'CASH_OUT') AND amount > 1000000"))


def test_thresholds_are_exclusive(spark):
    df = spark.createDataFrame([("TRANSFER", 200_000.0), ("TRANSFER", 200_000.01)], "type string, amount double")
    assert df.filter(rules.large_transfer()).count() == 1


def test_projections(tx):
    assert subsets.model_columns(tx).columns == list(MODEL_COLUMNS)
    subset = subsets.score_subset(tx)
    assert subset.columns == list(SCORE_COLUMNS)
    assert dict(subset.dtypes)["amount"] == "decimal(10,2)"
    assert subset.count() == 2
    assert set(MONEY_COLUMNS) < set(SCORE_COLUMNS)
