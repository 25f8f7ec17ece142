from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.functions import rules
from tillwatch.operators.backtest import (
    backtest,
    backtest_by_id,
    backtest_labelled,
    matchable,
    predicted_fraud,
)
from tillwatch.operators.standardise import standardise
from tillwatch.schema import MONEY_COLUMNS, MONEY_PRECISION, SCORE_COLUMNS
from tillwatch.sources.literals import MANUAL_ROWS, manual_rows

TRUTH = "type string, amount decimal(12,2), isFraud int"
SCORED = "type string, amount decimal(12,2), prediction double"
KEYS = ("type", "amount")


def d(value):
    return None if value is None else Decimal(value)


def brute_force(truth, scored):
    """The join as it reads: all pairs with equal keys, then distinct rows."""
    return sorted(
        {
            (t[0], t[1], s[2], t[2])
            for t in truth
            for s in scored
            if t[0] is not None and t[1] is not None and t[0] == s[0] and t[1] == s[1]
        },
        key=repr,
    )


money = st.sampled_from([None, Decimal("1.00"), Decimal("2.50")])
kinds = st.sampled_from([None, "TRANSFER", "CASH_OUT"])
truths = st.lists(st.tuples(kinds, money, st.sampled_from([0, 1, 5, None])), max_size=12)
scores = st.lists(st.tuples(kinds, money, st.sampled_from([0.0, 1.0, 7.0, None])), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(truths, scores)
def test_equals_brute_force(spark, truth, scored):
    result = backtest(spark.createDataFrame(truth, TRUTH), spark.createDataFrame(scored, SCORED), KEYS)
    assert result.columns == ["type", "amount", "prediction", "isFraud"]
    assert rows(result) == brute_force(truth, scored)


def test_equals_the_sql_text(spark, tx):
    truth = standardise(tx).union(standardise(tx)).union(
        standardise(tx.withColumns({"oldbalanceDest": F.lit(None).cast("double"), "isFraud": F.lit(1)}))
    ).union(standardise(tx.withColumn("isFraud", 1 - F.col("isFraud"))))
    scored = truth.select(*SCORE_COLUMNS, F.col("isFraud").cast("double").alias("prediction"))
    truth.createOrReplaceTempView("truth_rows")
    scored.createOrReplaceTempView("scored_rows")
    same = " AND ".join(f"t.{k} = s.{k}" for k in SCORE_COLUMNS)
    columns = ", ".join(f"t.{k}" for k in SCORE_COLUMNS)
    expected = spark.sql(
        f"SELECT {columns}, s.prediction, t.isFraud FROM truth_rows t JOIN scored_rows s ON {same} "
        f"GROUP BY {columns}, s.prediction, t.isFraud"
    )
    result = backtest(truth, scored)
    assert rows(result) == rows(expected)
    assert result.dtypes == expected.dtypes
    assert result.count() == 20


def test_labelled_rows_need_no_join(spark, tx):
    flipped = tx.withColumn("isFraud", 1 - F.col("isFraud"))
    incomplete = tx.withColumn("newbalanceDest", F.lit(None).cast("double"))
    truth = standardise(tx.union(tx).union(flipped).union(incomplete))
    rule = rules.transfer_or_cash_out()
    labelled = truth.filter(rule).withColumn("prediction", F.col("amount").cast("int") % 2 * 1.0)
    joined = backtest(truth, labelled.drop("isFraud"), rule=rule)
    fused = backtest_labelled(matchable(labelled))
    assert rows(fused.select(joined.columns)) == rows(joined)
    assert joined.count() == 4


def test_rule_changes_nothing_but_the_shuffle(spark, tx):
    truth = standardise(tx)
    scored = truth.filter(rules.transfer_or_cash_out()).withColumn("prediction", F.lit(1.0))
    scored = scored.drop("isFraud")
    assert rows(backtest(truth, scored)) == rows(backtest(truth, scored, rule=rules.transfer_or_cash_out()))


def test_hot_key_collapses(spark):
    """A key with most of the rows would make billions of pairs."""
    n = 200_000
    truth = spark.range(n).selectExpr(
        "if(id % 3 = 0, id, 1) as amount", "cast(id % 2 as int) as isFraud"
    )
    scored = truth.selectExpr("amount", "cast(isFraud as double) as prediction")
    result = backtest(truth, scored, ["amount"])
    hot = result.filter("amount = 1")
    assert rows(hot.select("prediction", "isFraud")) == [(0.0, 0), (0.0, 1), (1.0, 0), (1.0, 1)]
    assert result.count() == 4 + len([i for i in range(0, n, 3)])


def test_integer_keys_match_decimals(spark):
    truth = spark.createDataFrame([("TRANSFER", d("5000.00"), 1), ("TRANSFER", d("5000.50"), 0)], TRUTH)
    scored = spark.createDataFrame([("TRANSFER", 5000, 0.0)], "type string, amount int, prediction double")
    result = backtest(truth, scored, KEYS)
    assert rows(result) == [("TRANSFER", d("5000.00"), 0.0, 1)]
    assert dict(result.dtypes)["amount"] == "decimal(12,2)"


def test_finer_decimals_are_not_rounded_into_a_match(spark):
    truth = spark.createDataFrame([("TRANSFER", d("1.23"), 1)], TRUTH)
    scored = spark.createDataFrame(
        [("TRANSFER", d("1.2345"), 0.0)], "type string, amount decimal(12,4), prediction double"
    )
    assert backtest(truth, scored, KEYS).count() == 0


def test_too_large_keys_match_nothing(spark):
    truth = spark.createDataFrame([("TRANSFER", d("1.00"), 1)], TRUTH)
    scored = spark.createDataFrame(
        [("TRANSFER", 10**15, 0.0)], "type string, amount bigint, prediction double"
    )
    assert backtest(truth, scored, KEYS).count() == 0


@pytest.mark.parametrize("odd", [3.0, 0.5, -1.0, None])
def test_any_value_is_a_class(spark, odd):
    truth = spark.createDataFrame([("TRANSFER", d("1.00"), 7), ("TRANSFER", d("1.00"), None)], TRUTH)
    scored = spark.createDataFrame([("TRANSFER", d("1.00"), odd)], SCORED)
    assert rows(backtest(truth, scored, KEYS)) == [
        ("TRANSFER", d("1.00"), odd, 7),
        ("TRANSFER", d("1.00"), odd, None),
    ]


def test_manual_rows_against_truth(spark):
    money = {c: F.col(c).cast("double") for c in MONEY_COLUMNS}
    truth = standardise(manual_rows(spark).withColumns(money), MONEY_PRECISION)
    truth = truth.withColumn("isFraud", (F.col("type") == "TRANSFER").cast("int"))
    scored = manual_rows(spark).withColumn("prediction", F.lit(0.0))
    other = truth.withColumn("amount", F.lit(d("7.00")).cast("decimal(12,2)"))
    everything = backtest(truth.union(other), scored)
    assert everything.count() == len(MANUAL_ROWS)
    assert rows(backtest(truth.union(other), scored, few_scored=True)) == rows(everything)


def test_few_scored_rows_filter_the_truth_before_its_shuffle(spark, tx):
    from tests.test_queries import plan_of
    from tillwatch.session import shared_path

    path = shared_path(spark, "truth")
    standardise(tx).write.parquet(path)
    scored = manual_rows(spark).withColumn("prediction", F.lit(0.0))
    plan = plan_of(backtest(spark.read.parquet(path), scored, few_scored=True))
    below = plan.splitlines()
    semi = next(i for i, line in enumerate(below) if "LeftSemi" in line)
    scan = next(i for i, line in enumerate(below) if "FileScan" in line)
    assert "BroadcastHashJoin" in below[semi]
    assert not any("hashpartitioning" in line for line in below[semi:scan])


def test_join_by_id_keeps_null_and_equal_rows(spark):
    truth = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "tx_id long, isFraud int")
    scored = spark.createDataFrame(
        [(1, None, 0.0), (2, 5, 1.0), (3, 5, 1.0)], "tx_id long, amount int, prediction double"
    )
    assert rows(backtest_by_id(truth, scored)) == [(1, None, 0.0, 0), (2, 5, 1.0, 1), (3, 5, 1.0, 1)]


def test_predicted_fraud(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "prediction double")
    assert rows(predicted_fraud(df)) == [(1.0,)]
