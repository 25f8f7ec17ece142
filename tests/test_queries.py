"""Every registered query against its SQL counterpart, and the plans they run as."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry_point
from tests import oracle

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()
OWN = {n for n in QUERIES if not n.startswith("op") and n != "pipeline"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


# These return learned values, which SQL cannot repeat; their `_checks` twins have SQL, and
# tests/test_model_table.py compares their values.
LEARNED = {
    "random_split", "lr_certificate", "lr_evaluation", "rf_evaluation", "forest_nodes", "forest_leaves",
    "rf_holdout_table_scores", "backtest_lr", "backtest_rf", "predicted_fraud_rf",
}


def test_every_query_has_sql():
    assert OWN - LEARNED <= set(ORACLES) <= set(QUERIES) - LEARNED


@pytest.mark.parametrize("name", sorted(OWN - LEARNED))
def test_matches_sql(spark, sf_dir, connection, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


def test_entry_returns_rows(spark):
    result = entry_point.entry(spark)
    assert result.columns[-3:] == ["is_class", "same_alone", "table_ok"]
    assert result.count() > 0


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["profile_raw", "profile_decimal", "profile_model_columns", "profile_scored"])
def test_profiles_read_a_table(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Join" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("name", ["backtest_join", "backtest_join_duplicates", "backtest_by_id", "manual_backtest"])
def test_backtests_derive_nothing_again(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 1, plan
    assert plan.count("Exchange hashpartitioning") == 2, plan


@pytest.mark.parametrize("name", sorted(n for n in OWN if "stream" not in n))
def test_plan_without_broadcast_has_no_cross_join(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(n for n in OWN if "stream" not in n))
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "ExistingRDD"):
        assert bad not in plan, f"{bad} in\n{plan}"


def test_backtest_shuffles_each_side_once(spark):
    from tillwatch.operators.backtest import backtest, backtest_labelled
    from tillwatch.schema import SCORE_COLUMNS

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        columns = [f"cast(id as decimal(12,2)) as {c}" for c in SCORE_COLUMNS if c != "type"]
        rows = spark.range(100).selectExpr(
            *columns, "if(id % 3 = 0, 'A', 'B') as type", "cast(id % 2 as int) as isFraud", "0.0d as prediction"
        )
        scored = rows.withColumn("amount", rows["amount"].cast("decimal(10,2)"))
        plan = plan_of(backtest(rows.drop("prediction"), scored.drop("isFraud")))
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert plan_of(backtest_labelled(rows)).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["large_fraud_count"](spark, sf_dir))
    orders = next(line for line in plan.splitlines() if "orders.parquet" in line)
    read = orders.split("ReadSchema:")[1]
    assert "o_orderdate" not in read and "o_orderstatus" not in read
    assert "o_orderpriority, [1-URGENT,2-HIGH]" in orders
