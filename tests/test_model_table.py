"""Models as tables: re-scoring, paths of leaves, the certificate of the regression, and rows of learned queries."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests import oracle
from tests.conftest import rows
from tillwatch.operators import features, models
from tillwatch.operators import model_table as mt
from tillwatch.plans import shared
from tillwatch.plans.oracles import ORACLES
from tillwatch.plans.queries import QUERIES
from tillwatch.schema import FEATURE_COLUMNS, SCORE_COLUMNS


@pytest.fixture(scope="module")
def forest(spark, sf_dir):
    return shared.fitted(spark, sf_dir, "rf").stages[-1]


@pytest.fixture(scope="module")
def nodes(spark, sf_dir):
    return shared.forest_table(spark, sf_dir)


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return shared.scored_holdout(spark, sf_dir, "rf")


def different(scored, nodes, depth):
    off = F.abs(vector_to_array("probability")[1] - F.col("table_probability")) > 1e-9
    return mt.rescored(scored, nodes, depth).filter(off | (F.col("prediction") != F.col("table_prediction"))).count()


def test_table_scores_like_the_forest(forest, nodes, scored):
    assert nodes.count() == forest.totalNumNodes
    assert different(scored, nodes, forest.getMaxDepth()) == 0


def test_a_changed_table_scores_differently(forest, nodes, scored):
    broken = nodes.withColumn("threshold", F.col("threshold") * 0.5)
    assert different(scored, broken, forest.getMaxDepth()) > 0


def test_scoring_the_table_needs_no_join_and_no_python(forest, nodes, scored):
    plan = mt.rescored(scored, nodes, forest.getMaxDepth())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_a_tree_of_one_leaf(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    one = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 1.0)] * 5, ["features", "label"])
    model = RandomForestClassifier(numTrees=3, seed=1).fit(one)
    table = mt.forest_nodes(spark, model)
    assert different(model.transform(one), table, model.getMaxDepth()) == 0
    assert {r.path for r in mt.forest_leaves(table, 5, ("a", "b")).collect()} == {"true"}


def test_each_row_is_in_one_leaf_of_a_tree(forest, nodes, scored):
    """The paths as filters give the shares of the whole forest."""
    leaves = mt.forest_leaves(nodes, forest.getMaxDepth()).where("tree < 2").collect()
    values = vector_to_array("features")
    frame = scored.select(*[values[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)])
    for tree in (0, 1):
        hits = [F.expr(f"CAST({leaf.path} AS INT)") for leaf in leaves if leaf.tree == tree]
        counted = frame.select(F.aggregate(F.array(*hits), F.lit(0), lambda s, x: s + x).alias("n"))
        assert [r.n for r in counted.distinct().collect()] == [1]


def test_leaves_hold_the_rows_of_their_tree(nodes, forest):
    leaves = mt.forest_leaves(nodes, forest.getMaxDepth())
    held = {r.tree: r.n for r in leaves.groupBy("tree").agg(F.sum("n_rows").alias("n")).collect()}
    assert held == {r.tree: r.n_rows for r in nodes.where("node = 0").collect()}


def test_the_regression_is_optimal(spark, sf_dir):
    found = shared.certified(spark, sf_dir)
    assert [r.feature for r in found.collect()] == ["(intercept)", *FEATURE_COLUMNS]
    assert mt.is_optimal(found).first().optimal == 1


class Changed:
    """A regression with one coefficient multiplied or its intercept moved."""

    def __init__(self, model, factor=1.0, shift=0.0):
        weights = model.coefficients.toArray() * factor
        self.coefficients = type(model.coefficients)(weights)
        self.intercept = model.intercept + shift
        self.getRegParam, self.getElasticNetParam = model.getRegParam, model.getElasticNetParam


@pytest.mark.parametrize("factor, shift", [(1.2, 0.0), (0.8, 0.0), (0.0, 0.0), (1.0, 0.1)])
def test_a_perturbed_regression_is_not(spark, sf_dir, factor, shift):
    model = shared.fitted(spark, sf_dir, "lr")
    training, _ = shared.holdout(spark, sf_dir)
    broken = Changed(model.stages[-1], factor, shift)
    assert any(broken.coefficients.toArray()) or factor == 0
    assert mt.is_optimal(mt.certificate(broken, models.score(model, training))).first().optimal == 0


def test_the_loss_is_the_one_of_the_probabilities(spark, sf_dir):
    model = shared.fitted(spark, sf_dir, "lr")
    training, _ = shared.holdout(spark, sf_dir)
    scored = models.score(model, training)
    loss = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(scored)
    assert abs(shared.certified(spark, sf_dir).first().loss - loss) < 1e-9


@pytest.mark.parametrize("classifier", ["lr", "rf"])
def test_evaluation_returns_the_figures(spark, sf_dir, classifier):
    found = {r["class"]: r for r in QUERIES[f"{classifier}_evaluation"](spark, sf_dir).collect()}
    scored = shared.scored_holdout(spark, sf_dir, classifier).select("label", "prediction").collect()
    for label, row in found.items():
        hits = sum(r.label == r.prediction == label for r in scored)
        assert row.n_correct == hits
        assert row.n_predicted == sum(r.prediction == label for r in scored)
        assert row.recall == hits / sum(r.label == label for r in scored)


@pytest.mark.parametrize("classifier", ["lr", "rf"])
def test_backtest_returns_predictions(spark, sf_dir, classifier):
    found = QUERIES[f"backtest_{classifier}"](spark, sf_dir)
    model = shared.fitted(spark, sf_dir, classifier)
    alone = models.score(model, found.select(*SCORE_COLUMNS, F.col("prediction").alias("given")))
    assert alone.filter("prediction <> given").count() == 0
    assert found.select(*SCORE_COLUMNS, "isFraud").distinct().count() == found.count()


def test_predicted_fraud_returns_rows(spark, sf_dir):
    found = QUERIES["predicted_fraud_rf"](spark, sf_dir)
    positives = QUERIES["backtest_rf"](spark, sf_dir).filter("prediction = 1")
    assert rows(found.select(*SCORE_COLUMNS, "isFraud")) == rows(positives.select(*SCORE_COLUMNS, "isFraud"))


def test_random_split_returns_every_id(spark, sf_dir):
    found = QUERIES["random_split"](spark, sf_dir)
    ids = shared.staged_transactions(spark, sf_dir).select("tx_id")
    assert rows(found.select("tx_id")) == rows(ids)
    assert found.filter("part = 'train'").count() > found.filter("part = 'test'").count() > 0


def test_sql_sees_each_id_of_the_random_split(spark, sf_dir, monkeypatch):
    """One row per id in query and SQL, so that a split that swaps one id for another is found."""
    connection = oracle.connect(sf_dir)
    sql = ORACLES["random_split_ids"]
    assert oracle.difference(QUERIES["random_split_ids"](spark, sf_dir), connection, sql) is None
    split = features.random_split

    def swapped(df, seed):
        train, test = split(df, seed)
        largest = test.agg(F.max("tx_id")).first()[0]
        return train, test.withColumn("tx_id", F.when(F.col("tx_id") == largest, -1).otherwise(F.col("tx_id")))

    monkeypatch.setattr(features, "random_split", swapped)
    assert oracle.difference(QUERIES["random_split_ids"](spark, sf_dir), connection, sql) is not None
