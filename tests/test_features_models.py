from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.operators import evaluate as ev
from tillwatch.operators import features as ft
from tillwatch.operators import models
from tillwatch.operators.standardise import standardise
from tillwatch.plans import shared
from tillwatch.session import shared_path
from tillwatch.sources.literals import manual_rows


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    return shared.staged_transactions(spark, sf_dir)


def codes(model):
    return {label: float(i) for i, label in enumerate(model.labels)}


def test_codes_by_frequency_then_name(spark):
    df = spark.createDataFrame([(t,) for t in ["B", "B", "C", "A", "A", "D"]], "type string")
    assert codes(ft.type_indexer().fit(df)) == {"A": 0.0, "B": 1.0, "C": 2.0, "D": 3.0}


def test_types_outside_the_domain_do_not_reach_the_indexer(spark):
    from tillwatch.schema import TX_TYPES

    dirty = [(f"junk{i}",) for i in range(500)] + [(None,)] + [(t,) for t in TX_TYPES]
    df = spark.createDataFrame(dirty, "type string")
    assert set(codes(ft.type_indexer().fit(ft.known_types(df)))) == set(TX_TYPES)
    assert ft.unknown_types(df).first().n_rows == 501


def test_forest_does_not_depend_on_the_layout(spark, sample, tmp_path):
    """The same rows, in one file or many and in any order, grow the same trees."""
    trees = []
    for number, frame in enumerate((sample.coalesce(1), sample.orderBy("amount").repartition(16))):
        frame.write.parquet(f"{tmp_path}/{number}")
        model = models.train(spark.read.parquet(f"{tmp_path}/{number}"), "rf")
        trees.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1]


CORES = """
import sys
from tillwatch.session import local_session
from tillwatch.operators import models
spark = local_session(int(sys.argv[1]))
print("trees", hash(models.train(spark.read.parquet(sys.argv[2]), "rf").stages[-1].toDebugString.split(chr(10), 1)[1]))
"""


def test_forest_does_not_depend_on_the_cores(spark, sample, tmp_path):
    import os
    import subprocess
    import sys

    from tests.conftest import ROOT

    sample.write.parquet(f"{tmp_path}/rows")
    env = os.environ | {"PYTHONPATH": ROOT, "PYTHONHASHSEED": "0"}
    out = [
        subprocess.run(
            [sys.executable, "-c", CORES, cores, f"{tmp_path}/rows"], env=env, capture_output=True, text=True, timeout=300
        ).stdout.split("trees ")[1]
        for cores in ("2", "4")
    ]
    assert out[0] == out[1]


def test_rows_without_a_label(spark, sample):
    some = sample.withColumn("isFraud", F.when(F.col("tx_id") % 7 != 0, F.col("isFraud")))
    with pytest.raises(Exception, match="[Nn]ull|NULL"):
        models.train(some, "lr")
    model = models.train(some, "lr", null_policy="skip")
    assert model.stages[-1].numClasses == 2
    assert models.train(some, "lr", compat_label=True).stages[-1].numClasses == 3


def test_unseen_and_null_types_get_the_next_code(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "type string")
    new = spark.createDataFrame([("B",), ("X",), (None,)], "type string")
    coded = ft.type_indexer().fit(df).transform(new)
    assert [r.type_label for r in coded.collect()] == [1.0, 2.0, 2.0]


def test_codes_of_the_hand_written_rows(spark):
    df = manual_rows(spark)
    assert codes(ft.type_indexer().fit(df)) == {"TRANSFER": 0.0, "CASH_OUT": 1.0}


def test_refit_codes_differ_from_training_codes(spark):
    counts = {"CASH_OUT": 5, "PAYMENT": 4, "CASH_IN": 3, "TRANSFER": 2, "DEBIT": 1}
    df = spark.createDataFrame([(t,) for t, n in counts.items() for _ in range(n)], "type string")
    subset = df.filter("type in ('TRANSFER', 'CASH_OUT')")
    assert rows(ft.index_skew(df, subset)) == [("CASH_OUT", 0.0, 0.0, 5), ("TRANSFER", 3.0, 1.0, 2)]


def test_feature_order(spark, tx):
    featured = ft.fit_features(standardise(tx)).transform(standardise(tx))
    first = ft.feature_columns(featured).first()
    assert tuple(first) == (9839.64, 170136.0, 160296.36, 0.0, 0.0, 0.0)


@pytest.mark.parametrize(("policy", "n"), [("fill", 3), ("skip", 2)])
def test_null_policies(spark, policy, n):
    values = [("A", 1.0, None), ("A", 2.0, 1.0), ("B", 3.0, 2.0)]
    df = spark.createDataFrame(values, "type string, amount double, oldbalanceDest double")
    df = df.withColumns({c: F.lit(0.0) for c in ("oldbalanceOrg", "newbalanceOrig", "newbalanceDest")})
    filled = ft.apply_null_policy(df, policy)
    assert ft.fit_features(filled, policy).transform(filled).count() == n


def test_null_policy_error(spark, tx):
    df = tx.withColumn("oldbalanceDest", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null"):
        ft.fit_features(df, "error").transform(df).collect()
    with pytest.raises(ValueError, match="null policy"):
        ft.apply_null_policy(df, "ignore")


def test_hash_split_does_not_depend_on_layout(spark):
    df = spark.range(2000).withColumnRenamed("id", "tx_id")
    train, test = ft.hash_split(df)
    moved, _ = ft.hash_split(df.repartition(13))
    assert rows(train) == rows(moved)
    assert train.count() + test.count() == 2000
    assert train.intersect(test).count() == 0
    assert 0.66 < train.count() / 2000 < 0.74


def test_hash_split_without_id_keeps_equal_rows_together(spark, tx):
    train, test = ft.hash_split(tx.union(tx).union(tx))
    assert train.count() + test.count() == 15
    assert train.intersect(test).count() == 0


def test_random_split_is_whole(spark, tx):
    train, test = ft.random_split(tx, 5043)
    assert train.count() + test.count() == 5


def test_third_class_of_the_compatible_label(spark, sample):
    model = models.train(sample, "lr", compat_label=True)
    assert model.stages[-1].numClasses == 3
    assert [s.getOrDefault("outputCol") for s in model.stages[:3]] == ["type_label", "label", "features"]
    scored = models.score(model, sample.drop("isFraud"))
    assert "label" not in scored.columns
    assert len(scored.first().probability) == 3
    labelled = models.score(model, sample)
    assert set(labelled.select("label").distinct().toPandas().label) == {0.0, 1.0}


def test_default_label_has_two_classes(spark, sf_dir):
    assert shared.fitted(spark, sf_dir, "rf").stages[-1].numClasses == 2


def test_forest_parameters(spark, sf_dir):
    forest = shared.fitted(spark, sf_dir, "rf").stages[-1]
    assert forest.getNumTrees == 20
    assert forest.getOrDefault("maxDepth") == 10
    assert forest.getOrDefault("impurity") == "gini"
    assert forest.getOrDefault("seed") == 5043


def test_regression_parameters(spark, sf_dir):
    regression = shared.fitted(spark, sf_dir, "lr").stages[-1]
    values = [regression.getOrDefault(p) for p in ("maxIter", "regParam", "elasticNetParam")]
    assert values == [100, 0.02, 0.8]


@pytest.mark.parametrize("classifier", ["lr", "rf"])
def test_single_class_training_set(spark, sample, classifier):
    one_class = sample.filter("isFraud = 0")
    scored = models.score(models.train(one_class, classifier), one_class)
    assert rows(scored.select("prediction").distinct()) == [(0.0,)]


def test_empty_subset_scores_to_no_rows(spark, sf_dir, sample):
    scored = models.score(shared.fitted(spark, sf_dir, "rf"), sample.filter("amount < 0"))
    assert scored.count() == 0
    assert "prediction" in scored.columns


def test_saved_model_scores_alike(spark, sf_dir, sample):
    model = shared.fitted(spark, sf_dir, "rf")
    path = shared_path(spark, "model")
    models.save(model, path, "skip")
    assert models.load_policy(path) == "skip"
    again = models.score(models.load(path), sample).select("tx_id", "prediction")
    assert rows(again) == rows(models.score(model, sample).select("tx_id", "prediction"))


def test_refit_index_changes_codes_only(spark, sf_dir, sample):
    model = shared.fitted(spark, sf_dir, "rf")
    subset = sample.filter("type in ('TRANSFER', 'CASH_OUT')")
    fitted = models.score(model, subset).select("type", "type_label").distinct()
    refit = models.score(model, subset, refit_index=True).select("type", "type_label").distinct()
    assert {r.type_label for r in refit.collect()} == {0.0, 1.0}
    assert {r.type_label for r in fitted.collect()} == {
        codes(model.stages[0])["TRANSFER"],
        codes(model.stages[0])["CASH_OUT"],
    }


def test_unseen_type_is_scored(spark, sf_dir, sample):
    odd = sample.withColumn("type", F.lit("REFUND"))
    model = shared.fitted(spark, sf_dir, "lr")
    assert models.score(model, odd).count() == sample.count()


def test_weights_reach_the_classifier(spark, sample):
    weighted = sample.withColumn("weight", F.when(F.col("isFraud") == 1, 30.0).otherwise(1.0))
    model = models.train(weighted, "rf", weightCol="weight")
    found = models.score(model, weighted).filter("prediction = 1").count()
    plain = models.score(models.train(sample, "rf"), sample).filter("prediction = 1").count()
    assert found > plain


def test_metrics_equal_mllib(spark):
    pairs = [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 7 + [(1.0, 1.0)] * 5 + [(1.0, 0.0)] * 3 + [(2.0, 0.0)] * 2
    df = spark.createDataFrame(pairs, "label double, prediction double")
    summary = ev.evaluate(df).first()
    evaluator = MulticlassClassificationEvaluator()
    assert evaluator.getMetricName() == "f1"
    assert summary.weighted_f1 == pytest.approx(evaluator.evaluate(df))
    for name, metric in (
        ("accuracy", "accuracy"),
        ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"),
    ):
        assert summary[name] == pytest.approx(evaluator.setMetricName(metric).evaluate(df))
    metrics = {r["class"]: r for r in ev.class_metrics(ev.confusion_matrix(df)).collect()}
    assert metrics[2.0].precision == metrics[2.0].f1 == 0.0
    for label in (0.0, 1.0, 2.0):
        by_label = evaluator.setMetricLabel(label)
        assert metrics[label].recall == pytest.approx(by_label.setMetricName("recallByLabel").evaluate(df))
        assert metrics[label].f1 == pytest.approx(by_label.setMetricName("fMeasureByLabel").evaluate(df))


def test_all_zero_predictor_on_the_published_counts(spark):
    """The published row counts.

    The yardstick for rare fraud: predicting no fraud at all already scores 0.998."""
    confusion = spark.createDataFrame(
        [(0.0, 0.0, 6_362_620 - 8_213), (1.0, 0.0, 8_213)], "label double, prediction double, n long"
    )
    summary = ev.summary_metrics(ev.class_metrics(confusion)).first()
    assert summary.accuracy == pytest.approx(0.998709, abs=1e-6)
    assert summary.weighted_f1 == pytest.approx(0.998064, abs=1e-6)


def test_label_codes_equal_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(v,) for v in (0, 0, 0, 1, 1, 7, 5, None)], "isFraud int")
    built_in = StringIndexer(inputCol="isFraud", outputCol="label", handleInvalid="keep").fit(df)
    ours = ft.label_codes(df)
    assert ours.labels == built_in.labels == ["0", "1", "5", "7"]
    assert rows(ours.transform(df)) == rows(built_in.transform(df))
    assert ours.transform(df).schema["label"].metadata == built_in.transform(df).schema["label"].metadata


def test_a_million_labels_do_not_reach_the_driver(spark):
    df = spark.range(1_000_000).selectExpr("cast(if(id % 4 = 0, id % 3, id) as int) as isFraud")
    model = ft.label_codes(df, top=5)
    assert len(model.labels) == 5 and set(model.labels[:3]) == {"0", "1", "2"}
    last = model.transform(df).groupBy("label").count().orderBy("label").collect()
    assert [r["label"] for r in last] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert sum(r["count"] for r in last) == 1_000_000


def test_no_label_at_all(spark):
    df = spark.createDataFrame([(None,), (None,)], "isFraud int")
    assert rows(ft.label_codes(df).transform(df)) == [(None, 0.0), (None, 0.0)]
