"""Fraud classifiers as MLlib pipelines that carry their own type codes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.operators.features import (
    apply_null_policy,
    assembler,
    known_types,
    label_codes,
    type_indexer,
    with_label,
)
from tillwatch.schema import SEED


def logistic_regression(**params) -> LogisticRegression:
    """100 iterations, elastic net of strength 0.02 with an L1 share of 0.8."""
    return LogisticRegression(maxIter=100, regParam=0.02, elasticNetParam=0.8, **params)


def random_forest(**params) -> RandomForestClassifier:
    """20 gini trees of depth 10, automatic feature subsets."""
    return RandomForestClassifier(
        impurity="gini", maxDepth=10, numTrees=20, featureSubsetStrategy="auto", seed=SEED, **params
    )


FOREST_PARTITIONS = 32
FOREST_ROWS = 1_000_000
"""Training rows of a forest are dealt over so many partitions, or one for so many rows if that is more."""

CLASSIFIERS = {"lr": logistic_regression, "rf": random_forest}


def train(
    df: DataFrame,
    classifier: str = "rf",
    null_policy: str = "fill",
    compat_label: bool = False,
    codes_from: DataFrame | None = None,
    partitions: int | None = None,
    **params,
) -> PipelineModel:
    """Fit type codes and a classifier on labelled rows.

    ``df`` is scanned several times, so hand over a staged table; Spark keeps its own encoded
    copy for the iterations. ``codes_from`` takes the type codes from a larger frame than the
    training rows. Rows without a label stop the training unless the policy is ``skip``, which leaves
    them out. With ``compat_label`` the label indexer adds its third class, and rows without a label
    belong to it. For a forest the rows are dealt over ``partitions`` (by default a number that only
    the row count sets) by their id and ordered there, since its samples depend on both: the same rows give the same forest on any cluster and from any
    files. ``params`` go to the classifier, ``weightCol`` for rare fraud among them.
    """
    rows = apply_null_policy(_dealt(df, partitions) if classifier == "rf" else df, null_policy)
    if null_policy == "skip" and not compat_label:
        rows = rows.filter("isFraud IS NOT NULL")
    coder = type_indexer().fit(known_types(df if codes_from is None else codes_from))
    stages = [coder, assembler(null_policy), CLASSIFIERS[classifier](**params)]
    if compat_label:
        stages.insert(1, label_codes(rows))
    else:
        rows = with_label(rows, declare_classes=classifier == "rf")
    return Pipeline(stages=stages).fit(rows)


def _dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows by the hash of their id, or of all columns where they have none, in a fixed order."""
    if partitions is None:
        partitions = max(FOREST_PARTITIONS, -(-df.count() // FOREST_ROWS))
    keys = ["tx_id"] if "tx_id" in df.columns else df.columns
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def score(
    model: PipelineModel, df: DataFrame, null_policy: str = "fill", refit_index: bool = False
) -> DataFrame:
    """Add features, probabilities and prediction to rows, labelled or not, batch or stream.

    ``refit_index`` fits the type codes anew on the rows to be scored instead of reusing the
    training codes. That repeats a known skew between training and scoring; batch only.
    """
    rows = apply_null_policy(df, null_policy)
    if refit_index:
        model = PipelineModel([type_indexer().fit(known_types(rows)), *model.stages[1:]])
    if "isFraud" in rows.columns and "label" not in rows.columns and not _indexes_label(model):
        rows = with_label(rows)
    return model.transform(rows)


def _indexes_label(model: PipelineModel) -> bool:
    return any(
        stage.hasParam("outputCol") and stage.getOrDefault("outputCol") == "label"
        for stage in model.stages
    )


POLICY_FOLDER = "null_policy"


def save(model: PipelineModel, path: str, null_policy: str = "fill") -> None:
    """Write the model, and beside its stages the policy for NULLs that it was trained under."""
    model.write().save(path)
    spark = SparkSession.active()
    policy = spark.createDataFrame([(null_policy,)], "value string")
    policy.coalesce(1).write.text(f"{path}/{POLICY_FOLDER}")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_policy(path: str) -> str:
    """The null policy of a saved model."""
    return SparkSession.active().read.text(f"{path}/{POLICY_FOLDER}").first().value


def _class_probabilities() -> Column:
    return vector_to_array(F.col("probability"))


def probability_ok() -> Column:
    """1 where the class probabilities add up to one."""
    total = F.aggregate(_class_probabilities(), F.lit(0.0), lambda a, p: a + p)
    return (F.abs(total - 1) < 1e-9).cast("int")


def prediction_ok() -> Column:
    """1 where the prediction is the first class of highest probability."""
    values = _class_probabilities()
    best = F.array_position(values, F.array_max(values)) - 1
    return (F.col("prediction") == best).cast("int")
