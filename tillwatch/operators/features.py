"""Category codes, feature vectors, labels and the train/test split."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.hashing import hash_percent
from tillwatch.operators.quality import fill_balances
from tillwatch.schema import FEATURE_COLUMNS, TRAIN_PERCENT, TX_TYPES

NULL_POLICIES = ("fill", "skip", "error")

# Classes of the compatible label, far above the two of the source.
MAX_LABELS = 100

# Tells a tree classifier that there are two classes, which saves a job over the training rows and
# keeps a training set with one class valid.
BINARY_LABEL = {"ml_attr": {"name": "label", "type": "nominal", "vals": ["0", "1"]}}


def type_indexer() -> StringIndexer:
    """Codes by descending frequency, ties by name; NULL and unseen types get the next code."""
    return StringIndexer(inputCol="type", outputCol="type_label", handleInvalid="keep")


def known_types(df: DataFrame) -> DataFrame:
    """Rows whose type is one of the domain.

    An indexer takes every distinct type it is fit on to the driver, so dirty text must not reach it;
    a type outside the domain is scored like one never seen.
    """
    return df.filter(F.col("type").isin(*TX_TYPES))


def unknown_types(df: DataFrame) -> DataFrame:
    """Number of rows whose type is missing or outside the domain."""
    return df.agg(F.count_if(F.coalesce(~F.col("type").isin(*TX_TYPES), F.lit(True))).alias("n_rows"))


def label_codes(df: DataFrame, top: int = MAX_LABELS) -> StringIndexerModel:
    """Compatible label: codes by descending frequency, ties by name, and one class more for all others.

    Labels are counted in the tasks and across them, and only the ``top`` most frequent reach the driver, however
    many a dirty column holds. Rarer labels, NULL and labels never seen share the last class.
    """
    label = F.col("isFraud").cast("string")
    counted = df.select(label.alias("value")).where("value IS NOT NULL").groupBy("value").count()
    first = counted.orderBy(F.desc("count"), F.asc("value")).limit(top).collect()
    return StringIndexerModel.from_labels(
        [r["value"] for r in first], inputCol="isFraud", outputCol="label", handleInvalid="keep"
    )


def with_label(df: DataFrame, declare_classes: bool = True) -> DataFrame:
    """Default label: ``isFraud`` as a double, by default of two known classes.

    The regression counts its classes itself. It must not be told: with two declared classes and
    only non-fraud rows, its infinite intercept would point to fraud.
    """
    label = F.col("isFraud").cast("double")
    if declare_classes:
        label = label.alias("label", metadata=BINARY_LABEL)
    return df.withColumn("label", label)


def assembler(null_policy: str = "error") -> VectorAssembler:
    invalid = "skip" if null_policy == "skip" else "error"
    return VectorAssembler(
        inputCols=list(FEATURE_COLUMNS), outputCol="features", handleInvalid=invalid
    )


def apply_null_policy(df: DataFrame, policy: str) -> DataFrame:
    """``fill`` puts 0 into missing balances; ``skip`` and ``error`` are left to the assembler."""
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy must be one of {NULL_POLICIES}, not {policy!r}")
    return fill_balances(df) if policy == "fill" else df


def fit_features(df: DataFrame, null_policy: str = "fill") -> PipelineModel:
    """Fit the type codes once; the result serves training and scoring alike."""
    return Pipeline(stages=[type_indexer().fit(known_types(df)), assembler(null_policy)]).fit(df)


def feature_columns(featured: DataFrame, *keep: str) -> DataFrame:
    """The feature vector as doubles ``f0`` … ``f5`` that SQL can read."""
    values = vector_to_array(F.col("features"))
    return featured.select(*keep, values.alias("v")).select(
        *keep, *[F.col("v")[i].alias(f"f{i}") for i in range(len(FEATURE_COLUMNS))]
    )


def index_skew(train: DataFrame, scoring: DataFrame) -> DataFrame:
    """Rows per type with the code from training and the code of an indexer refit on scoring rows.

    Where the two differ, a model scores the rows under another type's code. Rows are counted
    before the codes are looked up, so only one row per type is coded.
    """
    fitted = type_indexer().fit(known_types(train))
    refit = type_indexer().setOutputCol("refit_code").fit(known_types(scoring))
    types = scoring.groupBy("type").agg(F.count("*").alias("n_rows"))
    coded = refit.transform(fitted.setOutputCol("train_code").transform(types))
    return coded.select("type", "train_code", "refit_code", "n_rows")


def with_part(df: DataFrame, *keys: str, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of the id: the same under any partitioning.

    Rows without an id are marked by all their columns, so equal rows land in the same part.
    """
    if not keys:
        keys = ("tx_id",) if "tx_id" in df.columns else tuple(df.columns)
    in_train = hash_percent(*[F.col(k) for k in keys]) < train_percent
    return df.withColumn("part", F.when(in_train, F.lit("train")).otherwise(F.lit("test")))


def parts(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test of marked rows."""
    train, test = (marked.filter(F.col("part") == part).drop("part") for part in ("train", "test"))
    return train, test


def hash_split(
    df: DataFrame, *keys: str, train_percent: int = TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    return parts(with_part(df, *keys, train_percent=train_percent))


def random_split(
    df: DataFrame, seed: int, train_share: float = TRAIN_PERCENT / 100
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; sorts each partition, and the rows depend on the file layout."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed)
    return train, test
