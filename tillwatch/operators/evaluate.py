"""Quality of predictions, all derived from one aggregation over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction); at most classes² rows leave the shuffle."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class.

    Each cell counts once for its label and once for its prediction, so the matrix is read once.
    A class that is never predicted has precision 0, as in MLlib.
    """
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def side(which: str, actual: Column, predicted: Column, correct: Column) -> Column:
        return F.struct(
            F.col(which).alias("class"),
            actual.alias("actual"),
            predicted.alias("predicted"),
            correct.alias("correct"),
        )

    sides = F.array(side("label", n, none, hit), side("prediction", none, n, none))
    totals = confusion.select(F.inline(sides)).groupBy("class").agg(
        F.sum("actual").alias("n_actual"),
        F.sum("predicted").alias("n_predicted"),
        F.sum("correct").alias("n_correct"),
    )
    zero = F.lit(0.0)
    return totals.withColumns(
        {
            "precision": F.coalesce(F.try_divide("n_correct", "n_predicted"), zero),
            "recall": F.coalesce(F.try_divide("n_correct", "n_actual"), zero),
            "f1": F.coalesce(
                F.try_divide(F.col("n_correct") * 2, F.col("n_actual") + F.col("n_predicted")), zero
            ),
        }
    )


def summary_metrics(metrics: DataFrame) -> DataFrame:
    """Rows, accuracy, and F1, precision and recall weighted by the classes' row counts.

    The weighted F1 is the figure that MLlib's evaluator gives unless told otherwise.
    """
    weight = F.col("n_actual")
    total = F.sum(weight)
    return metrics.agg(
        total.alias("n_rows"),
        (F.sum("n_correct") / total).alias("accuracy"),
        (F.sum(weight * F.col("f1")) / total).alias("weighted_f1"),
        (F.sum(weight * F.col("precision")) / total).alias("weighted_precision"),
        (F.sum(weight * F.col("recall")) / total).alias("weighted_recall"),
    )


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return summary_metrics(class_metrics(confusion_matrix(df, label, prediction)))
