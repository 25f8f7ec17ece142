"""Fitted models as rows: a forest as nodes and leaves, a regression as coefficients with their certificate."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.schema import FEATURE_COLUMNS
from tillwatch.session import shared_path
from tillwatch.sources import staging

def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel) -> DataFrame:
    """The nodes of a forest, read from the table that MLlib saves a model as.

    A node sends a row left if its feature is at most the threshold, or one of the codes; leaves have
    feature, left and right -1. At most ``numTrees * 2 ** (maxDepth + 1)`` rows.
    """
    path = shared_path(spark, "forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    by_code = F.col("split.numCategories") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    nodes = saved.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.when(~by_code, F.get(values, F.lit(0))).alias("threshold"),
        F.when(by_code, values).alias("left_codes"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("rawCount").alias("n_rows"),
        F.col("impurityStats").alias("counts"),
    )
    staged = staging.stage(nodes, "forest-nodes")
    staging.remove(spark, path)
    return staged


def forest_leaves(nodes: DataFrame, depth: int, names: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Each leaf with the condition of its path as SQL text, its depth, training rows and class counts.

    The leaves of a tree are disjoint and cover every row, so a filter by the text gives the leaf's rows.
    The path grows by one join with the small table of nodes a level.
    """
    name = F.get(F.array(*map(F.lit, names)), F.col("feature"))
    bound = F.col("threshold").cast("string")
    codes = F.array_join(F.col("left_codes").cast("array<string>"), ", ")
    goes_left = F.coalesce(F.concat(name, F.lit(" <= "), bound), F.concat(name, F.lit(" IN ("), codes, F.lit(")")))
    goes_right = F.coalesce(
        F.concat(name, F.lit(" > "), bound), F.concat(name, F.lit(" NOT IN ("), codes, F.lit(")"))
    )
    edges = nodes.where("feature >= 0").select(
        "tree",
        F.inline(
            F.array(
                F.struct(F.col("left").alias("node"), F.col("node").alias("parent"), goes_left.alias("step")),
                F.struct(F.col("right").alias("node"), F.col("node").alias("parent"), goes_right.alias("step")),
            )
        ),
    )
    ends = nodes.where("feature < 0").select("tree", "node", "n_rows", "counts")
    at = ends.select("*", F.col("node").alias("_at"), F.array().cast("array<string>").alias("_steps"))
    for _ in range(depth):
        up = edges.select("tree", F.col("node").alias("_at"), "parent", "step")
        at = at.join(up, ["tree", "_at"], "left").select(
            "tree",
            "node",
            "n_rows",
            "counts",
            F.coalesce("parent", "_at").alias("_at"),
            F.when(F.col("step").isNull(), F.col("_steps"))
            .otherwise(F.concat(F.array("step"), F.col("_steps")))
            .alias("_steps"),
        )
    path = F.when(F.size("_steps") == 0, F.lit("true")).otherwise(F.array_join("_steps", " AND "))
    return at.select(
        "tree", F.col("node").alias("leaf"), F.size("_steps").alias("depth"), path.alias("path"), "n_rows", "counts"
    )


TREES = """array<struct<feature:array<int>,threshold:array<double>,codes:array<array<double>>,
           left:array<int>,right:array<int>,share:array<array<double>>>>"""


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _trees(nodes: DataFrame) -> Column:
    """The nodes as a constant: an array of trees, whose arrays have a place for each node."""
    trees: dict[int, list] = {}
    for row in nodes.orderBy("tree", "node").collect():
        trees.setdefault(row.tree, []).append(row)
    packed = []
    for rows in trees.values():
        if [r.node for r in rows] != list(range(len(rows))):
            raise ValueError("the nodes of a tree must be numbered from 0 without a gap")
        total = [sum(r.counts) for r in rows]
        packed.append(
            {
                "feature": [r.feature for r in rows],
                "threshold": [r.threshold for r in rows],
                "codes": [r.left_codes for r in rows],
                "left": [r.left for r in rows],
                "right": [r.right for r in rows],
                "share": [[c / n if n else 0.0 for c in r.counts] for r, n in zip(rows, total)],
            }
        )
    return F.from_json(F.lit(json.dumps(packed)), TREES)


def forest_probability(nodes: DataFrame, values: Column, depth: int) -> Column:
    """Class probabilities of a forest from its table of nodes, over an array of feature values.

    Each tree is walked ``depth`` steps from its root, a leaf staying where it is; the trees' class shares
    are averaged. Built-in functions only: no join, no Python, and the same on a stream. The nodes
    reach the driver, where the fitted model is as well.
    """

    def leaf(tree: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            feature, codes = F.get(tree["feature"], node), F.get(tree["codes"], node)
            value = F.get(values, feature)
            left = F.when(codes.isNull(), value <= F.get(tree["threshold"], node)).otherwise(
                F.array_contains(codes, value)
            )
            return (
                F.when(feature < 0, node)
                .when(left, F.get(tree["left"], node))
                .otherwise(F.get(tree["right"], node))
            )

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)

    def shares(trees: Column) -> Column:
        return F.transform(trees, lambda tree: F.get(tree["share"], leaf(tree)))

    def average(each: Column) -> Column:
        first = F.get(each, F.lit(0))
        votes = F.transform(first, lambda _, c: F.aggregate(each, F.lit(0.0), lambda s, x: s + F.get(x, c)))
        total = F.aggregate(votes, F.lit(0.0), lambda s, x: s + x)
        return F.transform(votes, lambda v: v / total)

    return _let(_let(_trees(nodes), shares), average)


def forest_prediction(probability: Column) -> Column:
    """The first class of highest probability."""
    return (F.array_position(probability, F.array_max(probability)) - 1).cast("double")


def rescored(scored: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """Scored rows with ``table_probability`` (of class 1) and ``table_prediction``, from the table of nodes."""
    values = vector_to_array(F.col("features"))
    with_shares = scored.withColumn("_share", forest_probability(nodes, values, depth))
    return with_shares.withColumns(
        {"table_probability": F.get("_share", F.lit(1)), "table_prediction": forest_prediction(F.col("_share"))}
    ).drop("_share")


def margin(model: LogisticRegressionModel, values: Column) -> Column:
    """Intercept and weighted features of a regression of two classes."""
    total = F.lit(float(model.intercept))
    for i, weight in enumerate(model.coefficients.toArray().tolist()):
        total = total + F.get(values, F.lit(i)) * F.lit(weight)
    return total


def certificate(
    model: LogisticRegressionModel, training: DataFrame, names: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """Whether a regression's coefficients are the optimum of its loss: one row per coefficient, intercept first.

    Over the training rows (``features``, ``label``), one aggregation gives the mean log loss, its gradient
    by each scaled coefficient, and the features' deviations, by which MLlib scales the penalty. With an
    elastic net, ``slack`` is 0 at the optimum: for a coefficient other than 0, what the gradient and the
    penalty's slope leave over; for one of 0, how far the gradient exceeds the L1 strength, 0 if it does
    not. ``margin`` is the L1 strength less the gradient's size. A constant feature has gradient 0.
    """
    strength, l1 = model.getRegParam(), model.getElasticNetParam()
    values = F.col("_v")
    p = 1 / (1 + F.exp(-F.col("_margin")))
    rows = (
        training.select(F.col("label").cast("double").alias("_y"), vector_to_array(F.col("features")).alias("_v"))
        .select("_y", "_v", margin(model, values).alias("_margin"))
        .select("_y", "_v", "_margin", (p - F.col("_y")).alias("_off"))
    )
    size = F.abs(F.col("_margin"))
    loss = F.greatest(F.col("_margin"), F.lit(0.0)) - F.col("_y") * F.col("_margin") + F.log1p(F.exp(-size))
    sums = rows.agg(
        F.count("*").alias("n"),
        F.avg(loss).alias("loss"),
        F.avg("_off").alias("off"),
        *[F.covar_pop("_off", F.get(values, F.lit(i))).alias(f"g{i}") for i in range(len(names))],
        *[F.stddev_samp(F.get(values, F.lit(i))).alias(f"s{i}") for i in range(len(names))],
    )
    weights = model.coefficients.toArray().tolist()
    none = F.lit(None).cast("double")
    each = [
        F.struct(
            F.lit("(intercept)").alias("feature"),
            F.lit(float(model.intercept)).alias("coefficient"),
            F.col("off").alias("gradient"),
            none.alias("margin"),
            F.abs("off").alias("slack"),
        )
    ]
    for i, (name, weight) in enumerate(zip(names, weights)):
        gradient = F.coalesce(F.try_divide(F.col(f"g{i}"), F.col(f"s{i}")), F.lit(0.0))
        if weight:
            sign = 1.0 if weight > 0 else -1.0
            slack = F.abs(gradient + strength * (1 - l1) * weight * F.col(f"s{i}") + strength * l1 * sign)
        else:
            slack = F.greatest(F.abs(gradient) - strength * l1, F.lit(0.0))
        each.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.lit(weight).alias("coefficient"),
                gradient.alias("gradient"),
                (strength * l1 - F.abs(gradient)).alias("margin"),
                slack.alias("slack"),
            )
        )
    return sums.select("n", "loss", F.inline(F.array(*each))).select(
        "feature", "coefficient", "gradient", "margin", "slack", "loss", F.col("n").alias("n_rows")
    )


SLACK = 1e-4
"""Largest slack of a certificate that counts as the optimum; MLlib stops at a relative change of 1e-6."""


def is_optimal(certified: DataFrame) -> DataFrame:
    """One row: whether every coefficient's slack is small, and the largest slack."""
    return certified.agg((F.max("slack") < SLACK).cast("int").alias("optimal"), F.max("slack").alias("slack"))
