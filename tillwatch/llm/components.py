"""Connected components of a graph of any size, by alternating stars.

A large star ties every larger neighbour of a node to the least node around it, a small star every smaller
one. Edges stay at most as many as at the start, no neighbourhood is ever gathered in one place, and a
graph needs a number of rounds that grows with the logarithm of its size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import staged

MAX_ROUNDS = 60
"""Far beyond what any graph needs; reaching it fails the job."""


def least_in_group(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row number that links lead to, for each of ``count`` rows."""
    least = np.arange(count)
    while len(left):
        low = np.minimum(least[left], least[right])
        before = least.copy()
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        least = least[least]
        if (least == before).all():
            break
    return least


def _least_beside(edges: DataFrame, key: str, other: str) -> DataFrame:
    """Written, so that the join with it shuffles both sides and a hot node can be split."""
    return staged(edges.groupBy(key).agg(F.min(other).alias("least")), "component-least")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = _least_beside(both, "u", "v")
    large = (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.least("least", "u").alias("lo"))
        .distinct()
    )
    large = staged(large, "component-large")
    least = _least_beside(large, "hi", "lo")
    small = (
        large.join(least, "hi")
        .where("lo <> least")
        .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        .unionAll(least.select("hi", F.col("least").alias("lo")))
        .distinct()
    )
    return staged(small, "component-edges")


def _is_star_forest(edges: DataFrame) -> bool:
    total, nodes = edges.agg(F.count(F.lit(1)), F.count_distinct("hi")).first()
    if total != nodes:
        return False
    inner = edges.select(F.col("hi").alias("lo"))
    return edges.join(inner, "lo", "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has an edge.

    Self-loops and nulls are no edges; repeated edges count once.
    """
    found = staged(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), F.col(a).alias("_a"), F.col(b).alias("_b"))
        .where("_a <> _b")
        .select("hi", "lo")
        .distinct(),
        "component-edges",
    )
    for _ in range(MAX_ROUNDS):
        if _is_star_forest(found):
            return found.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
                found.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        found = _round(found)
    raise RuntimeError("components did not settle")
