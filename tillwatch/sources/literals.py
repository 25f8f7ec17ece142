"""Hand-written transactions that the programs score at the end."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwatch.schema import BALANCE_COLUMNS

MANUAL_SCHEMA = T.StructType(
    [
        T.StructField("amount", T.IntegerType(), False),
        T.StructField("type", T.StringType(), True),
        *[T.StructField(c, T.IntegerType(), False) for c in BALANCE_COLUMNS],
    ]
)

# Amount, type, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest.
MANUAL_ROWS = (
    (205000, "TRANSFER", 0, 205000, 205000, 0),
    (1, "CASH_OUT", 0, 300000, 600000, 300000),
    (800000, "TRANSFER", 500000, 0, 0, 800000),
    (5000, "TRANSFER", 5000, 0, 5000, 5000),
    (600000, "CASH_OUT", 1000000, 400000, 1, 1),
    (10, "CASH_OUT", 300000, 299999, 0, 300000),
    (450000, "TRANSFER", 1000000, 650000, 5000, 500000),
)


def manual_rows(spark: SparkSession, rows: Iterable[tuple] = MANUAL_ROWS) -> DataFrame:
    """Literal rows as a local relation, whose size Spark knows when it plans a join."""
    columns = dict(zip(MANUAL_SCHEMA.names, map(list, zip(*rows))))
    return spark.createDataFrame(pa.table(columns), MANUAL_SCHEMA)
