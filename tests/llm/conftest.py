from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang) tuples, dealt over partitions."""

    def make(*rows, partitions: int = 3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)

    return make


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
