"""Column profiles that are kept up to date file by file.

Count, mean, sum of squared deviations, minimum and maximum of a column are kept for each file and merged when a
profile is read. A file that is added costs its own scan; a file that is gone no longer counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, NumericType, StringType, StructField, StructType

from tillwatch.sources.staging import _located
from tillwatch.sources.versions import VersionedTable

# Exact sums keep this many decimal places, enough for money and whole numbers.
SUM_PLACES = 6

_MOMENTS = (
    "column_name string, n long, exact_sum decimal(38,6), mean double, squares double, "
    "min_number double, max_number double, min_text string, max_text string"
)


def _is_exact(field: StructField) -> bool:
    """Whether sums of the column can be kept without rounding."""
    kind = field.dataType
    return isinstance(kind, IntegralType) or isinstance(kind, DecimalType) and kind.scale <= SUM_PLACES


def _moments(field: StructField) -> Column:
    """One column's moments; deviations are taken about the group's own mean, so large values lose no digits."""
    value, nothing = F.col(f"`{field.name}`"), F.lit(None)
    measured = {"column_name": F.lit(field.name), "n": F.count(value)}
    if isinstance(field.dataType, NumericType):
        if _is_exact(field):
            whole = isinstance(field.dataType, IntegralType)
            measured["exact_sum"] = F.sum(value.cast("decimal(20,0)") if whole else value)
        number = value.cast("double")
        measured |= {
            "mean": F.avg(number),
            "squares": F.var_pop(number) * F.count(value),
            "min_number": F.min(value),
            "max_number": F.max(value),
        }
    elif isinstance(field.dataType, StringType):
        measured |= {"min_text": F.min(value), "max_text": F.max(value)}
    else:
        raise TypeError(f"cannot profile {field.name}: {field.dataType.simpleString()}")
    wanted = (part.strip().rsplit(" ", 1) for part in _MOMENTS.split(", "))
    return F.struct(*[measured.get(name, nothing).cast(kind).alias(name) for name, kind in wanted])


def by_group(df: DataFrame, group: Column, fields: Sequence[StructField]) -> DataFrame:
    """Moments of each column within each group, as rows. Combined in the tasks before the shuffle.

    Texts have an aggregation of their own, so that numbers stay in generated code.
    """
    text = [f for f in fields if isinstance(f.dataType, StringType)]
    numbers = [f for f in fields if f not in text]
    parts = []
    for some in (numbers, text):
        if some:
            one_row = df.groupBy(group.alias("file")).agg(*[_moments(f).alias(f"p{i}") for i, f in enumerate(some)])
            parts.append(one_row.select("file", F.inline(F.array(*[F.col(f"p{i}") for i in range(len(some))]))))
    return reduce(DataFrame.union, parts)


def merged(moments: DataFrame, places: int = 4) -> DataFrame:
    """One row per column from the moments of all groups: the rows of ``profile.profile``.

    With n, m and s of a group, deviations about the mean of all add up as s + n (m - mean)². Means of exact columns
    come from the exact sum.
    """
    total = moments.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.sum("exact_sum").alias("exact_sum"),
        F.sum(F.col("n") * F.col("mean")).alias("weighted"),
        F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"),
        F.min("min_text").alias("min_text"),
        F.max("max_text").alias("max_text"),
    )
    centre = F.try_divide(F.coalesce(F.col("exact_sum").cast("double"), F.col("weighted")), F.col("n"))
    total = total.withColumn("centre", centre)
    apart = F.col("m.squares") + F.col("m.n") * F.pow(F.col("m.mean") - F.col("t.centre"), F.lit(2.0))
    spread = (
        moments.alias("m")
        .join(total.alias("t"), F.expr("m.column_name = t.column_name"))
        .groupBy("t.column_name")
        .agg(F.sum(apart).alias("squares"))
    )
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return total.join(spread, "column_name").select(
        "column_name",
        "n",
        F.round("centre", places).alias("mean"),
        F.round(deviation, places).alias("stddev"),
        "min_number",
        "max_number",
        "min_text",
        "max_text",
    )


def _stamp(spark: SparkSession, file: str) -> str:
    """A file as it is now: a file written again under its name is another one."""
    system, hadoop = _located(spark, file)
    status = system.getFileStatus(hadoop)
    return f"{file}|{status.getLen()}|{status.getModificationTime()}"


def _listed(spark: SparkSession, **columns: Sequence[str]) -> DataFrame:
    """Names that the driver holds, as rows of texts."""
    return spark.createDataFrame(pa.table({name: pa.array(texts, pa.string()) for name, texts in columns.items()}))


def _plain(path: Column) -> Column:
    """A path without the ways of writing its scheme (``file:/`` and ``file:///``)."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def refresh(table: VersionedTable, schema: StructType, files: Sequence[str]) -> list[str]:
    """Measure the parquet files whose moments the table lacks, and return them.

    The same files measured again, by a job that is repeated, are the same commit and count once.
    """
    spark = table.spark
    stamps = {f: _stamp(spark, f) for f in files}
    known = set()
    if table.versions():
        known = {r["file"] for r in table.read().select("file").distinct().collect()}
    new = sorted(f for f, stamp in stamps.items() if stamp not in known)
    if new:
        # Every new file has a row, also one that holds none, or it would be measured each time.
        names = _listed(spark, path=new, file=[stamps[f] for f in new])
        rows = spark.read.schema(schema).parquet(*new)
        found = by_group(rows, _plain(F.col("_metadata.file_path")), schema.fields)
        named = names.withColumn("path", _plain(F.col("path")))
        moments = named.join(found.withColumnRenamed("file", "path"), "path", "left").drop("path")
        commit = hashlib.sha256("\n".join(stamps[f] for f in new).encode()).hexdigest()
        table.append(moments, commit)
    return new


def profile(table: VersionedTable, schema: StructType, files: Sequence[str], places: int = 4) -> DataFrame:
    """The profile of the given files from their kept moments; columns without any row have a count of 0."""
    stamps = _listed(table.spark, file=[_stamp(table.spark, f) for f in files])
    held = table.read().join(stamps, "file", "left_semi").where("column_name IS NOT NULL")
    columns = _listed(table.spark, column_name=schema.names)
    return columns.join(merged(held, places), "column_name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
