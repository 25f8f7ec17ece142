from __future__ import annotations

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.operators import moments
from tillwatch.operators.profile import profile
from tillwatch.session import shared_path
from tillwatch.sources.versions import VersionedTable

SCHEMA = "a double, money decimal(12,2), n int, kind string, nothing int"


def values(count, seed, shift=0.0):
    chance = random.Random(seed)
    return [
        (
            shift + chance.gauss(0, 3),
            None if chance.random() < 0.2 else round(chance.uniform(-1e6, 1e6), 2),
            chance.randrange(100),
            chance.choice(["x", "yy", None]),
            None,
        )
        for _ in range(count)
    ]


def write(spark, folder, count, seed, shift=0.0):
    data = [(a, m, n, k, z) for a, m, n, k, z in values(count, seed, shift)]
    df = spark.createDataFrame(data, "a double, money double, n int, kind string, nothing int")
    df = df.withColumn("money", F.col("money").cast("decimal(12,2)"))
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "data")


def parquet(folder):
    return sorted(f"file://{f}" for f in glob.glob(os.path.join(folder, "*.parquet")))


def test_a_new_file_does_not_scan_the_old(spark, folder):
    schema = write(spark, folder, 200, 1)
    write(spark, folder, 50, 2)
    table = VersionedTable(spark, shared_path(spark, "moments"))
    first = parquet(folder)
    assert moments.refresh(table, schema, first) == first
    assert moments.refresh(table, schema, first) == []
    assert table.versions() == [1]
    # From here on the old files cannot be read at all.
    hidden = {f.removeprefix("file://"): open(f.removeprefix("file://"), "rb").read() for f in first}
    expected_rows = rows(spark.read.schema(schema).parquet(folder))
    write(spark, folder, 70, 3)
    for path, content in hidden.items():
        stat = os.stat(path)
        os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
        with open(path, "wb") as file:
            file.write(b"x" * len(content))
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    files = parquet(folder)
    assert moments.refresh(table, schema, files) == sorted(set(files) - set(first))
    result = rows(moments.profile(table, schema, files))
    for path, content in hidden.items():
        with open(path, "wb") as file:
            file.write(content)
    whole = spark.read.schema(schema).parquet(folder)
    assert len(expected_rows) == 250 and whole.count() == 320
    assert result == rows(profile(whole))


def test_removed_and_rewritten_files_count_as_they_are(spark, folder):
    schema = write(spark, folder, 30, 4)
    write(spark, folder, 40, 5)
    table = VersionedTable(spark, shared_path(spark, "moments"))
    files = parquet(folder)
    moments.refresh(table, schema, files)
    assert rows(moments.profile(table, schema, files[:1])) == rows(profile(spark.read.schema(schema).parquet(files[0])))


def test_far_from_zero_no_digits_are_lost(spark, folder):
    """Sums of squares would lose all digits of a deviation of 3 about 1e9."""
    schema = write(spark, folder, 300, 6, shift=1e9)
    write(spark, folder, 300, 7, shift=1e9 + 5)
    table = VersionedTable(spark, shared_path(spark, "moments"))
    files = parquet(folder)
    moments.refresh(table, schema, files)
    got = {r["column_name"]: r for r in moments.profile(table, schema, files).collect()}
    wanted = {r["column_name"]: r for r in profile(spark.read.schema(schema).parquet(folder)).collect()}
    assert got["a"]["stddev"] == pytest.approx(wanted["a"]["stddev"], abs=1e-3)
    assert got["money"] == wanted["money"]


def test_empty_files_and_no_rows(spark, folder):
    schema = write(spark, folder, 0, 8)
    table = VersionedTable(spark, shared_path(spark, "moments"))
    files = parquet(folder)
    moments.refresh(table, schema, files)
    assert moments.refresh(table, schema, files) == []
    result = moments.profile(table, schema, files)
    assert [r["n"] for r in result.collect()] == [0] * 5
    assert rows(result.select("column_name", "mean", "min_text")) == sorted(
        ((c, None, None) for c in schema.names), key=repr
    )


def test_other_types_fail(spark):
    with pytest.raises(TypeError, match="cannot profile"):
        moments.by_group(spark.range(1).selectExpr("array(1) as a"), F.lit("x"), spark.range(1).selectExpr("array(1) as a").schema.fields)
