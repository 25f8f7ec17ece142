"""Written tables that cut lineage and survive the loss of any executor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillwatch.session import shared_path


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = False
) -> None:
    """Write parquet, optionally partitioned.

    ``rebalance`` shuffles once so that each partition value gets few, evenly sized files: AQE
    splits a hot value over many tasks and merges the small ones. Without it, no shuffle, and each
    task writes one file per value it holds.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(like: DataFrame, path: str) -> DataFrame:
    """Read back with the schema (column metadata included) that was written."""
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(context._jsc.hadoopConfiguration()), hadoop


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder; a path that does not exist fails."""
    system, hadoop = _located(spark, path)
    return system.getFileStatus(hadoop).isDirectory()


def version(spark: SparkSession, path: str) -> tuple:
    """Changes whenever a file at or directly below the path does."""
    system, hadoop = _located(spark, path)
    files = system.listStatus(hadoop)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, which need not exist."""
    system, hadoop = _located(spark, path)
    if not system.exists(hadoop):
        return []
    return [f.getPath().getName() for f in system.listStatus(hadoop) if f.isDirectory()]


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file, whose presence says that something is complete."""
    system, hadoop = _located(spark, path)
    system.create(hadoop, True).close()


def marks(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the files named ``prefix`` and a number in a folder, which need not exist."""
    system, hadoop = _located(spark, path)
    if not system.exists(hadoop):
        return []
    names = [f.getPath().getName() for f in system.listStatus(hadoop) if f.isFile()]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))


def date_in_order(spark: SparkSession, path: str, first_ms: int = 0, step_ms: int = 10) -> int:
    """Date a folder's part files in the order of their names, and return the date after the last one.

    A file stream takes files in the order of their dates.
    """
    system, hadoop = _located(spark, path)
    files = [f.getPath() for f in system.listStatus(hadoop) if f.getPath().getName().startswith("part-")]
    for number, file in enumerate(sorted(files, key=lambda f: f.getName())):
        system.setTimes(file, first_ms + number * step_ms, -1)
    return first_ms + len(files) * step_ms


def move_parts(spark: SparkSession, source: str, target: str) -> None:
    """Move part files into another folder; their dates stay."""
    system, hadoop = _located(spark, source)
    _, into = _located(spark, target)
    for file in system.listStatus(hadoop):
        if file.getPath().getName().startswith("part-"):
            system.rename(file.getPath(), into)
    remove(spark, source)


def remove(spark: SparkSession, path: str) -> None:
    """Remove what was staged at a path; what is not there needs no removal."""
    system, hadoop = _located(spark, path)
    system.delete(hadoop, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` once below the shared folder and return the written table."""
    path = shared_path(df.sparkSession, name)
    write_table(df, path, partition_by)
    return read_table(df, path)
