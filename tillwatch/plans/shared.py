"""Work that several queries of one session share: staged rows, the CSV copy, fitted models.

Each is made once per session and table folder, and anew when a table it is made from has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tillwatch.operators import model_table
from tillwatch.operators.features import parts, with_part
from tillwatch.operators.models import score, train
from tillwatch.session import shared_path
from tillwatch.sources.staging import stage, version
from tillwatch.sources.tables import raw_transactions, read_events, transactions, write_dirty_csv
from tillwatch.streaming import replay

_made: dict[tuple, tuple] = {}


SOURCES = ("orders", "customer", "events")


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    now = tuple(version(spark, f"{sf_dir}/{table}.parquet") for table in SOURCES)
    if key not in _made or _made[key][0] != now:
        _made[key] = (now, make())
    return _made[key][1]


def _marked_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions and their part, written once: training scans a table, not a join or a hash."""

    def make() -> DataFrame:
        return stage(with_part(transactions(spark, sf_dir)), "transactions")

    return _once(spark, sf_dir, "transactions", make)


def staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked_transactions(spark, sf_dir).drop("part")


def staged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with money as it comes, written once."""
    return _once(
        spark, sf_dir, "raw", lambda: stage(raw_transactions(spark, sf_dir), "raw-transactions")
    )


def ordered_events(spark: SparkSession, sf_dir: str, repeated: bool = False) -> str:
    """Folder of the events in files that a stream reads in the order of time, and a row that closes the last window.

    With ``repeated``, every 10th event comes twice.
    """

    def write() -> str:
        events = read_events(spark, sf_dir)
        if repeated:
            events = events.unionAll(events.filter("event_id % 10 = 0"))
        return replay.in_time_order(events, "ts", "event_id", close_after="4 HOURS")

    return _once(spark, sf_dir, f"ordered events {repeated}", write)


def dealt_events(spark: SparkSession, sf_dir: str, repeated: bool = False) -> str:
    """Folder of the events in several files, in no order of time, so that a stream has several batches.

    With ``repeated``, every 10th event comes again in a later file.
    """

    def write() -> str:
        path = shared_path(spark, "events")
        events = read_events(spark, sf_dir)
        events.repartition(replay.file_number(events.count()), "event_id").write.parquet(path)
        if repeated:
            again = events.filter("event_id % 10 = 0").repartition(2, "event_id")
            again.write.mode("append").parquet(path)
        return path

    return _once(spark, sf_dir, f"events {repeated}", write)


def dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the transactions as CSV files with bad rows among them."""

    def write() -> str:
        path = shared_path(spark, "transactions-csv")
        write_dirty_csv(raw_transactions(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "csv", write)


def holdout(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return parts(_marked_transactions(spark, sf_dir))


def scored_holdout(spark: SparkSession, sf_dir: str, classifier: str) -> DataFrame:
    """Scored test rows, written once: an evaluation reads them several times."""

    def make() -> DataFrame:
        _, test = holdout(spark, sf_dir)
        scored = score(fitted(spark, sf_dir, classifier), test)
        return stage(scored.select("tx_id", "label", "features", "probability", "prediction"), "holdout")

    return _once(spark, sf_dir, f"holdout {classifier}", make)


def fitted(
    spark: SparkSession, sf_dir: str, classifier: str, compat_label: bool = False
) -> PipelineModel:
    """A classifier trained on the training part, with type codes from all rows."""

    def fit() -> PipelineModel:
        rows, _ = holdout(spark, sf_dir)
        every_row = staged_transactions(spark, sf_dir)
        return train(rows, classifier, compat_label=compat_label, codes_from=every_row)

    return _once(spark, sf_dir, f"model {classifier} {compat_label}", fit)


def forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the fitted forest."""

    def make() -> DataFrame:
        return model_table.forest_nodes(spark, fitted(spark, sf_dir, "rf").stages[-1])

    return _once(spark, sf_dir, "forest table", make)


def certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The certificate of the fitted regression over its training rows."""

    def make() -> DataFrame:
        model = fitted(spark, sf_dir, "lr")
        rows, _ = holdout(spark, sf_dir)
        return stage(model_table.certificate(model.stages[-1], score(model, rows)), "certificate")

    return _once(spark, sf_dir, "certificate", make)
