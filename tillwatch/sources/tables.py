"""Transactions derived from the order, customer and event tables.

Rules: one transaction per order, its id the order key; the sender's balance comes from the
customer. The join is left to Spark, which broadcasts the customers only below its size threshold
and otherwise shuffles both sides, splitting a hot customer with AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.functions.money import to_money
from tillwatch.operators.standardise import standardise
from tillwatch.schema import LARGE_TRANSFER, TX_COLUMNS
from tillwatch.sources.csv import write_lines
from tillwatch.sources.staging import is_folder

# Order priority and event type to transaction type.
PRIORITY_TYPES = {
    "1-URGENT": "TRANSFER",
    "2-HIGH": "CASH_OUT",
    "3-MEDIUM": "PAYMENT",
    "4-NOT SPECIFIED": "CASH_IN",
    "5-LOW": "DEBIT",
}
EVENT_TYPES = {
    "click": "TRANSFER",
    "view": "CASH_OUT",
    "purchase": "PAYMENT",
    "signup": "CASH_IN",
    "error": "DEBIT",
}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _choose(key: Column, mapping: dict[str, str]) -> Column:
    pairs = [(key == source, F.lit(target)) for source, target in mapping.items()]
    return reduce(lambda chain, pair: chain.when(*pair), pairs[1:], F.when(*pairs[0]))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_id`` and the source columns, money as double."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    key = F.col("o_orderkey")
    drained = key % 4 == 0
    kind = _choose(F.col("o_orderpriority"), PRIORITY_TYPES)
    fraud = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (key % 12 == 0)
    flagged = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > LARGE_TRANSFER)
    dest_prefix = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("M")).otherwise(F.lit("C"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("tx_id"),
        (key % 743 + 1).cast("int").alias("step"),
        kind.alias("type"),
        F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        F.when(drained, F.col("o_totalprice")).otherwise(F.col("c_acctbal")).alias("oldbalanceOrg"),
        F.when(drained, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("newbalanceOrig"),
        F.concat(dest_prefix, (key * 7919 % 1000).cast("string")).alias("nameDest"),
        F.when(key % 50 != 7, (key % 1000).cast("double")).alias("oldbalanceDest"),
        F.when(key % 50 != 9, (key % 977).cast("double")).alias("newbalanceDest"),
        fraud.cast("int").alias("isFraud"),
        flagged.cast("int").alias("isFlaggedFraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with money as decimal(12,2)."""
    return standardise(raw_transactions(spark, sf_dir))


def with_copies(tx: DataFrame) -> DataFrame:
    """Transactions plus copies: every 10th id again with the label flipped, every 20th unchanged.

    One scan: each row is expanded in place instead of joining three filtered scans by union.
    """
    copy = F.explode(
        F.when(F.col("tx_id") % 20 == 0, F.array(F.lit(0), F.lit(1), F.lit(2)))
        .when(F.col("tx_id") % 10 == 0, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    flipped = F.when(F.col("copy") == 1, 1 - F.col("isFraud")).otherwise(F.col("isFraud"))
    return (
        tx.withColumn("copy", copy)
        .withColumns({"tx_id": F.col("tx_id") + F.col("copy") * 10_000_000, "isFraud": flipped})
        .drop("copy")
    )


def with_unseen_type(tx: DataFrame) -> DataFrame:
    """Some rows carry a type that no training row has."""
    unseen = F.when(F.col("tx_id") % 500 == 1, F.lit("REFUND")).otherwise(F.col("type"))
    return tx.withColumn("type", unseen)


def write_dirty_csv(raw: DataFrame, path: str) -> None:
    """Write transactions as CSV with bad amounts, surplus fields and blank balances mixed in."""
    key = F.col("tx_id")
    dirty = {
        "amount": F.when(key % 97 == 0, F.lit("zz")).otherwise(F.col("amount").cast("string")),
        "oldbalanceDest": F.when(key % 103 == 0, F.lit(" ")).otherwise(
            F.col("oldbalanceDest").cast("string")
        ),
        "isFlaggedFraud": F.when(
            key % 101 == 0, F.concat(F.col("isFlaggedFraud").cast("string"), F.lit(",surplus"))
        ).otherwise(F.col("isFlaggedFraud").cast("string")),
    }
    write_lines(raw, [dirty.get(c, F.col(c)) for c in TX_COLUMNS], path)


def event_transactions(events: DataFrame) -> DataFrame:
    """Events as transactions, for batch and streaming frames.

    The watermark needs a timestamp with a zone; the session's zone is UTC.
    """
    key = F.col("event_id")
    amount = to_money(F.col("value") * 1000)
    drained = key % 4 == 0
    balance = F.col("user_id") * 100
    return events.select(
        key.alias("tx_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        _choose(F.col("event_type"), EVENT_TYPES).alias("type"),
        amount.alias("amount"),
        F.when(drained, amount).otherwise(to_money(balance)).alias("oldbalanceOrg"),
        F.when(drained, to_money(F.lit(0))).otherwise(to_money(balance)).alias("newbalanceOrig"),
        to_money(key % 1000).alias("oldbalanceDest"),
        to_money(key % 977).alias("newbalanceDest"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def read_event_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    """The event table as a stream, whether it is a folder of files or one file.

    A file stream wants a folder, so a single file is picked by name from the folder it lies in. A table
    that is not there fails, since a stream over nothing would not.
    """
    path = f"{sf_dir}/events.parquet"
    if is_folder(spark, path):
        return read_event_files(spark, path, max_files_per_trigger)
    files = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    return files.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def read_event_files(spark: SparkSession, folder: str, max_files_per_trigger: int) -> DataFrame:
    files = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    return files.parquet(folder)


def event_span(events: DataFrame) -> str:
    """Span of event time as a lateness that no row of the table can exceed."""
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    seconds = 0 if low is None else int((high - low).total_seconds())
    return f"{seconds + 1} seconds"


def with_odd_labels(tx: DataFrame) -> DataFrame:
    """Some rows carry no label, others one that is neither 0 nor 1."""
    key = F.col("tx_id")
    odd = F.when(key % 61 == 5, F.lit(None)).when(key % 67 == 5, F.lit(3)).otherwise(F.col("isFraud"))
    return tx.withColumn("isFraud", odd.cast("int"))
