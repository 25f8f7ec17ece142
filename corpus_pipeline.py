"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor kept and is written as a table before the next one starts, so that a
lost executor costs at most the running stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import minhash, packing, quality_rules, secret_scan, suffix_dedup
from tillwatch.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with cutoffs from the labelled documents still there."""
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that strings of 200 bytes repeat; a character cut in two goes as a whole.

    A document of which nothing remains stays with an empty text.
    """
    kept = suffix_dedup.without_repeats(docs)
    changed = kept.withColumn("text", F.col("_kept_text")).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )
    return changed.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark."""
    return secret_scan.without_secrets(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, in tokens of the tokenizer, and the training sequences that hold them."""
    import public_tokenizers

    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("secrets", secrets),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
