"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import (
    chat,
    collocations,
    embeddings,
    fill_middle,
    graph_search,
    minhash,
    packing,
    quality_rules,
    secret_scan,
    suffix_dedup,
    warc,
)
from tillwatch.llm.bpe_codec import decode_ids, encode_texts
from tillwatch.llm.common import table
from tillwatch.llm.oracles import ORACLES
from tillwatch.llm.token_counts import count_tokens

CONTROL_TEXT = r"\### Assistant: </turn> ok"
"""Both texts of conversation -7."""


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, threshold=0.85)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.pack_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("record")
    )
    said = [{"role": role, "content": CONTROL_TEXT} for role in ("user", "assistant")]
    own = spark.range(1).select(F.lit(json.dumps({"conv_id": -7, "messages": said})).alias("record"))
    turns = chat.canonical_turns(rows.unionAll(own))
    return chat.read_back(chat.format_turns(turns.where("layout IS NOT NULL")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.quality_report(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("spans")).alias("spans"),
    )


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_texts(table(spark, sf_dir, "documents"), ranks, pattern)
    decoded = decode_ids(encoded, ranks, pattern)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return graph_search.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(rows), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_token_counts": op2_token_counts,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc": op4_warc,
    "op5_minhash_neardup": op5_minhash_neardup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_secret_scan": op10_secret_scan,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_fill_in_middle": op13_fill_in_middle,
}

__all__ = ["ORACLES", "QUERIES"]
