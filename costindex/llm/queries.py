"""Queries of the training-data operators over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from costindex.llm.common import read
from costindex.llm import (
    bpe, chat, conversation_repair, embedding_dedup, html_extract, packing, periodic_runs, pii, quality_rules, simhash,
    stream_dedup, token_counts, warc)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of a label at a cosine of 0.98 or more."""
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.main_text(read(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens: one row per piece."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; cutoffs certified on the labelled ones, per language."""
    return quality_rules.quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded by byte-level BPE."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, 3 bits."""
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, each distinct text encoded once."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives in ZIP files and read back by range."""
    return warc.archive_round_trip(read(spark, sf_dir, "pages"))


def chat_turns(conversations: DataFrame) -> DataFrame:
    """All conversations with their text as one part, and conversation -1, whose texts are control strings."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    tricky = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(chat.TRICKY).alias("text"))
    return rows.unionByName(tricky).withColumn("parts", chat.text_part(F.col("text")))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted and read back."""
    return chat.chat_digests(chat.format_chat(chat_turns(read(spark, sf_dir, "conversations"))))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.pii_report(read(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents, passed through a stream with keyed state."""
    return stream_dedup.exact_duplicates(spark, f"{sf_dir}/documents.parquet")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired by the cheapest edits."""
    return conversation_repair.repair_report(read(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of which get a repeated tail first."""
    docs = periodic_runs.planted(read(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.with_runs(docs))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_embedding_near_dedup,
        op2_html_extraction,
        op3_packing,
        op4_quality_rules,
        op5_bpe,
        op6_simhash_near_dedup,
        op7_token_counts,
        op8_warc,
        op9_chat_formatting,
        op10_pii,
        op11_exact_dedup,
        op12_conversation_repair,
        op13_periodic_runs,
    )}


def sql_all() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": embedding_dedup.LINKS_SQL,
        "op4_quality_rules": quality_rules.verdict_sql_query(),
        "op8_warc": warc.ROUND_TRIP_SQL,
        "op9_chat_formatting": chat.CHAT_SQL,
        "op11_exact_dedup": stream_dedup.DUPLICATES_SQL,
        "op12_conversation_repair": conversation_repair.REPAIR_SQL,
    }
