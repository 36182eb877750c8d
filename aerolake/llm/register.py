"""Registered queries of the operators, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.bpe_codec import encoded
from aerolake.llm.bpe_counts import token_counts
from aerolake.llm.chat import chat_documents
from aerolake.llm.collocations import collocations
from aerolake.llm.conversation_trie import conversation_trie
from aerolake.llm.decontamination import contamination
from aerolake.llm.host_rules import host_verdicts
from aerolake.llm.language_id import identify_languages
from aerolake.llm.mixing import pivotal_mix
from aerolake.llm.ngram_join import similarity_classes
from aerolake.llm.pii import personal_data, told
from aerolake.llm.substring_dedup import without_repeats
from aerolake.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark contamination of every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by byte-pair merging."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and host-level verdict of every document."""
    return host_verdicts(table(spark, sf_dir, "documents"))


def op4_pii_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of a smaller document."""
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat_documents(table(spark, sf_dir, "conversations"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify_languages(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity class of every document and its text's links."""
    return similarity_classes(table(spark, sf_dir, "documents"))


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return pivotal_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of every language."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    coded = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_token_counts": op2_token_counts,
        "op3_host_rules": op3_host_rules,
        "op4_pii_candidates": op4_pii_candidates,
        "op5_toxicity": op5_toxicity,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_chat_snapshots": op7_chat_snapshots,
        "op8_language_id": op8_language_id,
        "op9_ngram_join": op9_ngram_join,
        "op10_pivotal_mix": op10_pivotal_mix,
        "op11_collocations": op11_collocations,
        "op12_bpe_codec": op12_bpe_codec,
        "op13_conversation_trie": op13_conversation_trie,
    }
