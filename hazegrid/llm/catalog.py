"""Queries of the training-data operators over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.llm import (ann, chat, mixing, neardup, packing, pii, quality, resampling, rules,
                          sharding, tokens, toxicity, trie)
from hazegrid.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 8


def op1_onebit_search(spark: SparkSession, folder: str) -> DataFrame:
    """20 largest inner products of every 20th vector against all others."""
    return ann.nearest(read(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.duplicate_components(read(spark, folder, "documents"), size=2, percent=80)


def op3_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents")).select(
        "doc_id", "n_tokens", "bucket", "padded_to", "batch", "slot")


def op4_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return rules.weak_quality(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "votes", "p_quality")


def op5_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A mixture of one and a half times the corpus's tokens, with evener sources."""
    mixed = mixing.mix(read(spark, folder, "documents"), budget=mixing.BUDGET,
                       entropy=mixing.ENTROPY, passes=mixing.PASSES)
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "place")


def op6_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return scored.select("doc_id", (~toxicity.in_training()).alias("held_out"), "score", "predicted")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokens.count_tokens(read(spark, folder, "documents"),
                               public_tokenizers.path("word_bpe_49k.json"))


def op8_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of near equal bytes."""
    placed = sharding.shard(read(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.collapse_and_render(read(spark, folder, "conversations"))


def op10_co_training(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's words and word pairs.

    Null and empty texts have no features and weight 0; ties go to the smaller doc_id.
    """
    return resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark")
                               ).select("doc_id", "n_features", "weight", "score", "rank")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All prefixes of the rebuilt conversations; rows without a conv_id take no part."""
    return trie.prefix_trie(read(spark, folder, "conversations"), trie.rebuilt)


def op13_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text: sure patterns, and spans a fitted field adds to them.

    Null and empty texts have no spans; repeated rows are searched one by one.
    """
    return pii.digest(pii.find(read(spark, folder, "documents")))


def queries() -> dict[str, Query]:
    ops = (op1_onebit_search, op2_bbit_minhash, op3_length_buckets, op4_weak_supervision,
           op5_temperature_mixing, op6_counterfactual_toxicity, op7_token_counts,
           op8_histogram_shards, op9_chat_snapshots, op10_co_training,
           op11_importance_resampling, op12_prefix_trie, op13_semi_markov_pii)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    out = {"op5_temperature_mixing": mixing.oracle(), "op9_chat_snapshots": chat.oracle(),
           "op11_importance_resampling": resampling.oracle(), "op12_prefix_trie": trie.oracle()}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
