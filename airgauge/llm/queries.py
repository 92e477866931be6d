"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from airgauge.llm import chat_format, embedding_dedup, jaccard_join, language_id, merkle, oracles, packing, prefix_trie, quality_rules
from airgauge.llm import sentence_pieces, substring_dedup, suffix_dedup, token_counts, token_files
from airgauge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path, limit=512)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language_id.profiles(docs)
    return language_id.classified(docs.select("doc_id", "text"), learned).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_audit(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat_format.round_trip(given.unionByName(probe))


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_token_counts": op4_token_counts,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_format": op13_chat_format,
}

ORACLES: dict[str, str] = {
    "op11_merkle_manifest": oracles.MERKLE_MANIFEST,
    "op12_prefix_trie": oracles.PREFIX_TRIE,
    "op13_chat_format": oracles.CHAT_FORMAT,
}
