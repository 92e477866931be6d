"""Documents to packed training sequences: rules, language, near copies, repeats, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.llm import jaccard_join, language_id, packing, quality_rules, substring_dedup
from airgauge.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text less like every learned language than this is no text of any of them.
LEAST_SCORE = 0.1


def _rows(docs: DataFrame) -> DataFrame:
    """All columns but the text as one, so that none can clash with those an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*["text" if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep (NULL and empty texts go)."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return _columns(quality_rules.judged(_rows(docs), rules, keep=("row", "text")).where("kept"), docs)


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents themselves teach; those without letters or like none of them go."""
    found = language_id.classified(_rows(docs), language_id.profiles(docs))
    return _columns(found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies; all documents that are no copies."""
    return jaccard_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that stand elsewhere too; n_chars follows the text. No row goes."""
    cut = substring_dedup.dedup_texts(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of 4096."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("language_id", known_languages),
    ("jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("best_fit_packing", packed_sequences),
]

# Learned rules, language profiles and packing are not SQL: the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
