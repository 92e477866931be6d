"""Answers to stored chunks: every rule's answer is rendered, compared with what is stored, protected and appended."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.operators import chunks as ch
from airgauge.plans.questions import QUESTIONS, Question
from airgauge.sources.landing import path_exists

# Columns that are stored encrypted.
PROTECTED = ("texto", "datos_negocio")
STORED_KEYS = "chunk_id string, hash_contenido string"
AT_ONCE = 4  # rules that are published at the same time


def rule_version(question: Question) -> str:
    """A digest of what makes a rule's chunks: another template, key, label or limit is another version."""
    said = [question.id, question.mart, question.key, question.template, question.scope, question.pii, question.min_rows, question.max_rows]
    return hashlib.sha256(json.dumps(said, ensure_ascii=False, default=list).encode()).hexdigest()[: ch.HASH_LENGTH]


def rule_chunks(marts: Mapping[str, DataFrame], rules: Sequence[str], run_id: str, created: Column, salt: str) -> DataFrame:
    """The chunks of several rules, each with its rule's version and a key that is unique over all rules."""
    out = None
    for qid in rules:
        question = QUESTIONS[qid]
        made = question.chunks(question.run(marts, ordered=False), run_id, created, salt).withColumn("regla_version", F.lit(rule_version(question)))
        out = made if out is None else out.unionByName(made)
    return out.withColumn("chunk_clave", F.concat_ws("|", "regla_id", "chunk_id"))


def publish_chunks(
    marts: Mapping[str, DataFrame], root: str, key: Column, run_id: str, created: Column, salt: str, rules: Sequence[str] | None = None
) -> None:
    """Append the chunks under `root` that are not there yet, text and business data encrypted with `key`.

    The stored chunks are a folder per rule; of those of the published rules only ids and hashes are read, as
    cipher texts differ each time. Publishing again adds nothing; a changed answer is a new chunk beside the old.
    A rule's chunks are made twice, from stored marts: for their ids and hashes, and where some are to be added.
    These are encrypted in the tasks that make them and go straight to the rule's folder: cipher texts, which no
    codec makes smaller than their bytes, are neither shuffled nor sorted.
    """

    def publish(qid: str) -> None:
        new, folder = rule_chunks(marts, [qid], run_id, created, salt), f"{root}/regla_id={qid}"
        spark, stored = new.sparkSession, None
        if path_exists(spark, folder):
            stored = spark.read.schema(STORED_KEYS).parquet(folder).withColumn("regla_id", F.lit(qid))
        fresh = ch.missing_chunks(new, stored)
        if fresh is not None:
            locked = ch.protect(fresh.drop("regla_id"), PROTECTED, key)
            locked.write.mode("append").option("compression", "zstd").parquet(folder)

    # rules have nothing to do with each other: a few at a time keep the cluster busy between small ones
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(publish, qid) for qid in rules or QUESTIONS]:
            done.result()


def read_chunks(spark: SparkSession, root: str, key: Column) -> DataFrame:
    """The stored chunks in clear text."""
    return ch.unprotect(spark.read.parquet(root), PROTECTED, key)
