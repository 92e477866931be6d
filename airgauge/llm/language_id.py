"""Language by rank-order profiles: out-of-place distance between the most frequent n-grams.

A profile is the list of the most frequent letter n-grams (1 to 3, words padded with a border) of a
language. A document's own list is compared with each: every n-gram costs how far its rank is out of
place, or the longest way when the profile lacks it. The nearest profile names the language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgauge.llm.common import kept_in_worker, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANKS = 300
MOST_PER_LANGUAGE = 4_000  # documents a profile is learned from; every document is classified
UNKNOWN = "und"
BORDER = 1  # a code point that is no letter, beside every word

Profiles = list[tuple[str, list[int]]]


def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else the border."""
    table = np.full(0x110000, BORDER, np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """All n-grams of the text as numbers: 21 bits for each code point, so lengths never collide."""
    codes = letters[np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")]
    codes = np.concatenate([[BORDER], codes, [BORDER]])
    inner = codes[1:] != BORDER
    codes = np.concatenate([codes[:1], codes[1:][inner | (codes[:-1] != BORDER)]])
    one = codes[codes != BORDER]
    two = codes[:-1] << 21 | codes[1:]
    middle = codes[1:-1] != BORDER
    three = (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[middle]
    return np.concatenate([one, two, three]) if len(one) else one


def ranked(text: str, letters: np.ndarray, most: int = RANKS) -> np.ndarray:
    """The text's n-grams by falling count, then by number."""
    keys, counts = np.unique(grams(text, letters), return_counts=True)
    return keys[np.lexsort((keys, -counts))[:most]]


class Classifier:
    def __init__(self, profiles: Profiles):
        self.letters = kept_in_worker("letters", _letters)
        self.names = [name for name, _ in profiles]
        keys = sorted({k for _, p in profiles for k in p})
        self.keys = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        place = {k: i for i, k in enumerate(keys)}
        # rank of each known n-gram in each profile; RANKS and more: it is not there
        self.ranks = np.full((len(profiles), len(self.keys)), -1, np.int64)
        for row, (_, profile) in enumerate(profiles):
            for rank, k in enumerate(profile):
                self.ranks[row, place[k]] = rank

    def __call__(self, text: str) -> tuple[str, float]:
        own = ranked(text, self.letters)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        there = self.keys[at] == own
        theirs = np.where(there, self.ranks[:, at], -1)
        cost = np.where(theirs < 0, RANKS, np.abs(theirs - np.arange(len(own))))
        total = cost.sum(axis=1)
        best = int(np.argmin(total))  # the first of equals: names are in order
        return self.names[best], float(1.0 - total[best] / (RANKS * len(own)))


def held_out(id: str = "doc_id") -> Column:
    """Documents no profile is learned from. A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def profiles(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST_PER_LANGUAGE) -> Profiles:
    """The profile of each language value, from about `most` of its documents that are not held out."""
    known = docs.where(~held_out(id) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    known = known.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    # a row per language, so it is broadcast; a language's share of hash space bounds what is read of it
    sizes = known.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    chosen = known.join(F.broadcast(sizes), "_lang").where(F.pmod(F.xxhash64("_id", "_text"), F.lit(1_000_000)) * F.col("_n") < most * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = kept_in_worker("letters", _letters)
        for batch in batches:
            for first, texts in texts_of(batch, "_text"):
                found: dict[str, list[np.ndarray]] = {}
                for name, t in zip(batch.column("_lang").slice(first, len(texts)).to_pylist(), texts):
                    found.setdefault(name, []).append(grams(t, letters))
                for name, parts in found.items():
                    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
                        names=["lang", "gram", "n"],
                    )

    counted = chosen.select("_lang", "_text").mapInArrow(count, "lang string, gram bigint, n bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKS).collect()  # RANKS rows a language
    by: dict[str, list[tuple[int, int]]] = {}
    for r in top:
        by.setdefault(r.lang, []).append((r.rank, r.gram))
    return [(name, [g for _, g in sorted(by[name])]) for name in sorted(by)]


def classified(docs: DataFrame, learned: Profiles, text: str = "text") -> DataFrame:
    """Every row of `docs` with lang_pred and score (1: every rank in place; 0: no n-gram shared).

    NULL texts and texts without a letter are `und` with score 0, as is everything when no language was
    learned. Of equally near languages the first in order of names is taken. Columns of these two names
    that `docs` already has are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(learned)  # RANKS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(shared.value)
        for batch in batches:
            for first, texts in texts_of(batch, text):
                names, scores = zip(*map(classify, texts))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, len(texts)).columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*batch.schema.names, "lang_pred", "score"],
                )

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))
