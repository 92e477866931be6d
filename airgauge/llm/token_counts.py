"""Token counts by a two-tier lookup in the map tasks: no pre-token of a text is ever shuffled.

Tier one is a broadcast hash table of the frequent pre-tokens with their numbers of tokens; tier two is a
cache in each worker for what the table lacks, filled by the vocabulary's merges. Both only decide where a
length is looked up, never what it is.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import kept_in_worker, texts_of
from airgauge.llm.tokenizing import LONGEST_KEPT, MOST_KEPT, Tokens, byte_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The table of frequent pre-tokens has so many entries at most.
MOST_FREQUENT = 30_000
# A task counts all its pre-tokens but holds so many; what is rarer than 1 in HELD of them may be undercounted.
HELD = 4 * MOST_FREQUENT


class Table:
    """Lengths by pre-token in flat arrays: slots of 128 bits of hash and a length (0: free), collisions in the next slots."""

    def __init__(self, pieces: list[str], lengths: list[int]):
        size = 1 << max(4, (2 * len(pieces)).bit_length())
        self.low, self.high, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint32)
        self.probes = 0
        low, high = self.hashed(pieces)
        left = np.arange(len(pieces))
        while len(left):
            slot = self._slot(low[left], self.probes)
            free = np.flatnonzero(self.length[slot] == 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            at = slot[put]
            self.low[at], self.high[at], self.length[at] = low[left[put]], high[left[put]], np.asarray(lengths, np.uint32)[left[put]]
            left = np.delete(left, put)
            self.probes += 1

    def _slot(self, low: np.ndarray, step: int) -> np.ndarray:
        return ((low + np.uint64(step)) & np.uint64(len(self.length) - 1)).astype(np.int64)

    @staticmethod
    def hashed(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(p) for p in pieces]), "<u8").reshape(-1, 2)
        return raw[:, 0].copy(), raw[:, 1].copy()

    def find(self, pieces: list[str]) -> np.ndarray:
        """The length of each, 0 where it is not in the table."""
        low, high = self.hashed(pieces)
        found = np.zeros(len(pieces), np.uint32)
        left = np.arange(len(pieces))
        for step in range(self.probes):
            slot = self._slot(low[left], step)
            hit = (self.low[slot] == low[left]) & (self.high[slot] == high[left])
            length = self.length[slot]
            found[left[hit]] = length[hit]
            left = left[~hit & (length > 0)]  # a free slot ends the search
        return found


class PreTokens:
    """Pre-tokens of any text for the vocabulary files that `tokenizing.kind_of` knows."""

    def __init__(self, path: str):
        self.tokens = Tokens(path)
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        own = sorted((t["content"] for t in added if not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])), key=len, reverse=True)
        # Strings of added tokens are tokens wherever they stand, and what is between them is split on its own.
        self.added = re.compile("|".join(map(re.escape, own)) if own else r"(?!)")
        self.known = self.tokens.kind is not None and len(own) == len(added)

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and the number of added tokens in it."""
        plain = self.tokens.pieces(text)
        if plain is not None:
            return plain, 0
        pieces: list[str] = []
        parts = self.added.split(text)
        for part in parts:
            plain = self.tokens.pieces(part)
            pieces += self._by_library(part) if plain is None else plain
        return pieces, len(parts) - 1

    def _by_library(self, part: str) -> list[str]:
        library = self.tokens.library
        if library.normalizer is not None:
            part = library.normalizer.normalize_str(part)
        return [part[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(part)]


class Lengths:
    """Numbers of tokens of texts: the broadcast table, then the worker's cache, then the vocabulary's merges."""

    def __init__(self, path: str, frequent: Table):
        self.pre = PreTokens(path)
        self.library = self.pre.tokens.library
        self.frequent = frequent
        self.missed: dict[str, int] = {}
        self.letters = byte_letters()

    def of(self, texts: list[str]) -> list[int]:
        if not self.pre.known:
            return [len(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        split = [self.pre.split(t) for t in texts]
        known = self.by_piece(list(set().union(*(pieces for pieces, _ in split))))
        return [sum(map(known.__getitem__, pieces)) + added for pieces, added in split]

    def by_piece(self, pieces: list[str]) -> dict[str, int]:
        found = self.frequent.find(pieces)
        known = dict(zip(pieces, found.tolist()))
        if len(self.missed) > MOST_KEPT:
            self.missed.clear()
        for i in np.flatnonzero(found == 0).tolist():
            piece = pieces[i]
            n = self.missed.get(piece)
            if n is None:
                n = self.encoded(piece)
                if len(piece) <= LONGEST_KEPT:
                    self.missed[piece] = n
            known[piece] = n
        return known

    def encoded(self, piece: str) -> int:
        return len(self.library.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))


class PieceLengths:
    """The same face for a sentencepiece model, whose library takes whole texts."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def of(self, texts: list[str]) -> list[int]:
        return [len(self.library.encode(t)) for t in texts]


def thinned(counts: Counter[str], held: int) -> int:
    """Leaves the `held` most frequent at most, all counts less by the greatest that goes; returns that one."""
    cut = sorted(counts.values(), reverse=True)[held]
    for piece in [p for p, n in counts.items() if n <= cut]:
        del counts[piece]
    for piece in counts:
        counts[piece] -= cut
    return cut


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", most: int = MOST_FREQUENT, held: int = HELD) -> Table:
    """Lengths of the most frequent pre-tokens of all documents, `most` at most.

    Each task counts all its pre-tokens in bounded memory and reports those that are at least 1 in `held` of them:
    `held` rows at most, whatever it read. Only these reports are summed, and only the top `most` reach the driver.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = kept_in_worker(f"pre-tokens {path}", lambda: PreTokens(path))
        counts: Counter[str] = Counter()
        seen = lost = 0
        for batch in batches:
            for _, texts in texts_of(batch, text):
                for t in texts:
                    pieces = pre.split(t)[0]
                    seen += len(pieces)
                    counts.update(pieces)
                if len(counts) > 2 * held:
                    lost += thinned(counts, held)
        least = max(2, seen / held) - lost
        often = {p: n for p, n in counts.items() if n >= least and len(p) <= LONGEST_KEPT}
        yield pa.RecordBatch.from_arrays([pa.array(list(often), pa.string()), pa.array(list(often.values()), pa.int64())], names=["piece", "n"])

    library = Lengths(path, Table([], []))
    if not library.pre.known:
        return library.frequent
    counted = docs.select(text).mapInArrow(report, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    top = [r.piece for r in counted.orderBy(F.desc("n"), "piece").limit(most).collect()]
    return Table(top, [library.encoded(p) for p in top])


def token_counts(docs: DataFrame, path: str, limit: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for each row of `docs`.

    NULL texts count as empty: 0 bytes, 0 tokens. Repeated rows and NULL ids stay as they are; an empty
    table gives no rows. `path` names a tokenizers .json or a sentencepiece .model file on every worker. Vocabularies
    that merge across pre-tokens, or whose splitting is not known here, take whole texts through their library.
    """
    piece_model = path.endswith(".model")
    # MOST_FREQUENT entries at most: 20 bytes a slot, at most four slots an entry
    shared = docs.sparkSession.sparkContext.broadcast(None if piece_model else frequent_lengths(docs, path, text))
    name = f"lengths {uuid.uuid4().hex}"
    kind = docs.schema[id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (lambda: PieceLengths(path)) if piece_model else (lambda: Lengths(path, shared.value))
        lengths = kept_in_worker(name, made)
        for batch in batches:
            counts = [n for _, texts in texts_of(batch, text) for n in lengths.of(texts)]
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).cast(pa.int64())
            n_tokens = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), n_bytes, n_tokens, pa.compute.greater(n_tokens, limit)], names=[id, "n_bytes", "n_tokens", "over_limit"]
            )

    return docs.select(id, text).mapInArrow(count, f"`{id}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
