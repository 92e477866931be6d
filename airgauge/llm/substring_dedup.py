"""Substring dedup by level-wise doubling of repeated windows.

A window of n words can only be repeated if the shorter windows inside it are. The levels of n = 35 are 9,
18 and 35 words. At the first, of each stretch of windows that one long window spans, only the one with the
smallest hash is looked at: two equal long windows pick the same one. Those repeated at 9 words alone are
extended to 18, to the right or to the left, as one of the two stays inside the long window. Around the
survivors all long windows are compared. Each level's keys meet in hash buckets; what is repeated goes back
to its documents by id.

A key that several documents of one block hold is settled there: one of them goes to the bucket, marked as
repeated, the others only back to their documents. So a passage that a third of all documents share comes to
its bucket once a block.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm import buckets
from airgauge.llm.common import texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 35
LEAST_LEVEL = 8
CHARS_PER_KEY = 24.0  # of text, for each key of the levels
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")


def levels(n: int) -> list[int]:
    """Window lengths, each half of the next rounded up, none under LEAST_LEVEL but for small n: 9, 18, 35."""
    out = [n]
    while out[0] // 2 >= LEAST_LEVEL:
        out.insert(0, -(-out[0] // 2))
    return out


def extended(n: int) -> bool:
    """Whether a window of the first level, wherever it is in the long one, can be extended to the second inside it."""
    ladder = levels(n)
    return len(ladder) > 1 and 2 * ladder[1] - ladder[0] - 1 <= n


def hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words) if seed else map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each run of n, by runs of doubled length."""
    size = 1
    while size < n:
        step = min(size, n - size)
        x = np.minimum(x[:-step], x[step:])
        size += step
    return x


def picked(keys: np.ndarray, span: int) -> np.ndarray:
    """Places that hold the least key of some run of `span`: equal runs pick equal places."""
    if len(keys) < span:
        return np.zeros(0, np.int64)
    least = sliding_min(keys, span)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    # the greatest least of the runs around a place is its own key if it is picked
    edge = np.zeros(span - 1, np.uint64)
    around = top - sliding_min(top - np.concatenate([edge, least, edge]), span)
    return np.flatnonzero(around == keys)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in [start, start + size) of some start."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, n), -1)
    return np.cumsum(change[:-1]) > 0


def _seeds(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Picked places of the first level, their keys, and their two extensions (0: past an end) as 32 bits each."""
    ladder = levels(n)
    short = buckets.window_keys(words, ladder[0])
    at = picked(short, n - ladder[0] + 1)
    if not extended(n):
        return at, buckets.spread(short[at]), np.zeros((len(at), 2), np.uint32)
    longer = (buckets.window_keys(words, ladder[1]) >> np.uint64(8)).astype(np.uint32) | np.uint32(1)
    ext = np.zeros((len(at), 2), np.uint32)
    right = at < len(longer)
    ext[right, 0] = longer[at[right]]
    before = at - (ladder[1] - ladder[0])
    left = before >= 0
    ext[left, 1] = longer[before[left]]
    return at, buckets.spread(short[at]), ext


def _runs(keys: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the keys (then `more`), and where in it each run of equal ones begins."""
    order = np.lexsort((*more, keys))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (keys, *more)])
    return order, np.flatnonzero(new)


def _distinct(keys: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place for each distinct key (with `more`) of a document, and whether it is there more than once."""
    order, first = _runs(keys, *more)
    return order[first], np.diff(first, append=len(order)) > 1


SEED = np.dtype([("right", "<u4"), ("left", "<u4"), ("again", "u1")])
# A long window has 64 bits of a second hash besides its key: what is removed is decided by both.
WINDOW = np.dtype([("more", "<u8"), ("again", "u1")])


def _sent(uids: np.ndarray, owner: list[np.ndarray], keys: list[np.ndarray], extra: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Rows of one block for the buckets. Of equal keys (with equal extras) one goes there; the others are settled as repeated."""
    own, key, more = np.concatenate(owner), np.concatenate(keys), np.concatenate(extra)
    order, first = _runs(key, *(more[f] for f in more.dtype.names if f != "again"))
    several = np.diff(first, append=len(order)) > 1
    more["again"][order[first[several]]] = 1
    goes = np.zeros(len(key), bool)
    goes[order[first]] = True
    rows = list(buckets.sent(uids, own[goes], key[goes], bits, more[goes]))
    rest = np.flatnonzero(~goes)
    if len(rest):
        cuts = np.flatnonzero(np.diff(own[rest], prepend=-1))
        rows.append({
            "bucket": int(uids[own[rest[0]]]) % (1 << bits), "top": None, "extra": None,
            "docs": buckets._packed(np.diff(uids[own[rest[cuts]]], prepend=0)),
            "sizes": buckets._packed(np.diff(cuts, append=len(rest)).astype("<u4")),
            "keys": key[rest].tobytes(),
        })
    return pa.RecordBatch.from_pylist(rows, schema=buckets.SENT_ARROW)


def _settled(table: pa.Table) -> list[pa.Table]:
    """What blocks have settled, on its way to its documents."""
    out = []
    for row in table.to_pylist():
        cuts = np.concatenate([[0], np.cumsum(buckets._unpacked(row["sizes"], "<u4"))])
        uids = np.cumsum(buckets._unpacked(row["docs"], "<i8"))
        out.append(pa.table({"uid": pa.array(uids), "keys": buckets.blobs(cuts, np.frombuffer(row["keys"], "<u8"))}))
    return out


def _send_seeds(bits: int, n: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in texts_of(batch, "text"):
                uids = batch.column("uid").slice(first, len(texts)).to_numpy()
                owner, keys, extra = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, SEED)]
                for i, t in enumerate(texts):
                    words = t.encode().split()
                    if len(words) < n:
                        continue
                    _, k, ext = _seeds(hashes(words), n)
                    place, again = _distinct(k, ext[:, 0], ext[:, 1])
                    e = np.zeros(len(place), SEED)
                    e["right"], e["left"], e["again"] = ext[place, 0], ext[place, 1], again
                    owner.append(np.full(len(place), i))
                    keys.append(k[place])
                    extra.append(e)
                yield _sent(uids, owner, keys, extra, bits)

    return send


def _answer(docs: np.ndarray, keys: np.ndarray, hit: np.ndarray) -> pa.Table:
    """The keys that hit, a row for each run of one document."""
    at = np.flatnonzero(hit)
    own = docs[at]
    cuts = np.append(np.flatnonzero(np.diff(own, prepend=own[:1] - 1)), len(own)) if len(own) else np.zeros(1, np.int64)
    return pa.table({"uid": pa.array(own[cuts[:-1]], pa.int64()), "keys": buckets.blobs(cuts, keys[at])})


def _repeated(weight: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Which keys (with `more`) are there twice or more, each row counting `weight`."""
    order, first = _runs(keys, *more)
    sums = np.add.reduceat(weight[order], first) if len(order) else weight
    hit = np.empty(len(keys), bool)
    hit[order] = np.repeat(sums > 1, np.diff(first, append=len(order)))
    return hit


def _doubled(longer: bool):
    def run(table: pa.Table) -> pa.Table:
        """In one bucket: seeds repeated at the first level and still at twice its length."""
        docs, keys, extras = buckets.received(table.filter(pa.compute.is_valid(table["top"])))
        seeds = buckets.extras_of(extras, SEED)
        weight = 1 + seeds["again"].astype(np.int64)
        hit = _repeated(weight, keys)
        if longer:
            alive = np.flatnonzero(hit)
            ok = np.zeros(len(alive), bool)
            for side, salt in (("right", 1), ("left", 2)):
                ext = seeds[side][alive]
                there = np.flatnonzero(ext)
                both = buckets.mixed(keys[alive[there]] + np.uint64(salt)) ^ buckets.mixed(ext[there].astype(np.uint64))
                ok[there] |= _repeated(weight[alive[there]], both)
            hit[alive] = ok
        return pa.concat_tables([_answer(docs, keys, hit), *_settled(table.filter(pa.compute.is_null(table["top"])))])

    return run


def _keys_of(cells: pa.Scalar) -> np.ndarray:
    """Sorted keys of a document, out of the answers of all buckets."""
    return np.sort(np.frombuffer(b"".join(cells.as_py() or ()), "<u8"))


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _send_windows(bits: int, n: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = levels(n)[0]
        for batch in batches:
            for first, texts in texts_of(batch, "text"):
                uids = batch.column("uid").slice(first, len(texts)).to_numpy()
                owner, keys, extra = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, WINDOW)]
                for i, (t, cells) in enumerate(zip(texts, batch.column("answers").slice(first, len(texts)))):
                    raw = t.encode().split()
                    words = hashes(raw)
                    at, k, _ = _seeds(words, n)
                    at = at[_among(k, _keys_of(cells))]
                    # all long windows that hold a surviving seed
                    starts = len(words) - n + 1
                    open_ = np.flatnonzero(covered(np.maximum(at - (n - short), 0), n - short + 1, len(words))[:starts])
                    if not len(open_):
                        continue
                    k, more = buckets.window_keys(words, n)[open_], buckets.window_keys(hashes(raw, 1), n)[open_]
                    place, again = _distinct(k, more)
                    e = np.zeros(len(place), WINDOW)
                    e["more"], e["again"] = more[place], again
                    owner.append(np.full(len(place), i))
                    keys.append(k[place])
                    extra.append(e)
                yield _sent(uids, owner, keys, extra, bits)

    return send


def _long_repeats(table: pa.Table) -> pa.Table:
    docs, keys, extras = buckets.received(table.filter(pa.compute.is_valid(table["top"])))
    windows = buckets.extras_of(extras, WINDOW)
    hit = _repeated(1 + windows["again"].astype(np.int64), keys, windows["more"])
    return pa.concat_tables([_answer(docs, keys, hit), *_settled(table.filter(pa.compute.is_null(table["top"])))])


def _removals(docs: DataFrame, n: int) -> DataFrame:
    """uid, doc_id, text, answers: the keys of each document's repeated windows of n words (NULL: none)."""
    chars = buckets.chars_of(docs, "text")
    bits, parts = buckets.bucket_bits(chars, CHARS_PER_KEY), buckets.text_parts(docs, chars)
    # one shuffle of the texts serves all three uses below: Spark reuses equal exchanges of a plan
    rows = docs.repartition(parts, "uid")
    answer = "uid bigint, keys binary"

    def answered(sent: DataFrame, judge) -> DataFrame:
        found = sent.groupBy("bucket").applyInArrow(judge, answer)
        return found.groupBy("uid").agg(F.collect_list("keys").alias("answers"))

    seeds = answered(rows.mapInArrow(_send_seeds(bits, n), buckets.SENT), _doubled(extended(n)))
    windows = answered(rows.join(seeds, "uid").mapInArrow(_send_windows(bits, n), buckets.SENT), _long_repeats)
    return rows.join(windows, "uid", "left")


def _hits(raw_words: list[bytes], cells: pa.Scalar, n: int) -> np.ndarray | None:
    """Which words go; None if none does."""
    if not cells.is_valid or len(raw_words) < n:
        return None
    keys = buckets.window_keys(hashes(raw_words), n)
    return covered(np.flatnonzero(_among(keys, _keys_of(cells))), n, len(raw_words))


def _numbered(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id).alias("doc_id"), F.col(text).alias("text"))


def dedup_digests(docs: DataFrame, n: int = WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_words, n_removed, kept_sha256 (kept words joined by one space) for each row.

    A word goes when a window of n words that covers it starts anywhere else too, in the same row or
    another, judged on the input. NULL, empty and blank texts have no words; texts of fewer than n words
    lose none. Rows that share an id or have none are documents of their own; equal rows of n words or
    more therefore lose all their words. An empty table gives no rows.
    """
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in texts_of(batch, "text"):
                out = []
                for t, cells in zip(texts, batch.column("answers").slice(first, len(texts))):
                    words = t.encode().split()
                    gone = _hits(words, cells, n)
                    kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                    out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
                a, b, c = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c)],
                    names=[id, "n_words", "n_removed", "kept_sha256"],
                )

    found = _removals(_numbered(docs, id, text), n)
    return found.mapInArrow(run, f"`{id}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string")


def cut(text: str, gone: np.ndarray) -> str:
    """The text without the words that go and the white space after each of them."""
    raw = text.encode()
    spans = [m.span() for m in WORD_BYTES.finditer(raw)]
    ends = [s for s, _ in spans[1:]] + [len(raw)]
    pieces = [raw[: spans[0][0]]] + [raw[s:e] for (s, _), e, g in zip(spans, ends, gone.tolist()) if not g]
    return b"".join(pieces).decode()


def dedup_texts(docs: DataFrame, n: int = WORDS, text: str = "text") -> DataFrame:
    """The rows of `docs` with repeated windows cut out of their texts; all else stays, white space included.

    What is cut follows the rules of `dedup_digests`. A text may become empty; its row stays.
    """
    others = [c for c in docs.columns if c != text]
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in texts_of(batch, "text"):
                part = batch.slice(first, len(texts))
                out = []
                for t, known, cells in zip(texts, part.column("text").is_valid().to_pylist(), part.column("answers")):
                    gone = _hits(t.encode().split(), cells, n)
                    out.append(None if not known else t if gone is None else cut(t, gone))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], names=["rest", "text"])

    inner = numbered.schema["doc_id"].dataType.simpleString()
    new = _removals(numbered, n).mapInArrow(run, f"rest {inner}, text string")
    return new.select(*[F.col("text").alias(text) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])
