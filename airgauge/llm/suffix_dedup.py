"""Exact substring dedup with suffix arrays of shards.

Only stretches of text that may be repeated are sorted: of each run of short windows that one long string
spans, the one with the smallest hash is counted over the corpus, with a byte of what follows and precedes
it, and the stretches around those that two documents hold form the shards. Stretches with the same smallest
repeated window share a shard (a very common one is split over several). A shard's suffixes are sorted by doubling in the manner of Larsson and
Sadakane: only groups that are not yet told apart are sorted again. Kasai's walk gives the common prefixes,
capped at the length asked for, and they give the equal strings. Of each, the smallest document is known in
the shard; strings whose short window other shards hold too are then merged by binary search over the sorted
hashes of all shards, which shows where a still smaller document is elsewhere.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm import buckets
from airgauge.llm.common import release, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 50
SEED = 20  # bytes of the short windows
SEED_WIDTH = 5  # bytes of their keys: they only choose what is compared, so two that clash do no harm
SEED_TOP = 4  # bits above these; two fewer than of other keys, so that a quarter of the buckets take them, evenly
SEED_SHIFT = np.uint64(SEED_TOP + 8 * SEED_WIDTH)
SLICE_KEYS = 500_000  # keys of a bucket that are sorted together, about
SHARD_BYTES = 2_000_000
MOST_ALIKE = 2_000  # documents of one smallest window that share a shard
MOST_COUNTED = 65_535  # documents of one short window, as far as they are counted; also: not known
BLOCK_CHARS = 1_000_000
CHARS_PER_KEY = 16.0
LAST = np.iinfo(np.int64).max  # the order of documents without an id: after all others
WALKS = 64  # steps of Kasai's walk; as many walks at once as it takes


# --- one shard --------------------------------------------------------------------


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, zeros past the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray(len(text), ">u8", padded, strides=(1,)).astype(np.uint64)


def _group_starts(new: np.ndarray) -> np.ndarray:
    """For each slot, the first slot of its group; `new` marks the first ones."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_array(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes in order of their first bytes, `length` or more; the slot of each; and how many bytes that are."""
    n = len(text)
    words = words_at(text)
    order = np.argsort(words)
    sorted_words = words[order]
    new = np.ones(n, bool)
    new[1:] = sorted_words[1:] != sorted_words[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(new)
    known = 8
    while known < length:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        there = order[slots]
        beyond = there + known
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        keys = rank[there] * (n + 1) + second
        by = np.argsort(keys)
        order[slots] = there[by]
        keys = keys[by]
        new[slots[1:]] |= keys[1:] != keys[:-1]
        # ranks of the groups that were split; slots of a group are neighbours
        rank[order[slots]] = _group_starts(new)[slots]
        known *= 2
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    return order, slot, known


def common_prefixes(text: np.ndarray, order: np.ndarray, slot: np.ndarray, depth: int) -> np.ndarray:
    """For each slot, the bytes its suffix has in common with the one before, `depth` at most.

    Kasai's walk: the next suffix of the text has at least one byte less in common than this one. As the
    order holds for `depth` bytes only, that is so after a shorter prefix, or when the neighbour moves on
    with the text. The text is walked from many places at once, in step.
    """
    n = len(text)
    words = np.concatenate([words_at(text), np.zeros(depth + 9, np.uint64)])
    before = np.where(slot > 0, order[np.maximum(slot - 1, 0)], n)
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, WALKS)
    had = np.zeros(len(starts), np.int64)
    last = np.full(len(starts), -2)
    for step in range(WALKS):
        at = starts + step
        at = at[at < n]
        other = before[at]
        had, last = had[: len(at)], last[: len(at)]
        had = np.where(((had < depth) | (other == last + 1)) & (other < n), np.maximum(had - 1, 0), 0)
        last = other
        open_ = np.flatnonzero(other < n)
        while len(open_):
            p, q, k = at[open_], other[open_], had[open_]
            differ = words[p + k] ^ words[q + k]
            same = (differ == 0).astype(np.int64)
            for b in range(1, 8):
                same += differ < np.uint64(1 << 64 - 8 * b)
            # past the end there are zeros: they are nobody's bytes
            most = np.minimum(depth, n - np.maximum(p, q))
            k = np.minimum(k + same, most)
            had[open_] = k
            open_ = open_[(same == 8) & (k < most)]
        out[at] = had
    return out[order]


def equal_strings(text: np.ndarray, valid: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of places where a whole string starts (`valid`), with the order of their documents (`rank`): those whose
    string also starts in a smaller document here, and those in the smallest document of their string."""
    order, slot, depth = suffix_array(text, length)
    prefix = common_prefixes(text, order, slot, depth)
    first = np.flatnonzero(prefix < length)
    held = np.where(valid, rank, LAST)[order]
    least = np.repeat(np.minimum.reduceat(held, first), np.diff(first, append=len(text)))
    ok = valid[order]
    return np.sort(order[ok & (held > least)]), np.sort(order[ok & (held == least)])


# --- corpus -----------------------------------------------------------------------


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    steps = range(0, len(x) - n + 1, buckets.PIECE)
    return np.concatenate([x[:0], *(_sliding_min(x[at : at + buckets.PIECE + n - 1], n) for at in steps)])


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while size < n:
        step = min(size, n - size)
        x = np.minimum(x[:-step], x[step:])
        size += step
    return x


class Seeds:
    """Of texts in a row: the short windows of k bytes that some string of n bytes picks (its smallest hash)."""

    def __init__(self, texts: list[bytes], n: int, k: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        self.n, self.span, self.ends = n, n - k + 1, np.cumsum(sizes)
        self.starts = self.ends - sizes
        keys = buckets.window_keys(raw.astype(np.uint64), k) if len(raw) >= n else np.zeros(0, np.uint64)
        self.keys = keys >> np.uint64(buckets.KEY_BITS - SEED_TOP - 8 * SEED_WIDTH)
        # no string crosses from one text into the next
        whole = np.stack([np.maximum(sizes - n + 1, 0), np.minimum(sizes, n - 1)], axis=1).reshape(-1)
        self.inside = np.repeat(np.tile([True, False], len(sizes)), whole)[: max(0, len(raw) - n + 1)]
        if not len(self.keys):
            self.at = np.zeros(0, np.int64)
        else:
            # one is added, so that no key is as small as what stands for "no string"
            least = np.where(self.inside, sliding_min(self.keys, self.span) + np.uint64(1), np.uint64(0))
            edge = np.zeros(self.span - 1, np.uint64)
            top = np.uint64(0xFFFFFFFFFFFFFFFF)
            around = top - sliding_min(top - np.concatenate([edge, least, edge]), self.span)
            self.at = np.flatnonzero(around == self.keys + np.uint64(1))
        self.owner = np.searchsorted(self.ends, self.at, side="right")

    def beside(self, by: int) -> np.ndarray:
        """A byte of the key `by` places further on, in the same text; 0 if there is none."""
        there = self.at + by
        ok = (there >= self.starts[self.owner]) & (there < self.ends[self.owner] - (self.n - self.span))
        out = np.zeros(len(there), np.uint8)
        out[ok] = (self.keys[there[ok]] % np.uint64(255)).astype(np.uint8) + np.uint8(1)
        return out

    def strings(self, chosen: np.ndarray) -> np.ndarray:
        """For each place, whether a string starts there that picks one of `at` for which `chosen` holds."""
        if not len(self.keys):
            return self.inside
        marked = self.keys << np.uint64(1)
        marked[self.at] |= (~chosen).astype(np.uint64)
        return self.inside & (sliding_min(marked, self.span) & np.uint64(1) == 0)


SIDES = np.dtype([("right", "u1"), ("left", "u1")])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for first, texts in texts_of(batch, "text", BLOCK_CHARS):
            yield batch.slice(first, len(texts)), [t.encode() for t in texts]


def _send_seeds(bits: int, n: int, k: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _blocks(batches):
            seeds = Seeds(texts, n, k)
            keys, owner = seeds.keys[seeds.at], seeds.owner
            # of a string of n bytes, so many on one side of the short window or the other are inside
            sides = np.zeros(len(keys), SIDES)
            sides["right"], sides["left"] = seeds.beside((n - k) // 2), seeds.beside(-((n - k) // 2))
            # once for each document: sorted by a hash of all, equal ones are neighbours
            order = np.argsort(_mixed(keys, owner, sides["right"], sides["left"]))
            new = np.ones(len(order), bool)
            for c in (keys, owner, sides["right"], sides["left"]):
                new[1:] &= c[order[1:]] == c[order[:-1]]
            new[1:] ^= True
            one = np.sort(order[new])
            rows = list(buckets.sent(part.column("uid").to_numpy(), owner[one], _spread(keys[one]), bits, sides[one], SEED_WIDTH))
            yield pa.RecordBatch.from_pylist(rows, schema=buckets.SENT_ARROW)

    return send


def _spread(keys: np.ndarray) -> np.ndarray:
    return buckets.spread(keys, SEED_WIDTH, SEED_TOP)


def _mixed(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = buckets.mixed(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
    return out


def _groups(*columns: np.ndarray) -> np.ndarray:
    """A number for each row, equal for equal rows (told apart by 64 bits of hash)."""
    keys = _mixed(*columns)
    order = np.argsort(keys)
    new = np.zeros(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _shared_seeds(table: pa.Table) -> pa.Table:
    """In one bucket: short windows that are repeated with the bytes on one of their sides, for each document once,
    with how many documents hold them. Keys are taken a slice of them at a time."""
    docs, keys, extras = buckets.received(table, width=SEED_WIDTH)
    sides = buckets.extras_of(extras, SIDES)
    slices = -(-len(keys) // SLICE_KEYS)
    held = np.zeros(len(keys), "<u4")
    for i in range(slices):
        at = _slice(keys, slices, i)
        held[at] = _held(docs[at], keys[at], sides[at])
    at = np.flatnonzero(held)
    own = docs[at]
    cuts = np.append(np.flatnonzero(np.diff(own, prepend=own[:1] - 1)), len(own)) if len(own) else np.zeros(1, np.int64)
    out = pa.table({"uid": pa.array(own[cuts[:-1]], pa.int64()), "keys": buckets.blobs(cuts, keys[at]), "held": buckets.blobs(cuts, held[at])})
    release()
    return out


def _slice(keys: np.ndarray, slices: int, i: int) -> np.ndarray:
    """Where the keys of one slice are: all that are equal are in the same one."""
    steps = range(0, len(keys), SLICE_KEYS)
    return np.concatenate([b + np.flatnonzero(keys[b : b + SLICE_KEYS] % np.uint64(slices) == i) for b in steps])


def _held(docs: np.ndarray, keys: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """How many documents hold each key, once for each document; 0 for the others and for what is not repeated."""
    out = np.zeros(len(keys), np.int64)
    _, counts = buckets.run_lengths(keys)
    at = np.flatnonzero(counts > 1)
    ok = np.zeros(len(at), bool)
    for side in ("right", "left"):
        there = np.flatnonzero(sides[side][at])
        group = _groups(keys[at[there]], sides[side][at[there]])
        ok[there] |= np.bincount(group, minlength=1)[group] > 1
    at = at[ok]
    pair = _groups(keys[at], docs[at])
    at = at[np.sort(np.unique(pair, return_index=True)[1])]
    _, counts = buckets.run_lengths(keys[at])
    out[at] = np.where(counts > 1, counts, 0)
    return out


def _stretches(n: int, k: int):
    """The stretches of each document where strings with repeated short windows are, and the shard of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _blocks(batches):
            seeds = Seeds(texts, n, k)
            found = [(_cells(c, "keys", "<u8"), _cells(c, "held", "<u4")) for c in part.column("answers").to_pylist()]
            known = np.concatenate([f[0] for f in found])
            held = np.concatenate([f[1] for f in found])
            whose = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            # a text that answers name has a string of n bytes, so that a block's texts can be numbered in what a key leaves
            named = whose.astype(np.uint64) << SEED_SHIFT | known
            by = np.argsort(named)
            named, held = named[by], held[by]

            def holders(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
                """How many documents hold each key, 0 for those not known of its text."""
                asked = owner.astype(np.uint64) << SEED_SHIFT | _spread(keys)
                if not len(named):
                    return np.zeros(len(keys), np.uint32)
                at = np.minimum(np.searchsorted(named, asked), len(named) - 1)
                return np.where(named[at] == asked, held[at], 0).astype(np.uint32)

            open_ = np.flatnonzero(seeds.strings(holders(seeds.keys[seeds.at], seeds.owner) > 0))
            if not len(open_):
                continue
            # runs of bytes: a string starts where the last one has not ended, in the same text
            text = np.searchsorted(seeds.ends, open_, side="right")
            new = np.flatnonzero((np.diff(open_, prepend=-n) > n) | (np.diff(text, prepend=-1) != 0))
            begin, text = open_[new], text[new]
            end = np.append(open_[new[1:] - 1], open_[-1]) + n
            raw = b"".join(texts)
            data = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist())]
            inner = Seeds(data, n, k)
            keys = inner.keys[inner.at]
            much = np.minimum(holders(keys, text[inner.owner]), MOST_COUNTED).astype("<u2")
            # stretches of one document that hold the same window may part; then none knows that all are with it
            pair = _groups(keys, text[inner.owner])
            once = pair[np.unique(_groups(pair, inner.owner), return_index=True)[1]]
            much[(much > 0) & (np.bincount(once, minlength=1)[pair] > 1)] = MOST_COUNTED
            # the smallest repeated window of the stretch names its shard
            cuts = np.searchsorted(inner.owner, np.arange(len(data) + 1))
            shown = np.where(much > 0, keys, np.uint64(LAST))
            name = np.minimum.reduceat(shown, cuts[:-1])
            common = np.minimum.reduceat(np.where(shown == np.repeat(name, np.diff(cuts)), much, MOST_COUNTED), cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [part.column("uid").take(pa.array(text)), part.column("order").take(pa.array(text)), pa.array(name.astype(np.int64)),
                 pa.array(common.astype(np.int64) // MOST_ALIKE), pa.array(begin - seeds.starts[text]), buckets.blobs(cuts, much), pa.array(data, pa.binary())],
                names=["uid", "order", "alike", "splits", "begin", "held", "data"],
            )

    return run


def _cells(cells: list[dict], name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(c[name] for c in cells), kind)


def _sorted_shards(bits: int, n: int, k: int):
    """Shards out of the rows of a partition: strings repeated inside are settled, those that may be elsewhere go to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("uid", "order", "begin", "held", "data"))):
                held.append(row)
                size += len(row[-1])
                if size >= SHARD_BYTES:
                    yield _shard(held, bits, n, k)
                    held, size = [], 0
        if size:
            yield _shard(held, bits, n, k)

    return run


def _shard(held: list[tuple], bits: int, n: int, k: int) -> pa.RecordBatch:
    held.sort(key=lambda h: (h[0], h[2]))
    # of equal stretches only those of the smallest document are sorted: all of the others goes
    least: dict[bytes, int] = {}
    for h in held:
        least[h[4]] = min(least.get(h[4], LAST), h[1])
    copies = [h for h in held if h[1] > least[h[4]]]
    held = [h for h in held if h[1] == least[h[4]]]
    uids, orders, begins = (np.array([h[i] for h in held], np.int64) for i in range(3))
    data = [h[4] for h in held]
    text = np.frombuffer(b"".join(data), np.uint8)
    sizes = np.array([len(d) for d in data])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(held)), sizes)  # stretch of each byte
    place = np.arange(len(text)) + np.repeat(begins - (ends - sizes), sizes)  # its place in the document
    valid = np.arange(len(text)) + n <= np.repeat(ends, sizes)
    gone, smallest = equal_strings(text, valid, orders[owner], n)
    # a short window that as many documents hold here as anywhere has nothing to do with other shards
    seeds = Seeds(data, n, k)
    keys = seeds.keys[seeds.at]
    cuts = np.searchsorted(seeds.owner, np.arange(len(held) + 1))
    stretch = {d: i for i, d in enumerate(data)}
    twins = [stretch[h[4]] for h in copies]
    all_keys = np.concatenate([keys, *(keys[cuts[i] : cuts[i + 1]] for i in twins)])
    all_uids = np.concatenate([uids[seeds.owner], *(np.full(cuts[i + 1] - cuts[i], h[0]) for i, h in zip(twins, copies))])
    much = np.frombuffer(b"".join(h[3] for h in [*held, *copies]), "<u2").astype(np.int64)
    group = _groups(all_keys)
    at = np.flatnonzero(much)
    one = at[np.unique(_groups(all_keys[at], all_uids[at]), return_index=True)[1]]
    here = np.bincount(group[one], minlength=int(group.max(initial=0)) + 1)
    most = np.zeros(len(here), np.int64)
    np.maximum.at(most, group, much)
    here, most, much = here[group[: len(keys)]], most[group[: len(keys)]], much[: len(keys)]
    elsewhere = seeds.strings((much > 0) & ((here < most) | (most >= MOST_COUNTED)))
    away = np.zeros(len(text), bool)
    away[: len(elsewhere)] = elsewhere
    smallest = smallest[away[smallest]]
    documents, at, document = np.unique(uids, return_index=True, return_inverse=True)
    about = np.stack([documents, orders[at]], axis=1)
    strings = buckets.window_keys(text.astype(np.uint64), n)[smallest]
    rows = list(buckets.sent(about, document[owner[smallest]], strings, bits, place[smallest].astype("<u4")))
    # runs of places that go, for each document, ride along to a bucket
    step = np.flatnonzero((np.diff(gone, prepend=-2) != 1) | (np.diff(owner[gone], prepend=-1) != 0))
    runs = np.stack([uids[owner[gone[step]]], place[gone[step]], np.diff(step, append=len(gone))], axis=1) if len(step) else np.zeros((0, 3), np.int64)
    whole = [(h[0], h[2], len(h[4]) - n + 1) for h in copies]
    runs = np.concatenate([runs, np.array(whole, np.int64).reshape(-1, 3)])
    if len(runs):
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        first = np.flatnonzero(np.diff(runs[:, 0], prepend=-1))
        rows.append({
            "bucket": int(runs[0, 0]) % (1 << bits), "top": None, "keys": None,
            "docs": buckets._packed(np.diff(runs[first, 0], prepend=0)),
            "sizes": buckets._packed(np.diff(first, append=len(runs)).astype("<u4")),
            "extra": buckets._packed(runs[:, 1:].astype("<u4")),
        })
    return pa.RecordBatch.from_pylist(rows, schema=buckets.SENT_ARROW)


def _merged(table: pa.Table) -> pa.Table:
    """In one bucket: strings of one shard that a smaller document of another holds; and the shards' own runs, passed on."""
    docs, keys, extras = buckets.received(table.filter(pa.compute.is_valid(table["keys"])), 2)
    place = buckets.extras_of(extras, "<u4")
    # the sorted keys of all shards, and by binary search the smallest document of each
    by = np.lexsort((docs[:, 1], keys))
    least = docs[by, 1][np.searchsorted(keys[by], keys, side="left")] if len(keys) else docs[:, 1]
    at = np.flatnonzero(docs[:, 1] > least)
    own = docs[at, 0]
    cuts = np.append(np.flatnonzero(np.diff(own, prepend=own[:1] - 1)), len(own)) if len(own) else np.zeros(1, np.int64)
    runs = np.stack([place[at], np.ones(len(at), np.uint32)], axis=1).astype("<u4") if len(at) else np.zeros((0, 2), "<u4")
    out = [pa.table({"uid": pa.array(own[cuts[:-1]], pa.int64()), "runs": buckets.blobs(cuts, np.ascontiguousarray(runs).view("<u8").reshape(-1))})]
    for row in table.filter(pa.compute.is_null(table["keys"])).to_pylist():
        ids, sizes = np.cumsum(buckets._unpacked(row["docs"], "<i8")), buckets._unpacked(row["sizes"], "<u4")
        out.append(pa.table({"uid": pa.array(ids), "runs": buckets.blobs(np.concatenate([[0], np.cumsum(sizes)]), buckets._unpacked(row["extra"], "<u8"))}))
    return pa.concat_tables(out)


def _gone(text: bytes, cells: list[bytes] | None, n: int) -> np.ndarray | None:
    """Which bytes go; None if none does."""
    if not cells:
        return None
    runs = np.frombuffer(b"".join(cells), "<u4").reshape(-1, 2).astype(np.int64)
    change = np.zeros(len(text) + 1, np.int32)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1] - 1 + n, -1)
    return np.cumsum(change[:-1]) > 0


def dedup_digests(docs: DataFrame, n: int = LENGTH, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_bytes, n_removed, n_spans (runs removed) and kept_sha256 (of the bytes left) for each row.

    A byte goes when a string of n bytes that covers it also starts in a document with a smaller id, judged
    on the input. NULL texts count as empty. Rows with equal ids do not remove from one another; rows
    without an id come after all others. An empty table gives no rows.
    """
    k = min(SEED, n)
    chars = buckets.chars_of(docs, text)
    bits, parts = buckets.bucket_bits(chars, CHARS_PER_KEY), buckets.text_parts(docs, chars)
    order = F.coalesce(F.col(id).cast("bigint"), F.lit(LAST))
    # one shuffle of the texts serves all three uses below: Spark reuses equal exchanges of a plan
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id).cast("bigint").alias("doc_id"), order.alias("order"), F.col(text).alias("text"))
    rows = rows.repartition(parts, "uid")
    found = rows.mapInArrow(_send_seeds(bits, n, k), buckets.SENT).groupBy("bucket").applyInArrow(_shared_seeds, "uid bigint, keys binary, held binary")
    found = found.groupBy("uid").agg(F.collect_list(F.struct("keys", "held")).alias("answers"))
    schema = "uid bigint, order bigint, alike bigint, splits bigint, begin bigint, held binary, data binary"
    stretches = rows.join(found, "uid").mapInArrow(_stretches(n, k), schema)
    shard = F.xxhash64("alike", F.pmod(F.xxhash64("uid"), F.col("splits") + 1))
    shards = stretches.withColumn("shard", shard).repartition(parts, "shard").sortWithinPartitions("shard", "uid", "begin")
    sent = shards.select("uid", "order", "begin", "held", "data").mapInArrow(_sorted_shards(bits, n, k), buckets.SENT)
    removed = sent.groupBy("bucket").applyInArrow(_merged, "uid bigint, runs binary")
    removed = removed.groupBy("uid").agg(F.collect_list("runs").alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _blocks(batches):
            out = []
            for t, cells in zip(texts, part.column("runs").to_pylist()):
                gone = _gone(t, cells, n)
                if gone is None:
                    out.append((len(t), 0, 0, hashlib.sha256(t).hexdigest()))
                else:
                    spans = int(np.count_nonzero(np.diff(gone, prepend=False) & gone))
                    out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
            a, b, c, d = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(d)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    result = rows.join(removed, "uid", "left").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return result.withColumnRenamed("doc_id", id)
