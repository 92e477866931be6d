"""The prefix trie of conversations, by balanced parentheses in shards of the sorted spines.

A spine is a conversation's turns as digests, in order. Equal spines meet in an aggregate; the distinct ones
are range-partitioned, so that a shard is a piece of the trie in depth-first order. There the trie is a
sequence of parentheses. Blocks of range minima of its excess give each node's closing parenthesis, which
delimits its subtree; sums over a subtree are differences of cumulative arrays, its leaves a rank over "()".

A shard cannot know whether its first and last spine go on in the neighbouring shards. Their nodes stay open:
they travel on as spines with what hangs on them already, and the next, smaller round of the same step merges
what they share. The last round has one shard and closes the root.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 16  # bytes of a turn's digest
SHARD = 16_384  # nodes of a shard, about
LAST = 32_768  # nodes that one shard, the last, may have
PER_PARTITION = 2_000_000  # nodes of a partition, which holds many shards
BLOCK = 64  # parentheses that share a range minimum
NO_ID = np.iinfo(np.int64).max
RUN = 16_384  # ids of one text in the hash of ids
HANGS = ("convs", "leaves", "saved", "kids", "ends")  # what is summed up on a node


# --- rebuilt conversations ------------------------------------------------------------------------


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text; NULL counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def spines(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as structs of digest and bytes of text.

    Turns ascend (NULL first); those of one number follow their digest's order. Rows without conv_id belong
    to no conversation and are left out. One conversation is the unit: 24 bytes a turn.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("size")
    rows = turns.where("conv_id is not null").select("conv_id", F.struct("turn", turn_digest(F.col("role"), F.col("text")).alias("digest"), size).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select("conv_id", F.expr("transform(t, x -> struct(x.digest, x.size))").alias("t"))


def with_donor_heads(own: DataFrame, longest: int = 8, every: int = 5) -> DataFrame:
    """Each conversation with its first h turns taken from conversation c - c % every; h = crc32(c) % (longest + 1)."""
    c = F.col("conv_id")
    h = F.expr(f"crc32(cast(cast(conv_id as string) as binary)) % {longest + 1}").cast("int")
    heads = own.select(c.alias("donor"), F.slice("t", 1, longest).alias("head"))
    joined = own.withColumn("donor", c - c % every).join(heads, "donor", "left").withColumn("h", h)
    return joined.select("conv_id", F.expr("concat(coalesce(slice(head, 1, h), array()), slice(t, h + 1, greatest(size(t) - h, 0)))").alias("t"))


# --- one shard -------------------------------------------------------------------------------------


def find_close(excess: np.ndarray, opens: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Place of the parenthesis that closes each of `opens`, over a min-tree of blocks of the excess.

    The closing one is the first place after an opening one whose excess is one less.
    """
    n = len(excess)
    n_blocks = 1 << max(0, int(np.ceil(np.log2(max(1, -(-n // block))))))
    padded = np.full(n_blocks * block, -2, excess.dtype)  # beyond the end everything is closed
    padded[:n] = excess
    tree = [padded.reshape(-1, block).min(axis=1)]
    while len(tree[-1]) > 1:
        tree.append(tree[-1].reshape(-1, 2).min(axis=1))
    want = excess[opens] - 1
    out = np.full(len(opens), -1, np.int64)

    def scan(which: np.ndarray, blocks: np.ndarray, first: np.ndarray) -> None:
        """First place from `first` on in each block that is low enough, if any."""
        for part in range(0, len(which), 65_536):
            w, b = which[part : part + 65_536], blocks[part : part + 65_536]
            places = b[:, None] * block + np.arange(block)
            hit = (padded[places] <= want[w][:, None]) & (places >= first[part : part + 65_536, None])
            found = hit.any(axis=1)
            out[w[found]] = places[found, hit[found].argmax(axis=1)]

    scan(np.arange(len(opens)), opens // block, opens + 1)
    left = np.flatnonzero(out < 0)
    node, level = opens[left] // block, np.zeros(len(left), np.int64)
    up = np.ones(len(left), bool)
    while up.any():  # up, until the right neighbour's minimum is low enough
        i = np.flatnonzero(up)
        for lv in np.unique(level[i]):
            j = i[level[i] == lv]
            right = node[j] + 1
            fits = (node[j] % 2 == 0) & (tree[lv][np.minimum(right, len(tree[lv]) - 1)] <= want[left[j]])
            node[j] = np.where(fits, right, node[j] >> 1)
            level[j] += ~fits
            up[j] = ~fits
    while len(down := np.flatnonzero(level > 0)):  # and down to its first block that is
        for lv in np.unique(level[down]):
            j = down[level[down] == lv]
            first = node[j] * 2
            node[j] = np.where(tree[lv - 1][first] <= want[left[j]], first, first + 1)
            level[j] -= 1
    scan(left, node, node * block)
    return out


def least_in(values: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Smallest value of each range [first, stop), by tables of ranges of 1, 2, 4... values, one at a time."""
    out = np.empty(len(first), values.dtype)
    power = np.frexp((stop - first).astype(float))[1] - 1
    table = values
    for k in range(int(power.max(initial=0)) + 1):
        i = power == k
        out[i] = np.minimum(table[first[i]], table[stop[i] - (1 << k)])
        half = 1 << k
        table = np.minimum(table[:-half], table[half:]) if len(table) > half else table[:0]
    return out


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def shared_turns(digests: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Of each spine, how many first turns it shares with the spine before it."""
    out = np.zeros(len(depth), np.int64)
    starts = np.cumsum(depth) - depth
    both = np.minimum(depth[1:], depth[:-1])
    at, of = _ranges(both), np.repeat(np.arange(len(both)), both)
    differ = (digests[starts[1:][of] + at] != digests[starts[:-1][of] + at]).any(axis=1)
    out[1:] = both
    where = np.flatnonzero(differ)[::-1]
    out[1 + of[where]] = at[where]  # the first difference is written last
    return out


class Shard:
    """The trie of sorted distinct spines, with weights on its nodes.

    spines: per spine `WIDTH` bytes a turn. Per spine and depth (0 to its own): bytes of the last text, and
    what hangs there: least id, convs, leaves, saved, kids, and whether conversations end there.
    """

    def __init__(self, spines: Sequence[bytes], sizes: np.ndarray, least: np.ndarray, convs: np.ndarray, leaves: np.ndarray, saved: np.ndarray, kids: np.ndarray, ends: np.ndarray):
        self.spines = spines
        self.depth = depth = np.array([len(s) // WIDTH for s in spines], np.int64)
        digests = np.frombuffer(b"".join(spines), "<u8").reshape(-1, 2)
        self.shared = shared = shared_turns(digests, depth)
        new = depth - shared
        new[0] += 1  # the root
        self.first_new = np.cumsum(new) - new
        n = int(new.sum())

        # parentheses: before its new turns a spine closes those of the last one that it does not share
        closes = np.concatenate([[0], depth[:-1] - shared[1:]])
        runs = np.column_stack([closes, new]).ravel()
        signs = np.repeat(np.tile(np.array([-1, 1], np.int8), len(depth)), runs)
        self.parens = np.concatenate([signs, np.full(int(depth[-1]) + 1, -1, np.int8)])
        excess = np.cumsum(self.parens, dtype=np.int64)
        opens = np.flatnonzero(self.parens > 0)
        close = find_close(excess, opens)
        self.stop = np.arange(n) + (close - opens + 1) // 2  # preorder numbers of a subtree: own number to here

        at = _ranges(new) + np.repeat(shared + 1, new)
        at[: new[0]] -= 1
        self.node_depth = at
        self.by_depth = np.sort(at * n + np.arange(n))
        self.parent = self.on_path(at - 1, np.arange(n))
        self.parent[0] = -1
        self.n = n

        # weights of all spines and depths onto the nodes
        rows = depth + 1
        which, level = np.repeat(np.arange(len(depth)), rows), _ranges(rows)
        last = np.concatenate([self.first_new[1:], [n]])[which] - 1
        node = self.on_path(level, last + 1)
        self.row_node, self.row_starts = node, np.cumsum(rows) - rows
        self.bytes = np.zeros(n, np.int64)
        self.bytes[node] = sizes
        self.hang = {k: np.zeros(n, np.int64) for k in HANGS}
        for k, v in zip(HANGS, (convs, leaves, saved, kids, ends)):
            np.add.at(self.hang[k], node, v)
        self.least = np.full(n, NO_ID)
        np.minimum.at(self.least, node, least)
        self.children = np.bincount(self.parent[1:], minlength=n) + self.hang["kids"]

        pair = np.zeros(len(self.parens), np.int64)
        pair[opens[(close == opens + 1) & (self.hang["kids"] == 0)]] = 1
        rank = np.concatenate([[0], np.cumsum(pair)])
        self.n_leaves = rank[close] - rank[opens] + self._sums(self.hang["leaves"])
        self.n_convs = self._sums(self.hang["convs"])
        self.min_id = least_in(self.least, np.arange(n), self.stop)

    def on_path(self, depth: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Number of the last node of a depth that comes before a number in preorder."""
        n = len(self.node_depth)
        return self.by_depth[np.searchsorted(self.by_depth, depth * n + before) - 1] % n

    def _sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stop] - total[: len(values)]

    def path(self, i: int) -> np.ndarray:
        """Nodes of spine i from the root down."""
        start = self.row_starts[i]
        return self.row_node[start : start + self.depth[i] + 1]

    def results(self, last: bool, named: bool) -> tuple[pa.RecordBatch, list[tuple[bytes, bytes]]]:
        """Rows of the closed nodes, and the spines that stay open (none in the last round) with their numbers.

        named: whether rows closed earlier may name these nodes as their parents.
        """
        is_open = np.zeros(self.n, bool)
        ends = [] if last else sorted({0, len(self.depth) - 1})
        for i in ends:
            is_open[self.path(i)] = True
        closed = np.flatnonzero(~is_open)
        own = np.where(is_open, 0, (self.n_convs - 1) * self.bytes)
        saved = self._sums(own + self.hang["saved"])
        above = self.parent[closed]
        known = (above >= 0) & ~is_open[above]
        open_keys = {int(node): key_of(self.spines[i], d) for i in ends for d, node in enumerate(self.path(i))}
        new_of = np.searchsorted(self.first_new, closed, side="right") - 1
        at = self.node_depth[closed]
        keys = [key_of(self.spines[i], d) for i, d in zip(new_of, at)] if named else [None] * len(closed)
        rows = [
            pa.array(self.min_id[closed]),
            pa.array(at),
            pa.array(self.min_id[above], mask=~known),
            pa.array([open_keys.get(int(a)) for a in above], pa.binary()),
            pa.array(keys, pa.binary()),
            *[pa.array(x[closed]) for x in (self.n_convs, self.children, self.n_leaves, saved)],
            pa.array([key_of(self.spines[i], d) if e else None for i, d, e in zip(new_of, at, self.hang["ends"][closed])], pa.binary()),
            *[pa.nulls(len(closed), pa.binary())] * 2,
        ]
        # closed children are handed to their open parents
        add, least = {k: v.copy() for k, v in self.hang.items()}, self.least.copy()
        hung = closed[(above >= 0) & is_open[above]]
        over = self.parent[hung]
        for k, v in (("convs", self.n_convs), ("leaves", self.n_leaves), ("saved", saved), ("kids", np.ones(self.n, np.int64))):
            np.add.at(add[k], over, v[hung])
        np.minimum.at(least, over, self.min_id[hung])
        out, told = [], np.zeros(self.n, bool)
        for i in ends:
            path = self.path(i)
            fresh = ~told[path]  # what two open spines share is told by the first of them
            told[path] = True
            weights = [np.where(fresh, add[k][path], 0) for k in HANGS]
            numbers = np.column_stack([self.bytes[path], np.where(fresh, least[path], NO_ID), *weights])
            out.append((self.spines[i], numbers.astype("<i8").tobytes()))
        return pa.RecordBatch.from_arrays(rows, schema=ROW_SCHEMA), out


def key_of(spine: bytes, depth: int) -> bytes:
    """Short name of the node that the first `depth` turns of a spine lead to."""
    return hashlib.md5(spine[: depth * WIDTH]).digest()


# Closed nodes (parent_key: of a parent that is still open; key: a name that earlier rows may use) and, in the same
# rows' last two columns, open spines with their numbers: per depth bytes, least id and HANGS.
ROWS = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, parent_key binary, key binary, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, end_key binary, spine binary, numbers binary"
)
ROW_SCHEMA = pa.schema([(c, pa.int64() if kind == "bigint" else pa.binary()) for c, kind in (x.split() for x in ROWS.split(", "))])


# --- rounds ------------------------------------------------------------------------------------------


def _open_rows(spines: Sequence[tuple[bytes, bytes]]) -> pa.RecordBatch:
    none = [pa.nulls(len(spines), f.type) for f in ROW_SCHEMA][:-2]
    return pa.RecordBatch.from_arrays([*none, pa.array([s for s, _ in spines], pa.binary()), pa.array([x for _, x in spines], pa.binary())], schema=ROW_SCHEMA)


def _first_numbers(batch: pa.RecordBatch) -> list[bytes]:
    """Numbers of distinct conversations: bytes of each turn's text, and their count and least id at the end."""
    out = []
    for sizes, n, least in zip(batch.column("sizes").to_pylist(), batch.column("n").to_pylist(), batch.column("least").to_pylist()):
        x = np.zeros((len(sizes) + 1, 2 + len(HANGS)), "<i8")
        x[1:, 0], x[:, 1] = sizes, NO_ID
        x[-1, 1:3], x[-1, -1] = (least, n), 1
        out.append(x.tobytes())
    return out


def _shards(first: bool, last: bool, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spines: list[bytes] = []
        numbers: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            x = np.frombuffer(b"".join(numbers), "<i8").reshape(-1, 2 + len(HANGS))
            rows, opened = Shard(spines, *x.T).results(last, named=not first)
            yield rows
            if opened:
                yield _open_rows(opened)

        for batch in batches:
            given = _first_numbers(batch) if first else batch.column("numbers").to_pylist()
            for spine, x in zip(batch.column("spine").to_pylist(), given):
                spines.append(spine)
                numbers.append(x)
                held += len(spine) // WIDTH + 1
                if held >= most and not last:
                    yield from flush()
                    spines, numbers, held = [], [], 0
        if spines:
            yield from flush()

    return run


def _rounds(items: DataFrame, shard: int, most: int) -> list[DataFrame]:
    """Closed nodes of each round: fewer and fewer open spines, until one shard takes them all."""
    spark, out = items.sparkSession, []
    parts = None
    while True:
        nodes, n = items.agg(F.sum(F.octet_length("spine") / WIDTH + 1).cast("bigint"), F.count(F.lit(1))).first()
        if not n:
            return out
        wanted = max(-(-nodes // PER_PARTITION), min(-(-nodes // shard), int(spark.conf.get("spark.sql.shuffle.partitions"))))
        parts = wanted if parts is None else min(wanted, parts // 2)
        last = nodes <= most or parts <= 1
        placed = items.repartition(1) if last else items.repartitionByRange(parts, "spine")
        done = stored(placed.sortWithinPartitions("spine").mapInArrow(_shards(not out, last, shard), ROWS), f"trie-{len(out)}")
        out.append(done.where("spine is null"))
        if last:
            return out
        items = done.where("spine is not null").select("spine", "numbers")


def _packed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key's ids as one text each."""
    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_numpy()
        if not keys:
            continue
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        runs = [(a, b) for start, stop in zip(cuts, cuts[1:]) for a in range(start, stop, RUN) for b in (min(stop, a + RUN),)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[a] for a, _ in runs], pa.binary()), pa.array([ids[a] for a, _ in runs], pa.int64()), pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in runs])],
            names=["key", "first", "ids"],
        )


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each key, over its texts in order; a key may go on in the next batch."""
    key, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["end_key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["end_key", "ends_sha256"])


def id_hashes(rows: DataFrame) -> DataFrame:
    """end_key and the SHA-256 of its ids, ascending and comma-joined.

    Ids are range-partitioned first, so a key with very many is packed by many tasks into few texts; the hash,
    which is sequential by nature, then runs over these as a stream and holds one batch.
    """
    packed = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_packed_ids, "key binary, first bigint, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed_ids, "end_key binary, ends_sha256 string")


COPIES = 64  # of a closed-later parent's row, so that a parent with very many children is no hot key


def trie(convs: DataFrame, shard: int = SHARD, most: int = LAST) -> DataFrame:
    """One row for each node of the prefix trie of `convs` (conv_id, t: array of struct of digest and size).

    conv_id (the smallest member), depth, parent_conv_id (NULL for the root), n_convs, n_children, n_leaves,
    saved_tokens, and ends_sha256 over the ids of the conversations that end there. Conversations without turns
    end at the root; without any conversation there is no root. Ids are whole numbers, each once.
    """
    flat = stored(convs.select("conv_id", F.expr("unhex(array_join(transform(t, x -> hex(x.digest)), ''))").alias("spine"), F.expr("transform(t, x -> x.size)").alias("sizes")), "trie-spines")
    items = stored(flat.groupBy("spine").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("sizes").alias("sizes")), "trie-items")
    rounds = _rounds(items, shard, most)
    if not rounds:
        return _empty(flat)
    rows = rounds[0]
    for more in rounds[1:]:
        rows = rows.unionByName(more)
    late = rows.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_p"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("_copy"))
    under = rows.where("parent_key is not null").withColumn("_copy", F.pmod("conv_id", F.lit(COPIES)).cast("int"))
    under = under.join(late, ["parent_key", "_copy"]).withColumn("parent_conv_id", F.col("_p"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    found = rows.where("parent_key is null").select(*columns, "end_key").unionByName(under.select(*columns, "end_key"))
    ended = found.where("end_key is not null").join(id_hashes(flat.select(F.unhex(F.md5("spine")).alias("key"), "conv_id")), "end_key").drop("end_key")
    passed = found.where("end_key is null").drop("end_key").withColumn("ends_sha256", F.sha2(F.lit(""), 256))
    return ended.unionByName(passed)


def _empty(convs: DataFrame) -> DataFrame:
    kinds = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    return convs.sparkSession.createDataFrame([], kinds)


def rebuilt_trie(turns: DataFrame, shard: int = SHARD, most: int = LAST) -> DataFrame:
    """The trie of the conversations after each has taken its first turns from its donor."""
    return trie(with_donor_heads(spines(turns.select("conv_id", "turn", "role", "text"))), shard, most)
