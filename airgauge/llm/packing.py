"""Best-fit packing by hierarchical residual packing.

Every partition packs its pieces best-fit, longest first, and emits the bins that are nearly full. The
underfull bins become items of the next round, in fewer partitions (a tree of fan-in FAN_IN), and are
packed again, until one partition is left or a round no longer helps. A task holds a bounded number of
items at a time, whatever the partition holds.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import kept_in_worker, stored, texts_of
from airgauge.llm.tokenizing import Tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
FAN_IN = 8
MOST_ITEMS = 100_000  # items a task packs at a time
NEARLY_FULL = 4  # a bin with at most so much room is emitted
LEAST_GAIN = 0.005  # a round that saves a smaller share of its bins is the last
MOST_ROUNDS = 10

MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of each text with the end id, cut at `capacity`: doc_id, piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept_in_worker(f"tokens {path}", lambda: Tokens(path))
        end = np.uint32(end_id).tobytes()
        step = 4 * capacity
        for batch in batches:
            for first, texts in texts_of(batch, text):
                row, piece, size, crc = [], [], [], []
                for i, t in enumerate(texts, first):
                    ids = tokens.ids(t) + end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        row.append(i)
                        piece.append(k)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                number = np.array(piece, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(number * capacity),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.col(id).cast("bigint").alias(id), text)
    return rows.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items by falling size, each into the fullest bin that has room.

    Bins stand in stacks by their room; a bit for each stack that is not empty finds the best one.
    """
    bins: list[list[int]] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = stacks[room].pop()
            if not stacks[room]:
                open_rooms ^= 1 << room
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        room -= size
        if room:
            if not stacks[room]:
                open_rooms |= 1 << room
            stacks[room].append(at)
    return bins


def _packed(items: DataFrame, level: int, capacity: int) -> DataFrame:
    """One round over the partitions of `items` (used, members): bins with their id and whether they leave the tree."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (level << 56) | (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []

        def emit() -> pa.RecordBatch:
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            used = table["used"].to_numpy()
            members = table["members"].combine_chunks() if table["members"].num_chunks != 1 else table["members"].chunk(0)
            starts = members.offsets.to_numpy()
            bins = best_fit(used, capacity)
            flat = np.fromiter((i for b in bins for i in b), np.int64)
            per_bin = np.array([len(b) for b in bins])
            # members of the bins' items, item after item
            n = np.diff(starts)[flat]
            ends = np.cumsum(n)
            take = np.repeat(starts[:-1][flat] - (ends - n), n) + np.arange(ends[-1])
            values = members.values.take(pa.array(take))
            bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_bin)])]
            total = np.add.reduceat(used[flat], np.concatenate([[0], np.cumsum(per_bin)[:-1]]))
            ids = made + np.arange(len(bins))
            made += len(bins)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(total.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
                 pa.array(total >= capacity - NEARLY_FULL)],
                names=["sequence_id", "used", "members", "done"],
            )

        count = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
                if count >= MOST_ITEMS:
                    yield emit()
                    count = 0
        if held:
            yield emit()

    return items.select("used", "members").mapInArrow(pack, f"sequence_id bigint, used bigint, members array<{MEMBER}>, done boolean")


def packed(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32), none over `capacity`, each with sequence_id and offset.

    Members of a sequence stand without gaps from offset 0. An empty table gives no sequences; repeated rows
    are packed each; a NULL doc_id stays NULL.
    """
    spark = items.sparkSession
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    level, parts = 0, None
    work = items.select(F.col("length").alias("used"), F.array(member).alias("members"))
    done: DataFrame | None = None
    before = None
    while True:
        bins = stored(_packed(work, level, capacity), f"bins-{level}")
        full = bins.where("done")
        left = bins.where("not done")
        count = left.count()
        parts = parts or min(bins.rdd.getNumPartitions() * FAN_IN, int(spark.conf.get("spark.sql.shuffle.partitions")))
        last = count == 0 or parts == 1 or level == MOST_ROUNDS or (before is not None and count > before * (1 - LEAST_GAIN))
        done = (bins if last else full) if done is None else done.unionByName(bins if last else full)
        if last:
            break
        # enough partitions that none exceeds what a task packs at a time
        parts = max(1, parts // FAN_IN, -(-count // MOST_ITEMS))
        level, before = level + 1, count
        work = left.repartition(parts, F.xxhash64("sequence_id", F.lit(level))).sortWithinPartitions("sequence_id")
    return done.select("sequence_id", "members").mapInArrow(_offsets, f"{MEMBER[len('struct<') : -1]}, sequence_id bigint, offset bigint")


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each member of a sequence, with its place: the lengths before it, summed once along the sequence."""
    for batch in batches:
        members = batch.column("members")
        sizes = np.diff(members.offsets.to_numpy())
        flat = members.flatten()
        length = flat.field("length").to_numpy()
        before = np.cumsum(length) - length
        first = np.cumsum(sizes) - sizes
        start = np.repeat(before[first[sizes > 0]], sizes[sizes > 0])
        sequence = np.repeat(batch.column("sequence_id").to_numpy(), sizes)
        columns = [flat.field(i) for i in range(flat.type.num_fields)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(sequence), pa.array(before - start)], names=[*[f.name for f in flat.type], "sequence_id", "offset"]
        )


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    return packed(stored(pieces(docs, path, end_id, capacity), "pieces"), capacity)
