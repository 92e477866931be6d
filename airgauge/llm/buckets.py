"""Keys of documents sent to hash buckets in blocks: one row for each block of documents and bucket.

A row per key would cost more than the key. A block's keys for one bucket go into one row instead, in
document order: the documents once (delta-coded), how many keys each has there, and 7 bytes of each key (or
fewer); its other bits, the top 6, are the same for all keys of a bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.llm.common import release

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_KEYS = 1_000_000  # keys of one bucket, about: what one task holds
ROWS_AT_ONCE = 16  # rows of a bucket that are unpacked together
PART_CHARS = 128_000_000  # characters of one partition of texts, about
LEAST_BITS = TOP_BITS = 6
PIECE = 16_384  # numbers that are hashed together
WIDTH = 7  # bytes of a key that are sent
KEY_BITS = TOP_BITS + 8 * WIDTH


def chars_of(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.length(text))).first()[0] or 0


def text_parts(docs: DataFrame, chars: int) -> int:
    """Partitions for texts that are shuffled whole: the session's number, more where they would outgrow a task."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))


def bucket_bits(chars: int, chars_per_key: float) -> int:
    """Bits of the bucket number, so that buckets keep their size whatever the size of the table."""
    return max(LEAST_BITS, int(np.ceil(np.log2(max(1.0, chars / chars_per_key / BUCKET_KEYS)))))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    out = x >> np.uint64(30)
    out ^= x
    out *= np.uint64(0xBF58476D1CE4E5B9)
    more = out >> np.uint64(27)
    out ^= more
    out *= np.uint64(0x94D049BB133111EB)
    np.right_shift(out, np.uint64(31), out=more)
    out ^= more
    return out


def window_keys(x: np.ndarray, n: int) -> np.ndarray:
    """Hash of KEY_BITS bits of each run of n numbers: lengths are doubled, then the bits of n put together."""
    # piece by piece: what a cache holds is gone over many times
    steps = range(0, len(x) - n + 1, PIECE)
    return np.concatenate([np.zeros(0, np.uint64), *(_window_keys(x[at : at + PIECE + n - 1].astype(np.uint64), n) for at in steps)])


def _window_keys(x: np.ndarray, n: int) -> np.ndarray:
    out: np.ndarray | None = None
    done, size, power = 0, 1, x
    while True:
        if n & size:
            part = power[done : done + len(x) - n + 1]
            out = part if out is None else mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += size
        size <<= 1
        if size > n:
            return mixed(out + np.uint64(n)) >> np.uint64(64 - KEY_BITS)
        half = size >> 1
        power = mixed(power[:-half] * np.uint64(0x9E3779B97F4A7C15) + power[half:]) if len(power) > half else power[:0]


SPREAD = 0x9E3779B97F4A7C15  # odd, so that no two keys have one product


def spread(keys: np.ndarray, width: int = WIDTH, top: int = TOP_BITS) -> np.ndarray:
    """A bijection of keys of `top` bits and `width` bytes: picked keys are small ones, and would crowd the first buckets."""
    return keys * np.uint64(SPREAD) & np.uint64((1 << top + 8 * width) - 1)


def _packed(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return np.uint32(len(raw)).tobytes() + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    size = int(np.frombuffer(blob, "<u4", 1)[0])
    return np.frombuffer(pa.Codec("zstd").decompress(blob[4:], size, asbytes=True), kind)


def sent(ids: np.ndarray, owner: np.ndarray, keys: np.ndarray, bits: int, extra: np.ndarray | None = None, width: int = WIDTH) -> Iterator[dict]:
    """Rows for the buckets of one block. `owner` (rising) is the place in `ids` of each key's document.

    `ids` has a number for each document, or a row of numbers. Keys have TOP_BITS bits and `width` bytes.
    """
    bucket = (keys >> np.uint64(TOP_BITS + 8 * width - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        own = owner[part]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        yield {
            "bucket": int(bucket[part[0]]),
            "top": int(keys[part[0]] >> np.uint64(8 * width)),
            "docs": _packed(np.diff(ids[own[first]], axis=0, prepend=np.zeros((1, *ids.shape[1:]), np.int64))),
            "sizes": _packed(np.diff(first, append=len(own)).astype("<u4")),
            "keys": keys[part].view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
            "extra": None if extra is None else _packed(extra[part]),
        }


def received(table: pa.Table, numbers: int = 1, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All keys of a bucket's rows with the document of each, row after row, and the rows' extra blobs."""
    total = sum(pa.compute.sum(pa.compute.binary_length(c)).as_py() or 0 for c in table["keys"].chunks) // width
    docs = np.empty(total if numbers == 1 else (total, numbers), np.int64)
    keys, extras, end = np.zeros(total, np.uint64), [], 0
    wide = keys.view(np.uint8).reshape(-1, 8)
    # a few rows at a time, into arrays of their whole size: a bucket is in memory once as it came and once unpacked
    for batch in table.to_batches(max_chunksize=ROWS_AT_ONCE):
        for row in batch.to_pylist():
            raw = np.frombuffer(row["keys"], np.uint8).reshape(-1, width)
            here, end = slice(end, end + len(raw)), end + len(raw)
            ids = _unpacked(row["docs"], "<i8")
            ids = np.cumsum(ids if numbers == 1 else ids.reshape(-1, numbers), axis=0)
            docs[here] = np.repeat(ids, _unpacked(row["sizes"], "<u4"), axis=0)
            wide[here, :width] = raw
            keys[here] |= np.uint64(row["top"] << 8 * width)
            extras.append(row["extra"])
    release()
    return docs, keys, extras


def extras_of(extras: list[bytes], kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(_unpacked(x, kind) for x in extras)])


def run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts the keys, and for each key how many equal it."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=keys[order[:1]] ^ np.uint64(1))) if len(keys) else order
    counts = np.empty(len(keys), np.int64)
    sizes = np.diff(first, append=len(keys))
    counts[order] = np.repeat(sizes, sizes)
    return order, counts


def blobs(cuts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Values (of fixed width) as binary cells; cell i holds values cuts[i] to cuts[i + 1]."""
    width = values.dtype.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32).tobytes()), data])


SENT = "bucket int, top int, docs binary, sizes binary, keys binary, extra binary"
SENT_ARROW = pa.schema(
    [("bucket", pa.int32()), ("top", pa.int32()), ("docs", pa.binary()), ("sizes", pa.binary()), ("keys", pa.binary()), ("extra", pa.binary())]
)
