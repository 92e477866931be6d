"""Token ids in files: frequency-ranked, in byte-aligned variable-length code with separate control bytes.

An id is replaced by its rank by frequency over the whole corpus, so the common ones take one byte. A rank
takes 1 to 4 bytes, least first; two bits of a control byte give the number, four ranks to a control byte.
A file holds whole documents in ascending id order:

    magic "AGTF" | n_docs u32 | n_tokens u64 | doc ids i64[n_docs] | tokens per doc i64[n_docs]
    | control bytes u8[ceil(n_tokens / 4)] | data bytes

`ranks.u32` beside the files has the id of each rank. Decoding looks lengths up in a table of the 256
control bytes and gathers the data bytes with numpy.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgauge.llm.common import kept_in_worker, stored, texts_of
from airgauge.llm.tokenizing import Tokens
from airgauge.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"AGTF"
NO_ID = -(1 << 63)  # stands for a NULL id in a file
COUNTS = -1  # in place of a number of tokens: a row of counts by id, whose number is in place of the CRC-32
FILE_TOKENS = 2_000_000  # a file is closed at this size; a longer document has a file of its own
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


# --- code -------------------------------------------------------------------------


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (r >= 1 << 8).astype(np.uint8) + (r >= 1 << 16) + (r >= 1 << 24)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[: len(r)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.tobytes(), r.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n ranks of control and data bytes."""
    size = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(ids: list[int], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = MAGIC + np.uint32(len(ids)).tobytes() + np.uint64(len(ranks)).tobytes()
    return b"".join((head, np.array(ids, "<i8").tobytes(), np.array(counts, "<i8").tobytes(), control, data))


def parse(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, tokens per document, and all ranks of a file."""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    docs = int(np.frombuffer(content, "<u4", 1, 4)[0])
    n = int(np.frombuffer(content, "<u8", 1, 8)[0])
    ids, counts = np.frombuffer(content, "<i8", docs, 16), np.frombuffer(content, "<i8", docs, 16 + 8 * docs)
    at = 16 + 16 * docs
    control = np.frombuffer(content, np.uint8, -(-n // 4), at)
    return ids, counts, unpack(control, np.frombuffer(content, np.uint8, offset=at + len(control)), n)


# --- corpus -----------------------------------------------------------------------


def token_table(docs: DataFrame, path: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Compressed ids of each document, in partitions that are ranges of `id`, sorted within.

    The borders come from a scan of the id column alone, so no text is tokenized to find them. Before its
    documents a partition has COUNTS rows: how often each id stands in the texts of a batch, counted while they
    are at hand; a batch's row goes where its first document goes.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    known = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.col(text).alias("text"))
    borders = known.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    borders = np.unique(np.array(borders, dtype=np.float64))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept_in_worker(f"tokens {path}", lambda: Tokens(path))
        end = np.uint32(end_id).tobytes()
        codec = pa.Codec("zstd", 1)
        names = ["doc_id", "part", "n_tokens", "ids_crc32", "ids"]
        for batch in batches:
            total, place = np.zeros(0, np.int64), 0
            for first, texts in texts_of(batch, "text"):
                ids = batch.column("doc_id").slice(first, len(texts))
                blobs = [tokens.ids(t) + end for t in texts]
                keys = np.array(ids, dtype=np.float64)
                part = np.searchsorted(borders, keys, side="right")
                own = np.bincount(np.frombuffer(b"".join(blobs), "<u4"), minlength=len(total))
                own[: len(total)] += total
                total = own
                place = part[0] if first == 0 else place
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(part, pa.int32()), pa.array([len(b) // 4 for b in blobs], pa.int64()),
                     pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                     pa.array([_narrow(b, codec) for b in blobs], pa.binary())],
                    names=names,
                )
            if len(total):
                row = [[NO_ID], pa.array([place], pa.int32()), [COUNTS], [len(total)], [codec.compress(total.astype("<i8").tobytes(), asbytes=True)]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=names)

    schema = "doc_id bigint, part int, n_tokens bigint, ids_crc32 bigint, ids binary"
    rows = known.mapInArrow(encode, schema)
    ranged = rows.repartitionById(len(borders) + 1, F.col("part"))
    return stored(ranged.sortWithinPartitions("doc_id", "n_tokens", "ids_crc32").drop("part"), "token-table")


def _narrow(blob: bytes, codec: pa.Codec) -> bytes:
    """The width of the ids in bytes, then the ids, compressed: in 16 bits if all fit, else in 32."""
    ids = np.frombuffer(blob, "<u4")
    if ids.max(initial=0) < 1 << 16:
        return b"\x02" + codec.compress(ids.astype("<u2").tobytes(), asbytes=True)
    return b"\x04" + codec.compress(blob, asbytes=True)


def _wide(blob: bytes, n: int) -> np.ndarray:
    width = blob[0]
    return np.frombuffer(pa.Codec("zstd").decompress(blob[1:], width * n, asbytes=True), f"<u{width}")


def frequency_ranks(tokens: DataFrame) -> np.ndarray:
    """Ids by falling count over the whole table, then by id. At most one row per vocabulary entry reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob, n in zip(batch.column("ids").to_pylist(), batch.column("ids_crc32").to_pylist()):
                own = np.frombuffer(pa.Codec("zstd").decompress(blob, 8 * n, asbytes=True), "<i8").copy()
                own, total = (own, total) if len(own) >= len(total) else (total, own)
                own[: len(total)] += total
                total = own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    counted = tokens.where(F.col("n_tokens") == COUNTS).select("ids", "ids_crc32")
    rows = counted.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], dtype=np.uint32)


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def _put(fs: pa.fs.FileSystem, path: str, content: bytes) -> None:
    """Whole or not at all: a retried or doubled task writes the same bytes and renames them into place."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with fs.open_output_stream(draft) as out:
        out.write(content)
    fs.move(draft, path)


def write_files(docs: DataFrame, folder: str, path: str, end_id: int, id: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the token files of `docs` into `folder` (a URI all executors reach) and returns their manifest.

    Documents stand in ascending id order over all files, rows without an id first; rows that share an id
    follow one another, each a document. A NULL or empty text has the end id alone. An empty table gives no file.
    Manifest: file, first_id, last_id, n_docs, n_tokens, start (tokens in all files before it).
    """
    spark = docs.sparkSession
    tokens = token_table(docs, path, end_id, id, text)
    by_rank = frequency_ranks(tokens)
    fs, place = _filesystem(folder)
    fs.create_dir(place, recursive=True)
    _put(fs, f"{place}/ranks.u32", by_rank.astype("<u4").tobytes())
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # one entry per vocabulary id

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = _filesystem(folder)
        ranks = shared.value
        ids: list[int] = []
        counts: list[int] = []
        parts: list[np.ndarray] = []
        crcs: list[int] = []
        held = 0

        def closed() -> pa.RecordBatch:
            nonlocal held
            # the name follows from what is in the file, so a second attempt replaces the first
            name = f"{ids[0] & (1 << 64) - 1:016x}-{zlib.crc32(np.array([ids, counts, crcs], '<i8').tobytes()):08x}.ids"
            _put(fs, f"{place}/{name}", file_bytes(ids, counts, ranks[np.concatenate(parts)]))
            row = {"file": [name], "first_id": [ids[0]], "last_id": [ids[-1]], "n_docs": [len(ids)], "n_tokens": [held]}
            held = 0
            for x in (ids, counts, parts, crcs):
                x.clear()
            return pa.RecordBatch.from_pydict(row)

        last = ("", -1)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids_crc32", "ids", "file_name", "row_index"))
            for doc, n, crc, blob, part, row in zip(*columns):
                # a task may read several stretches of the table; a file holds rows of one alone
                if ids and ((part, row - 1) != last or held + n > file_tokens):
                    yield closed()
                last = (part, row)
                ids.append(doc)
                counts.append(n)
                held += n
                crcs.append(crc)
                parts.append(_wide(blob, n))
        if ids:
            yield closed()

    schema = "file string, first_id bigint, last_id bigint, n_docs bigint, n_tokens bigint"
    placed = tokens.where(F.col("n_tokens") != COUNTS).select("*", "_metadata.file_name", "_metadata.row_index")
    manifest = stored(placed.mapInArrow(write, schema), "token-manifest")
    before = Window.orderBy("first_id", "last_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))


def read_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian 32-bit)."""
    fs, place = _filesystem(folder)
    with fs.open_input_stream(f"{place}/ranks.u32") as f:
        shared = spark.sparkContext.broadcast(np.frombuffer(f.read(), "<u4"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = shared.value
        for batch in batches:
            for content, start in zip(batch.column("content"), batch.column("start").to_pylist()):
                ids, counts, ranks = parse(content.as_buffer().to_pybytes())
                tokens = by_rank[ranks].astype("<u4")
                ends = np.cumsum(counts)
                crc = [zlib.crc32(tokens[e - c : e].data) for c, e in zip(counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # the manifest has a row per file, far fewer than fit in a broadcast; Spark decides by its size
    joined = files.join(manifest.select("file", "start"), "file").select("content", "start")
    rows = joined.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    folder = shared_dir(docs.sparkSession, "token-files")
    manifest = stored(write_files(docs, folder, path, end_id), "token-starts")
    return read_files(docs.sparkSession, folder, manifest)
