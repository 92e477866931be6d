"""SentencePiece encoding with the original byte span of every piece, and decoding.

The compiled character map of a model is a double-array trie over byte strings with their replacements.
A text is normalised by its longest prefixes in that trie; every byte of the result remembers where in
the text it comes from. The library gives the pieces of a text; their lengths in normalised bytes are
known from the model, so the remembered places turn them into spans of the original bytes.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_format

from airgauge.llm.common import kept_in_worker, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁".encode()
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6


def character_map(compiled: bytes) -> dict[bytes, bytes]:
    """All keys of a compiled map with their replacements, by a walk through its trie."""
    if not compiled:
        return {}
    size = int(np.frombuffer(compiled, "<u4", 1)[0])
    units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
    strings = compiled[4 + size :]
    found: dict[bytes, bytes] = {}

    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    todo = [(offset(units[0]), b"")]
    while todo:
        base, key = todo.pop()
        for c in range(1, 256):
            at = base ^ c
            if at < len(units) and units[at] & (1 << 31 | 0xFF) == c:
                unit, child = units[at], key + bytes([c])
                below = at ^ offset(unit)
                if unit >> 8 & 1:  # the key ends here; its value is where its replacement starts
                    start = units[below] & (1 << 31) - 1
                    found[child] = strings[start : strings.index(b"\0", start)]
                todo.append((below, child))
    return found


class Normalizer:
    """Normalised bytes of a text, and for each of them (and the end) its place in the text's bytes."""

    def __init__(self, spec: model_format.NormalizerSpec, kept: list[str], suffix: bool = False):
        pairs = {k.decode(errors="ignore"): v for k, v in character_map(spec.precompiled_charsmap).items()}
        pairs |= {k: k.encode() for k in kept}  # user-defined symbols stand as they are
        pairs.pop("", None)
        self.pairs = pairs
        self.longest = max(map(len, pairs), default=0)
        firsts = sorted({k[0] for k in pairs})
        self.find = re.compile("[" + "".join(map(re.escape, firsts)) + "]").search if firsts else None
        self.prefix, self.collapse, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = suffix

    def mapped(self, text: str) -> tuple[bytes, np.ndarray]:
        """Longest prefixes replaced, everything else kept."""
        raw = text.encode()
        if self.find is None or not self.find(text):
            return raw, np.arange(len(raw) + 1)
        out: list[bytes] = []
        where: list[np.ndarray] = []
        at = source = 0
        while at < len(text):
            hit = self.find(text, at)
            stop = hit.start() if hit else len(text)
            if stop > at:
                same = text[at:stop].encode()
                out.append(same)
                where.append(np.arange(source, source + len(same)))
                source += len(same)
                at = stop
                continue
            for n in range(min(self.longest, len(text) - at), 0, -1):
                if (new := self.pairs.get(text[at : at + n])) is not None:
                    break
            else:
                n, new = 1, text[at].encode()
            out.append(new)
            where.append(np.full(len(new), source))
            source += len(text[at : at + n].encode())
            at += n
        return b"".join(out), np.concatenate([*where, [source]])

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        raw, where = self.mapped(text)
        data = np.frombuffer(raw, np.uint8)
        blank = data == 0x20
        if self.collapse:
            # of a run of spaces the first stays; none at either end
            keep = ~(blank & np.concatenate([[True], blank[:-1]]))
            if len(keep) and blank[-1]:
                last = np.flatnonzero(keep)
                if len(last) and blank[last[-1]]:
                    keep[last[-1]] = False
            end = where[np.flatnonzero(keep)[-1] + 1] if keep.any() else where[-1]
            data, blank, where = data[keep], blank[keep], np.append(where[:-1][keep], end)
        if not len(data):
            return b"", where[-1:]
        if self.escape and blank.any():
            n = np.where(blank, 3, 1)
            first = np.repeat(np.cumsum(n) - n, n)
            inside = np.arange(len(first)) - first
            data = np.where(np.repeat(blank, n), np.frombuffer(SPACE, np.uint8)[np.minimum(inside, 2)], np.repeat(data, n)).astype(np.uint8)
            where = np.append(np.repeat(where[:-1], n), where[-1])
        if self.prefix:
            mark = SPACE if self.escape else b" "
            if self.suffix:
                return data.tobytes() + mark, np.append(where, np.full(len(mark), where[-1]))
            return mark + data.tobytes(), np.concatenate([np.full(len(mark), where[0]), where])
        return data.tobytes(), where


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            content = f.read()
        model = model_format.ModelProto.FromString(content)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        kept = [p.piece for p in model.pieces if p.type == USER_DEFINED]
        self.normalize = Normalizer(model.normalizer_spec, kept, model.trainer_spec.treat_whitespace_as_suffix)
        self.sizes = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), -1)
        self.decimals = [str(i) for i in range(len(model.pieces))]

    def encode(self, text: str) -> tuple[list[int], np.ndarray | None, np.ndarray | None]:
        """Ids of the text, and where each piece begins and ends in its UTF-8 bytes.

        Should the pieces of a text not tile its normal form, it has its ids but no spans (None).
        """
        ids = self.library.encode(text)
        if not ids:
            return ids, np.zeros(0, np.int64), np.zeros(0, np.int64)
        numbers = np.array(ids)
        sizes = self.sizes[numbers]
        if (numbers == self.unknown).any():  # an unknown piece is as long as the text it stands for
            surfaces = self.library.encode(text, out_type=str)
            sizes = np.where(numbers == self.unknown, [len(s.encode()) for s in surfaces], sizes)
        normal, where = self.normalize(text)
        ends = np.cumsum(sizes)
        if ends[-1] != len(normal):
            return ids, None, None
        return ids, where[ends - sizes], where[ends]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _pieces(path: str) -> Pieces:
    return kept_in_worker(f"pieces {path}", lambda: Pieces(path))


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, ids, begins and ends (byte span of each piece in the original text) for each row.

    NULL and empty texts have no pieces; a text whose pieces do not tile it has NULL spans. Every row of `docs` gives one row; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            for first, texts in texts_of(batch, text):
                ids, begins, ends = zip(*map(pieces.encode, texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id).slice(first, len(texts)), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                    names=[id, "ids", "begins", "ends"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, ids array<int>, begins array<bigint>, ends array<bigint>")


def decode(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`id` and the text of each row's ids; NULL ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            texts = [pieces.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(texts, pa.string())], names=[id, "text"])

    kind = encoded.schema[id].dataType.simpleString()
    return encoded.select(id, ids).mapInArrow(run, f"`{id}` {kind}, text string")


def digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What `encode` and then `decode` give for each row, as digests: the ids never leave the task.

    n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, span_bytes (bytes of the text
    inside the spans of its pieces).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        decimal = pieces.decimals.__getitem__
        for batch in batches:
            for first, texts in texts_of(batch, text):
                rows = []
                for t in texts:
                    ids, begins, ends = pieces.encode(t)
                    of_ids = hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest()
                    rows.append((len(ids), of_ids, hashlib.sha256(pieces.decode(ids).encode()).hexdigest(), None if begins is None else int((ends - begins).sum())))
                n, a, b, covered = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id).slice(first, len(texts)), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(covered, pa.int64())],
                    names=[id, "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint")
