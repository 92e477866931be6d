"""Ids of the `tokenizers` library for whole texts, a pre-token at a time where that is provably the same.

Byte-level BPE never merges across pre-tokens, so the ids of a text are those of its pre-tokens, and a
worker keeps the ids of pre-tokens it has met. Pre-tokens are cut by a pattern only in texts of plain
Latin-1 characters without special strings; every other text goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# The split patterns of the two kinds of vocabulary file, over the plain characters below.
SPLITS = {
    "byte": rf"{ENDINGS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\t\n\r {LETTERS}{NUMBERS}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+",
    "word": rf"{ENDINGS}|[{LETTERS}]+|[{NUMBERS}]|[^\t\n\r {LETTERS}{NUMBERS}]+",
}
NOT_PLAIN = r"[^\t\n\r -~\xa1-\xff]"

MOST_KEPT = 800_000  # pre-tokens a worker keeps
LONGEST_KEPT = 64  # characters of a pre-token that is kept


def kind_of(config: dict) -> str | None:
    """Which of SPLITS a tokenizer file follows; None when neither is known to hold."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    plain = config["model"]["type"] == "BPE" and all(t["content"].startswith("<|") for t in config["added_tokens"])
    if not plain or config["model"].get("dropout") or config["model"].get("ignore_merges"):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte"
    if norm is None or norm.get("type") != "Sequence":
        return None
    steps = [(n["type"], n.get("pattern"), n.get("content")) for n in norm["normalizers"]]
    parts = pre.get("pretokenizers") or [{}]
    split = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    lowered = steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
    if lowered and parts[0].get("pattern") == {"Regex": split} and parts[0].get("invert") and len(parts) == 2:
        return "word"
    return None


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Kept(dict):
    """Ids by pre-token; one that is not here is encoded by the vocabulary's merges and kept."""

    def __init__(self, model, known: dict[str, bytes]):
        super().__init__(known)
        self.tokenize = model.tokenize
        self.letters = byte_letters()

    def __missing__(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.tokenize(written)]).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids


class Tokens:
    """Ids of whole texts, little-endian 32-bit."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.kind = kind_of(json.load(f))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.split = re.compile(SPLITS[self.kind]).findall if self.kind else None
        self.odd = re.compile(NOT_PLAIN).search
        self.kept = _Kept(self.library.model, {})

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens of a plain text, None for others."""
        if self.split is None or "<|" in text or self.odd(text):
            return None
        return self.split(text.lower() if self.kind == "word" else text)

    def ids(self, text: str) -> bytes:
        pieces = self.pieces(text)
        if pieces is None:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.kept) > MOST_KEPT:  # the half met last goes: frequent pre-tokens are met early
            for piece in list(self.kept)[MOST_KEPT // 2 :]:
                del self.kept[piece]
        return b"".join(map(self.kept.__getitem__, pieces))
