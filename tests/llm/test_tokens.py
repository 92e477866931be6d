"""Tokenizing operators against their libraries, files against a round trip, packing against its constraints."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airgauge.llm import packing, sentence_pieces, token_counts, token_files
from airgauge.llm.tokenizing import Tokens
from airgauge.session import shared_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def library_ids(path, text, end=None):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array(ids + ([end] if end is not None else []), "<u4")


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_are_the_librarys(rows, path):
    tokens = Tokens(path)
    for _, text, *_ in rows:
        assert np.frombuffer(tokens.ids(text or ""), "<u4").tolist() == library_ids(path, text).tolist()


@pytest.mark.parametrize("path", [BYTE_BPE, PIECES])
def test_token_counts(docs, rows, empty, path):
    if path == PIECES:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(library.encode(t))
    else:
        count = lambda t: len(library_ids(path, t))
    want = Counter((i, len((t or "").encode()), count(t or ""), count(t or "") > 40) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in token_counts.token_counts(docs, path, 40).collect()) == want
    assert token_counts.token_counts(empty, path, 40).collect() == []


def test_every_text_is_looked_up_by_pre_token(spark, monkeypatch):
    """Quotes, dashes, other scripts and added tokens too: what is frequent is in the table, and nothing is encoded whole."""
    texts = ["“quoted” — don’t", "日本語 のテキスト", "a<|endoftext|> b “c”", "é ﬁ İ \x85 \x00 😀", "", "plain text, twice plain text"] * 3 + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    table = token_counts.frequent_lengths(df, BYTE_BPE)
    lengths = token_counts.Lengths(BYTE_BPE, table)
    want = [len(library_ids(BYTE_BPE, t)) for t in texts]
    pieces = {p for t in texts for p in lengths.pre.split(t or "")[0]}
    assert "“" in pieces and " のテキスト" in pieces and (table.find(sorted(pieces)) > 0).all()
    monkeypatch.setattr(lengths, "encoded", lambda piece: pytest.fail(piece))
    assert lengths.of([t or "" for t in texts]) == want
    bare = token_counts.Lengths(BYTE_BPE, token_counts.Table([], []))
    assert bare.of([t or "" for t in texts]) == want and set(bare.missed) == pieces


def test_table_finds_what_it_holds_and_nothing_else():
    names = [f"w{i}" for i in range(5_000)]
    table = token_counts.Table(names, [i % 9 + 1 for i in range(5_000)])
    assert table.find(names).tolist() == [i % 9 + 1 for i in range(5_000)]
    assert not table.find([f"x{i}" for i in range(5_000)]).any() and table.find([]).tolist() == []


def test_frequent_pre_tokens_outlive_thinning(spark):
    """One in `held` of a task's pre-tokens is enough to be reported, whatever else the task has met."""
    counts = Counter({f"r{i}": 1 for i in range(100)} | {"often": 50})
    assert token_counts.thinned(counts, 10) == 1 and dict(counts) == {"often": 49}
    rare = " ".join(f"q{i}z{i * 7}" for i in range(20_000))
    df = spark.createDataFrame([(0, rare + " often" * 1_000)], "doc_id bigint, text string").coalesce(1)
    table = token_counts.frequent_lengths(df, BYTE_BPE, held=100)
    assert table.find([" often"])[0] == 1 and (table.length > 0).sum() <= 100


def test_sentencepiece_digests_and_pieces(docs, rows, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode(t or "")
        want[i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)), len((t or "").encode())] += 1
    assert Counter(tuple(r) for r in sentence_pieces.digests(docs, PIECES).collect()) == want
    assert sentence_pieces.digests(empty, PIECES).collect() == []
    encoded = sentence_pieces.encode(docs, PIECES)
    texts = Counter((i, library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in sentence_pieces.decode(encoded, PIECES).collect()) == texts
    for r in encoded.collect():
        assert all(b <= e for b, e in zip(r.begins, r.ends)) and r.begins[1:] == r.ends[:-1]


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf", "identity"])
def test_character_map_normalises_like_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    spec = sentence_pieces.model_format.ModelProto.FromString(library.serialized_model_proto()).normalizer_spec
    mine = sentence_pieces.Normalizer(spec, [])
    for text in ("", "  two  spaces ", "ﬁne ①②③ ｱｲｳ ㍿ Ａ", "éä", "plain", "Straße ŀ", "tab\tand\nline", "½ ™ …"):
        raw, where = mine(text)
        assert raw.decode() == library.normalize(text)
        assert len(where) == len(raw) + 1 and (np.diff(where) >= 0).all() and where[-1] <= len(text.encode())


def test_spans_are_those_of_the_library(rows):
    pieces = sentence_pieces.Pieces(PIECES)
    for _, text, *_ in rows[:30]:
        ids, begins, ends = pieces.encode(text or "")
        if ids:
            proto = pieces.library.encode(text, return_type="proto")
            whole = [(p.begin, p.end) for p in proto.pieces]
            plain = [k for k, p in enumerate(proto.pieces) if not p.piece.startswith("<0x")]
            assert [(begins[k], ends[k]) for k in plain] == [whole[k] for k in plain]


def test_code_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)
        control, data = token_files.pack(ranks)
        assert (token_files.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == ranks).all()
    ids, counts, ranks = token_files.parse(token_files.file_bytes([5, 9], [2, 1], np.array([0, 300, 70_000])))
    assert (ids.tolist(), counts.tolist(), ranks.tolist()) == ([5, 9], [2, 1], [0, 300, 70_000])


def test_token_files(spark, docs, rows, empty):
    folder = shared_dir(spark, "files-test")
    manifest = token_files.write_files(docs, folder, WORD_BPE, 1, file_tokens=500).persist()
    assert manifest.count() > 5
    got = token_files.read_files(spark, folder, manifest).collect()
    want = Counter((i, len(ids), zlib.crc32(ids.tobytes())) for i, t, *_ in rows for ids in [library_ids(WORD_BPE, t, 1)])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    names = [r.doc_id for r in got]
    assert names == sorted(names, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    assert token_files.round_trip(empty, WORD_BPE, 1).collect() == []


def test_best_fit_takes_the_fullest_bin_that_has_room():
    assert [sorted(b) for b in packing.best_fit(np.array([6, 5, 4, 5, 1, 9]), 10)] == [[4, 5], [0, 2], [1, 3]]


def test_packing(docs, rows, empty):
    got = packing.pack_documents(docs, WORD_BPE, 1, capacity=256).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = library_ids(WORD_BPE, t, 1)
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 256
    assert len(bins) <= 1.02 * sum(r.length for r in got) / 256 + 1
    assert packing.pack_documents(empty, WORD_BPE, 1).collect() == []


def test_very_many_empty_texts(spark, tmp_path):
    """Sequences and files of thousands of one-token documents: places are sums along them, not sums of sums."""
    n = 30_000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("")).alias("text")).repartition(2)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(df, path, end_id=1).toPandas()
    assert len(rows) == n and rows.sequence_id.nunique() == -(-n // 4096) and (rows.length == 1).all()
    for _, own in rows.groupby("sequence_id"):
        assert sorted(own.offset) == list(range(len(own)))
    back = token_files.round_trip(df, path, end_id=1).orderBy("doc_id").toPandas()
    assert (back.start == range(n)).all() and (back.n_tokens == 1).all()


def test_pieces_that_do_not_tile_have_no_spans(spark, monkeypatch):
    """Ids stay right where the places in the text cannot be told."""
    pieces = sentence_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    whole = pieces.encode("one two")
    monkeypatch.setattr(pieces, "normalize", lambda text: (b"", None))
    assert pieces.encode("one two") == (whole[0], None, None)
