"""Duplicate operators against plain loops over the same rows."""

import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from airgauge.llm import embedding_dedup, jaccard_join, substring_dedup, suffix_dedup
from airgauge.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def digest(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def smallest(names, root):
    by = defaultdict(list)
    for name, r in zip(names, root):
        by[r].append(name)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in by.items()}
    return [least[r] for r in root]


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_jaccard_join(docs, rows, empty):
    sets = [shingles(t) for _, t, *_ in rows]
    pairs = [
        (a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    assert pairs
    names = [r[0] for r in rows]
    want = Counter(zip(names, map(len, sets), smallest(names, roots(len(rows), pairs))))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == want
    assert jaccard_join.near_duplicates(empty).collect() == []
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots(len(rows), pairs)))
    assert jaccard_join.one_of_each(empty).collect() == []


def test_jaccard_join_gives_all_links(spark, rows, empty):
    """Also the links inside a component, which the components do not need."""
    crowd = [" ".join(f"e{k}" if i in (k * 6, 149 - k) else f"w{i}" for i in range(150)) for k in range(25)]
    more = [*rows, *[(1000 + k, t, "en", "src", 1) for k, t in enumerate([*crowd, crowd[3], crowd[3], crowd[7]])]]
    sets = [frozenset(shingles(t)) for _, t, *_ in more]
    like = lambda x, y: bool(x and y) and 100 * len(x & y) >= 75 * len(x | y)
    count = [sum(like(x, y) for y in sets) - bool(x) for x in sets]
    names, size = {}, Counter(sets)
    for (i, *_), x in zip(more, sets):
        names[x] = min((k for k in (i, names.get(x)) if k is not None), default=None)
    distinct = list(names)
    want = Counter(
        frozenset([(names[x], size[x]), (names[y], size[y])]) for k, x in enumerate(distinct) for y in distinct[:k] if like(x, y)
    )
    df = spark.createDataFrame([(i, t) for i, t, *_ in more], "doc_id bigint, text string")
    got, pairs = jaccard_join.all_links(df)
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got.collect()) == Counter(zip([r[0] for r in more], map(len, sets), count))
    assert Counter(frozenset([(r.class_a, r.rows_a), (r.class_b, r.rows_b)]) for r in pairs.collect()) == want
    assert sum(want.values()) > 100
    got, pairs = jaccard_join.all_links(empty)
    assert got.collect() == [] and pairs.collect() == []


def test_jaccard_join_in_many_rounds(spark, monkeypatch):
    """A chain of near copies and a crowd that shares passages without links; few comparisons allowed at once."""
    monkeypatch.setattr(jaccard_join, "COMPARED", 0)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[k * 2 :] + [f"c{k}n{j}" for j in range(k * 2)]) for k in range(12)]
    texts += [" ".join([f"u{k}n{j}" for j in range(12)] + base[:40]) for k in range(15)]
    sets = [shingles(t) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = smallest(list(range(len(texts))), roots(len(texts), pairs))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df).collect()} == dict(enumerate(want))


@pytest.mark.parametrize("n", [35, 33, 17, 5, 1])
def test_substring_dedup(docs, rows, empty, n):
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    times = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    want, cuts = Counter(), []
    for (i, t, *_), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if times[tuple(w[k : k + n])] > 1:
                gone[k : k + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        cuts.append(kept)
        want[i, len(w), len(w) - len(kept), digest(" ".join(kept))] += 1
    assert Counter(tuple(r) for r in substring_dedup.dedup_digests(docs, n).collect()) == want
    assert substring_dedup.dedup_digests(empty, n).collect() == []
    texts = substring_dedup.dedup_texts(docs, n)
    assert texts.columns == docs.columns
    got = Counter((r.doc_id, None if r.text is None else tuple(WORD.findall(r.text)), r.source) for r in texts.collect())
    assert got == Counter((i, None if t is None else tuple(c), s) for (i, t, _, s, _), c in zip(rows, cuts))


def test_a_passage_of_many_documents_comes_to_its_bucket_once_a_block():
    """What documents of one block share is settled there, so a bucket holds it once a block and not once a document."""
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [f"{' '.join(f'a{k}x{i}' for i in range(k % 5))} {passage} b{k}" for k in range(400)]
    batch = pa.RecordBatch.from_pydict({"uid": list(range(1000, 1400)), "text": texts})
    rows = [r for b in substring_dedup._send_seeds(6, 35)(iter([batch])) for r in b.to_pylist()]
    keys = sum(len(r["keys"]) // 7 for r in rows if r["top"] is not None)
    assert keys < 400 * 4 and sum(r["top"] is None for r in rows) == 1
    answers = defaultdict(set)
    for r in rows:
        for uid, found in zip(*substring_dedup._doubled(True)(pa.Table.from_pylist([r], schema=b_schema())).to_pydict().values()):
            answers[uid].update(np.frombuffer(found, "<u8").tolist())
    assert set(answers) == set(range(1000, 1400)) and set.intersection(*answers.values())


def test_picked_keys_spread_over_the_buckets():
    """Picked keys are the least of their runs; spread, they fill all buckets alike."""
    words = substring_dedup.hashes([str(i).encode() for i in range(60_000)])
    at, keys, _ = substring_dedup._seeds(words, 35)
    filled = np.bincount((keys >> np.uint64(substring_dedup.buckets.KEY_BITS - 4)).astype(np.int64), minlength=16)
    assert filled.min() > 0.8 * len(at) / 16 and filled.max() < 1.2 * len(at) / 16
    some = np.arange(0, 1 << 20, 7, dtype=np.uint64)
    assert len(np.unique(substring_dedup.buckets.spread(some, 5))) == len(some)


def seed_rows(texts, bits=6):
    batch = pa.RecordBatch.from_pydict({"uid": list(range(len(texts))), "text": texts})
    return [r for b in suffix_dedup._send_seeds(bits, 50, 20)(iter([batch])) for r in b.to_pylist()]


def test_picked_windows_fill_few_buckets_alike():
    """The least hashes of their runs would put a quarter of all keys into the first of 64 buckets."""
    r = np.random.default_rng(1)
    filled = Counter()
    for row in seed_rows(["".join(map(chr, r.integers(97, 123, 4_000))) for _ in range(100)]):
        filled[row["bucket"]] += len(row["keys"]) // suffix_dedup.SEED_WIDTH
    assert len(filled) == 16 and max(filled.values()) < 1.2 * sum(filled.values()) / 16


def test_a_bucket_is_sorted_slice_by_slice(monkeypatch):
    """Memory follows a bucket's unpacked keys, not several sorted copies of them, and slices change nothing."""
    r = np.random.default_rng(2)
    pool = [bytes(r.integers(97, 123, 2_000).astype(np.uint8)).decode() for _ in range(300)]
    rows = seed_rows([pool[i] for i in r.integers(0, 300, 900)], 6)
    least = min(x["bucket"] for x in rows)
    table = pa.Table.from_pylist([x for x in rows if x["bucket"] == least], schema=b_schema())
    whole = suffix_dedup._shared_seeds(table).to_pylist()
    keys = sum(len(k) // 8 for k in (x["keys"] for x in whole))
    assert keys
    monkeypatch.setattr(suffix_dedup, "SLICE_KEYS", 500, raising=False)
    assert suffix_dedup._shared_seeds(table).to_pylist() == whole
    # one bucket with very many keys, a third of them repeated
    n = 400_000
    many = r.integers(0, 1 << 40, n).astype(np.uint64)
    many[: n // 3] = many[n // 3 : 2 * (n // 3)]
    sides = np.ones(n, suffix_dedup.SIDES)
    table = pa.Table.from_pylist(list(suffix_dedup.buckets.sent(np.arange(n // 100), np.arange(n) // 100, many, 6, sides, 5)), schema=b_schema())
    monkeypatch.setattr(suffix_dedup, "SLICE_KEYS", 20_000, raising=False)
    tracemalloc.start()
    found = suffix_dedup._shared_seeds(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(x) // 8 for x in found["keys"].to_pylist()) == 2 * (n // 3)
    assert peak < 55 * n


def b_schema():
    return substring_dedup.buckets.SENT_ARROW


def test_cut_keeps_other_white_space():
    assert substring_dedup.cut("\ta b\n c  d ", np.array([False, True, False, True])) == "\ta c  "


@pytest.mark.parametrize("n", [50, 9])
def test_suffix_dedup(docs, rows, empty, n):
    last = 1 << 62
    raw = [((last if i is None else i), (t or "").encode()) for i, t, *_ in rows]
    first: dict[bytes, int] = {}
    for i, t in raw:
        for k in range(len(t) - n + 1):
            s = t[k : k + n]
            first[s] = min(first.get(s, last), i)
    want = Counter()
    for (name, *_), (i, t) in zip(rows, raw):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if first[t[k : k + n]] < i:
                gone[k : k + n] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[name, len(t), int(gone.sum()), spans, digest(np.frombuffer(t, np.uint8)[~gone].tobytes())] += 1
    assert Counter(tuple(r) for r in suffix_dedup.dedup_digests(docs, n).collect()) == want
    assert suffix_dedup.dedup_digests(empty, n).collect() == []


def test_suffix_dedup_over_many_shards(docs, monkeypatch):
    whole = Counter(tuple(r) for r in suffix_dedup.dedup_digests(docs).collect())
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "MOST_ALIKE", 1)
    assert Counter(tuple(r) for r in suffix_dedup.dedup_digests(docs).collect()) == whole


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    for text in (rng.integers(97, 99, 700).astype(np.uint8), np.full(300, 97, np.uint8), np.tile(rng.integers(0, 256, 90).astype(np.uint8), 5)):
        order, slot, depth = suffix_dedup.suffix_array(text, 50)
        raw = text.tobytes()
        cells = [raw[p : p + depth] for p in order]
        assert cells == sorted(cells) and (order[slot] == np.arange(len(text))).all()
        prefix = suffix_dedup.common_prefixes(text, order, slot, depth)
        for k in range(1, len(cells)):
            a, b = cells[k - 1], cells[k]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[k] == same


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(100 + k, (base[0] + 0.02 * k * rng.normal(size=16)).tolist(), 0) for k in range(12)]  # a crowd
    rows += [(200 + k, base[1].tolist(), 1) for k in range(5)] + [(210, base[1].tolist(), 2), (211, (base[1] * 7).tolist(), 1)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [None] + [1.0] * 15, 0), (303, [float("nan")] * 16, 0), (304, [float("inf")] + [0.0] * 15, 0)]
    rows += [(305, base[0].tolist(), None), (306, base[0].tolist()[:5], 0), (None, base[1].tolist(), 1), (200, base[1].tolist(), 1), (307, [], 0)]
    return rows


def test_embedding_dedup(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 12)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)
    rows = vectors()
    ok = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) and g is not None for _, v, g in rows]
    links, count = [], [0] * len(rows)
    for a, (_, x, g) in enumerate(rows):
        for b, (_, y, h) in enumerate(rows[:a]):
            if ok[a] and ok[b] and g == h and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    assert max(count) > 5
    names = [r[0] for r in rows]
    least = smallest(names, roots(len(rows), links))
    want = Counter(zip(names, count, least, [n == m for n, m in zip(names, least)]))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = embedding_dedup.near_duplicates(df.selectExpr("*", "1 AS cid", "2 AS root"))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    x[1000:1400] = x[0] + 0.05 * rng.normal(size=(400, 32))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = embedding_dedup.Graph.build(x)
    true = x @ x.T >= 0.93
    for own in (np.arange(3000), np.full(3000, -1)):  # known to the graph, and as from another shard
        i, j = graph.near(x, own, 0.93, embedding_dedup.BEAM)
        assert true[i, j].all() and len(i) >= 0.99 * true.sum()


def near_pairs(n):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 16))
    x[1::2] = x[::2] + 0.02 * rng.normal(size=(n // 2, 16))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_graph_audit_asks_as_strangers():
    """Vectors that hang together in pairs only are found from their own node, but not from above."""
    x = near_pairs(400).astype(np.float32)
    mates = np.arange(400, dtype=np.int32).reshape(-1, 2)[:, ::-1].reshape(-1, 1)
    graph = embedding_dedup.Graph(x, [mates], 0)
    i, j = graph.near(x, np.arange(400), 0.93, embedding_dedup.BEAM)
    assert set(zip(np.arange(400), mates[:, 0])) <= set(zip(i, j))
    beam, found = graph.audited(0.93)
    assert beam >= 400 and found == 1.0


def test_graph_audit_asks_vectors_of_other_shards():
    x = near_pairs(600).astype(np.float32)
    links = np.concatenate([np.full((300, 1), -1, np.int32), np.arange(1, 301, dtype=np.int32)[:, None] % 300], axis=1)
    graph = embedding_dedup.Graph(x[::2], [links], 0)  # a ring: no two of these are alike, but each has a mate elsewhere
    assert graph.audited(0.93)[0] == embedding_dedup.BEAM
    beam, found = graph.audited(0.93, x[1::2])
    assert beam >= 300 and found == 1.0


def test_a_link_that_one_shard_finds_counts_for_both():
    x = near_pairs(80)
    rows = []
    for shard in (0, 1):
        table = pa.table({
            "grp": pa.array([7] * 40, pa.int64()), "shard": pa.array([shard] * 40, pa.int32()), "shards": pa.array([2] * 40, pa.int32()),
            "cid": np.arange(shard, 80, 2), "weight": np.full(40, 3 + shard), "vector": list(x[shard::2]),
        })
        rows.append(embedding_dedup._graph(table, table.slice(0, 0)))
    blind = rows[0].to_pylist()[0]
    blind |= {"layers": [np.full((40, 1), -1, np.int32).tobytes()], "beam": 1}
    graphs = pa.concat_tables([pa.Table.from_pylist([blind], embedding_dedup.GRAPH), rows[1]])
    got = embedding_dedup._met((pa.scalar(7), pa.scalar(0), pa.scalar(1)), graphs).to_pylist()
    assert got == [{"cid": k, "links": 4 - k % 2, "root": k - k % 2} for k in range(80)]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 99), (100, 98), (7, 7), (55, 54), (54, 56)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    want = {**dict.fromkeys(range(2, 41), 1), 99: 98, 100: 98, 55: 54, 56: 54}
    assert {r.node: r.root for r in components(df).collect()} == want
    assert components(df.limit(0)).collect() == []
