"""The Merkle manifest, the prefix trie and the chat format against plain Python."""

import hashlib
import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some
from oracle import difference, duck
from pyspark import cloudpickle
from pyspark.sql import functions as F

from airgauge.llm import chat_format, merkle, oracles, prefix_trie, queries


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need a test's templates


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- SQL -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), duck(sf), queries.ORACLES[name]) is None


# --- Merkle ----------------------------------------------------------------------------------------


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def manifest(rows):
    """Expected rows of tamper_audit for (doc_id, text, lang, source, n_chars)."""
    made = []
    for id, text, lang, source, n in rows:
        leaf = sha(*map(field, (id, source, lang, n, text)))
        bad = id is not None and zlib.crc32(str(id).encode()) % 7 == 0
        given = sha(*map(field, (id, source, lang, None if n is None else n + 1, text))) if bad else leaf
        made.append((lang is not None, (lang or "").encode(), id is not None, id or 0, leaf, given, id))
    made.sort(key=lambda r: r[:5])
    groups = {}
    for r in made:
        groups.setdefault(r[:2], []).append(r)
    trees = [levels([r[4] for r in g]) for g in groups.values()]
    top = levels([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, g in enumerate(groups.values()):
        for p, r in enumerate(g):
            now, proof = r[5], []
            for tree, place in ((trees[k], p), (top, k)):
                for row in tree[:-1]:
                    other = place ^ 1
                    if other < len(row):
                        proof.append(row[other])
                        now = sha(row[other], now) if place % 2 else sha(now, row[other])
                    else:
                        now = sha(now)
                    place //= 2
            out.append((r[6], r[4], trees[k][-1][0], root, sha(*proof), now, now == root))
    return out


def audited(df, **kw):
    got = merkle.tamper_audit(df, **kw)
    return [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


@pytest.mark.parametrize("span", [1, 3, 10])
def test_manifest_of_odd_rows(spark, docs, rows, span):
    """NULL ids and groups, repeated rows and ids, empty and long texts, clashing columns."""
    assert sorted(map(repr, audited(docs, span=span))) == sorted(map(repr, manifest(rows)))


def test_manifest_of_one_group_and_of_many(spark):
    for n, langs in ((1, 1), (2, 1), (7, 7), (300, 2)):
        rows = [(i, f"t{i}", f"l{i % langs}", None, i) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        assert sorted(audited(df, span=2)) == sorted(manifest(rows))


def test_largest_number_and_no_rows(spark, empty):
    assert audited(empty) == []
    rows = [(i, "x", "en", "s", 2**63 - 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(audited(df)) == sorted(manifest(rows))


def test_upper_rows_are_shared_out(spark):
    """No row of the climb's join meets more than SHARE leaves."""
    rows = spark.range(1500).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    found = merkle.build(rows, "lang", "doc_id", F.unhex(F.sha2(F.col("doc_id").cast("string"), 256)), {}, span=4)
    links = found.low.unionByName(found.upper)
    copies = {r.to_copies for r in links.select("to_copies").distinct().collect()}
    assert max(copies) == -(-1500 // merkle.SHARE)
    one = links.groupBy("tree", "turn", "pos", "copy").count().agg(F.max("count")).first()[0]
    assert one == 1


# --- prefix trie ---------------------------------------------------------------------------------------


def closes(parens):
    stack, out = [], {}
    for i, p in enumerate(parens):
        if p > 0:
            stack.append(i)
        else:
            out[stack.pop()] = i
    return [out[i] for i in sorted(out)]


@pytest.mark.parametrize("block", [2, 4, 64])
def test_find_close(block):
    r = random.Random(3)
    for n in (1, 2, 5, 40, 700):
        parens, depth = [1], 1
        while len(parens) < 2 * n - depth:
            p = 1 if depth == 1 or r.random() < 0.55 else -1
            parens.append(p)
            depth += p
        parens += [-1] * depth
        x = np.array(parens)
        opens = np.flatnonzero(x > 0)
        assert prefix_trie.find_close(np.cumsum(x), opens, block).tolist() == closes(parens)


def trie_of(rows):
    """Expected nodes: depth, members and so on by prefix."""
    by = {}
    order = lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len((t[1] or '').encode())}:{t[1] or ''}{t[2] or ''}".encode()).digest())
    for c, *t in rows:
        if c is not None:
            by.setdefault(c, []).append(t)
    by = {c: [(r or "", x or "") for _, r, x in sorted(ts, key=order)] for c, ts in by.items()}
    nodes = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        t = tuple(by.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(t) + 1):
            nodes.setdefault(t[:d], ([], []))[0].append(c)
        nodes[t][1].append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        own = kids.get(p, [])
        leaves[p] = sum(leaves[x] for x in own) if own else 1
        saved[p] = sum(saved[x] for x in own) + ((len(nodes[p][0]) - 1) * len(p[-1][1].encode()) if p else 0)
    up = lambda p: min(nodes[p[:-1]][0]) if p else None
    return {
        (min(m), len(p), up(p), len(m), len(kids.get(p, [])), leaves[p], saved[p], sha(",".join(map(str, sorted(e)))))
        for p, (m, e) in nodes.items()
    }


TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def talk(seed, n):
    """Conversations with common beginnings, copies, NULLs, empty texts, ties and one with very many turns."""
    r = random.Random(seed)
    rows = [(None, 0, "user", "nobody's"), (3, None, "user", "before all"), (3, 0, None, None), (3, 0, "user", "tie"), (3, 0, "user", "tie")]
    for c in range(n):
        for t in range(r.randint(1, 7)):
            said = "hello" if t == 0 and r.random() < 0.5 else r.choice(["", "yes", "no", "é" * 9, None])
            rows.append((c * 2 if c % 9 else c + 1, t, r.choice(["user", "assistant"]), said))
    return rows + [(10_007, t, "user", f"line {t % 3}") for t in range(400)]


@pytest.mark.parametrize(("shard", "most"), [(prefix_trie.SHARD, prefix_trie.LAST), (20, 60), (1, 2)])
def test_trie_against_plain_sets(spark, shard, most):
    rows = talk(5, 150)
    df = spark.createDataFrame(rows, TURNS).withColumns({"n": F.lit(1), "spine": F.lit("x"), "t": F.lit(2)}).repartition(3)
    got = prefix_trie.rebuilt_trie(df, shard, most).select(*COLUMNS).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == trie_of(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], TURNS)).collect() == []
    only = prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS))
    assert only.collect() == [] and set(only.columns) == set(COLUMNS)


def test_ids_of_one_end_are_hashed_in_order(spark):
    """Ids of one key over several partitions and texts."""
    ids = [i * 7 % 50_021 for i in range(50_021)]
    df = spark.createDataFrame([(b"k", i) for i in ids] + [(b"other", -4)], "key binary, conv_id bigint").repartition(5)
    got = {bytes(r.end_key): r.ends_sha256 for r in prefix_trie.id_hashes(df).collect()}
    assert got == {b"k": sha(",".join(map(str, sorted(ids)))), b"other": sha("-4")}


# --- chat format -----------------------------------------------------------------------------------------

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "[", "]", "<", "/", " ", "s>", "INST]", "é", "a", "\n"]
ODD = some.lists(some.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(some.lists(some.tuples(some.one_of(some.sampled_from(["user", "assistant", "system", ""]), ODD), ODD), max_size=5))
def test_odd_texts_come_back(turns):
    text = chat_format.instruct(turns)
    assert chat_format.read_instruct(text) == turns
    for _, said in turns:
        held = chat_format.escape(said)
        assert not any(c in held for c in chat_format.CONTROL) and chat_format.unescape(held) == said
    for near in (64, 2):
        found = chat_format.locate(chat_format.instruct, turns, near)
        assert found.rewrites == -1 and [chat_format.unescape(text[a:b]) for _, _, a, b in found.spans] == [t for _, t in turns]
        assert [s[0] for s in found.spans] == [3, *[s[1] for s in found.spans]][: len(turns)]


def forgetful(turns):
    """Shows thoughts of the last turn only, as some chat templates do."""
    return "".join(f"{r}:{t if i == len(turns) - 1 else t.split('|')[-1]};" for i, (r, t) in enumerate(turns))


def trimming(turns):
    return "".join(f"<{r}>{t.strip()}</>" for r, t in turns)


def test_templates_that_rewrite_history_are_found():
    plain, thinking = [("user", "a"), ("assistant", "b")] * 4, [("user", "a"), ("assistant", "hm|b"), ("user", "c")] * 40
    assert chat_format.locate(forgetful, plain).rewrites == -1
    assert chat_format.locate(forgetful, thinking[:3]).rewrites == 2 and chat_format.locate(forgetful, thinking[:3]).spans == []
    assert chat_format.locate(forgetful, thinking).rewrites >= 0  # beyond the window's length too
    found = chat_format.locate(trimming, [("user", " a "), ("assistant", "b")])
    assert found.rewrites == -1 and [found.text[a:b] for _, _, a, b in found.spans] == ["a", "b"]
    counting = lambda turns: "".join(f"{len(t)}:{t};" for _, t in turns)
    assert [s[2:] for s in chat_format.locate(counting, [("user", "abc")]).spans] == [(-1, -1)]


def test_spans_are_those_of_all_prefixes_however_long_the_conversation():
    numbered = lambda turns: "".join(f"{i}.{r}:{t};" for i, (r, t) in enumerate(turns))
    thinking = [("user", "a"), ("assistant", "hm|b"), ("user", "c")] * 40
    for render, turns in ((numbered, thinking), (forgetful, thinking), (forgetful, [("user", "a")] * 200 + [("assistant", "x|y"), ("user", "z")])):
        for n in (5, 63, 64, 65, 120, len(turns)):
            assert chat_format.locate(render, turns[:n]) == chat_format.locate(render, turns[:n], near=1000)
    assert chat_format.locate(numbered, thinking).rewrites == -1 and chat_format.locate(forgetful, thinking).rewrites == 2


def test_formatted_table(spark):
    r = random.Random(8)
    rows = [(None, 0, "user", "nobody's"), (1, None, "assistant", "first"), (1, 2, None, None), (1, 2, "user", "tie"), (1, 2, "user", "tie")]
    rows += [(c, t, r.choice(["user", "assistant", "tool", None]), r.choice(["", None, "x </s> y", "[INST]", "é" * 5])) for c in range(2, 40) for t in range(r.randint(1, 9))]
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(700)] + [(100, 0, "assistant", "z" * 300_000)]
    df = spark.createDataFrame(rows, TURNS).withColumns({"loss": F.lit(1), "spans": F.lit("x"), "formatted": F.lit("")}).repartition(3)
    want = {}
    for c, t, role, text in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] is not None, x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = chat_format.round_trip(df).collect()
    assert len(got) == len(want)
    for g in got:
        turns = want[g.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        expected = (len(turns), sha(*[f"{a}\n{b}\n" for a, b in turns]), len(loss), sha(loss), len(chat_format.instruct(turns)), -1)
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256, g.formatted_chars, g.rewrites) == expected
    assert chat_format.round_trip(spark.createDataFrame([], TURNS)).collect() == []


def test_other_templates(spark):
    """A caller's own template: spans but no reading back; one that rewrites history has no loss mask."""
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "hm|b"), (1, 2, "user", "c"), (2, 0, "user", "a"), (2, 1, "assistant", "b")]
    out = {r.conv_id: r for r in chat_format.with_loss(chat_format.format_conversations(spark.createDataFrame(rows, TURNS), forgetful)).collect()}
    assert out[1].rewrites == 2 and out[1].loss == [] and out[1].formatted == "user:a;assistant:b;user:c;"
    assert [out[2].formatted[s.start : s.stop] for s in out[2].loss] == ["b"]


def test_oracles_are_for_known_queries():
    assert set(queries.ORACLES) <= set(queries.QUERIES) and oracles.MERKLE_MANIFEST in queries.ORACLES.values()
