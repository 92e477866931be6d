"""Governed retrieval against brute force, the recall gate's verdicts, and published chunks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgauge import standin as st
from airgauge.operators import chunks as ch
from airgauge.operators import governed_index as gi
from airgauge.plans import publish
from airgauge.plans import questions as q

VECTORS = "vec_id bigint, embedding array<float>, planta string, ambito string"


def unit(x):
    x = np.asarray(x, dtype=np.float32).astype(np.float64)
    return x / np.linalg.norm(x)


def clustered(n, seed=3, size=12):
    """Vectors around few centres, one of which has a third of all; odd ones have no direction or no label."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, size))
    rows = []
    for i in range(n):
        c = 0 if i % 3 == 0 else int(r.integers(6))
        v = centres[c] + r.normal(size=size) * 0.3
        rows.append((i, [float(x) for x in v], f"P{int(r.integers(4))}" if i % 50 else None, "ab"[i % 2]))
    rows[7] = (7, None, "P0", "a")
    rows[8] = (8, [0.0] * size, "P0", "a")
    rows[9] = (9, [float("nan")] * size, "P0", "a")
    rows[10] = (10, rows[11][1], "P1", "a")  # two alike
    return rows


@pytest.mark.parametrize("lists", [1, 5, 40])
def test_nearest_permitted_vectors(spark, lists, monkeypatch):
    monkeypatch.setattr(gi, "VECTOR_BLOCK", 100)  # lists of several blocks
    rows = clustered(900)
    k, grants = 5, {"ana": [("P0", "a"), ("P1", "a"), ("P1", "b")], "luz": [("P2", "b"), ("", "a")], "none": [], "all": [(f"P{i}", s) for i in range(4) for s in "ab"]}
    r = random.Random(1)
    asking = [(i, r.choice(list(grants)), rows[r.randrange(20, 900)][1] if i % 2 else [r.gauss(0, 1) for _ in range(12)]) for i in range(60)]
    asking += [(90, "ana", None), (91, "stranger", rows[20][1])]
    index = gi.build_index(spark.createDataFrame(rows, VECTORS), ["planta", "ambito"], "vec_id", "embedding", lists)
    queries = spark.createDataFrame(asking, "query_id int, user_id string, query_vector array<double>")
    allowed = spark.createDataFrame([(u, f"{p}|{a}") for u, g in grants.items() for p, a in g], "user_id string, etiqueta string")
    got = {}
    for h in gi.nearest_governed(index, queries, allowed, k).collect():
        got.setdefault(h.query_id, []).append((h.lugar, h.vec_id, round(h.score, 9)))
    whole = [(i, unit(v), (p or "", a)) for i, v, p, a in rows if v is not None and i not in (8, 9)]
    want = {}
    for i, user, v in asking:
        if v is None or not grants.get(user):
            continue
        v = np.asarray(v) / np.linalg.norm(v)
        best = sorted((-round(float(v @ w), 9), n) for n, w, label in whole if label in grants[user])[:k]
        want[i] = [(place, n, -score) for place, (score, n) in enumerate(best, 1)]
    assert set(got) == set(want)
    for i, hits in want.items():
        mine = sorted(got[i])
        assert [x[:2] for x in mine] == [x[:2] for x in hits], i
        assert all(abs(a[2] - b[2]) < 1e-8 for a, b in zip(mine, hits))


def test_far_lists_are_not_scored(spark, monkeypatch):
    """Bounds leave most lists of clustered vectors out of the second pass."""
    scored = []
    whole = gi._scored

    def counting(asked, *rest):
        scored.append(asked.count())
        return whole(asked, *rest)

    monkeypatch.setattr(gi, "_scored", counting)
    rows = clustered(600)
    index = gi.build_index(spark.createDataFrame(rows, VECTORS), ["ambito"], "vec_id", "embedding", 6)
    queries = spark.createDataFrame([(i, "u", rows[i][1]) for i in range(20, 40)], "query_id int, user_id string, query_vector array<double>")
    allowed = spark.createDataFrame([("u", "a"), ("u", "b")], "user_id string, etiqueta string")
    gi.nearest_governed(index, queries, allowed, 5).collect()
    pairs = 20 * index.lists.count()
    assert scored[0] < pairs / 4 and sum(scored) < pairs * 0.75


def test_index_of_nothing(spark):
    index = gi.build_index(spark.createDataFrame([], VECTORS), ["planta"], "vec_id", "embedding")
    queries = spark.createDataFrame([(1, "u", [1.0, 0.0])], "query_id int, user_id string, query_vector array<double>")
    allowed = spark.createDataFrame([("u", "P0")], "user_id string, etiqueta string")
    assert gi.nearest_governed(index, queries, allowed, 5).collect() == []


def test_recall_verdicts(spark):
    exact, indexed = [], []
    for rule, n, found in (("good", 400, 396), ("bad", 400, 100), ("unsure", 10, 8), ("low", 5, 5)):
        score = 0.5 if rule == "low" else 0.9
        exact += [(rule, 1, i, score) for i in range(n)]
        indexed += [(rule, 1, i, score) for i in range(found)] * 2  # a hit reported twice is one hit
    schema = "regla_id string, query_id int, vec_id int, score double"
    rules = spark.createDataFrame([(r, 0.8, 0.7) for r in ("good", "bad", "unsure", "low", "unasked")], "regla_id string, threshold double, recall_min double")
    got = {r.regla_id: (r.relevantes, r.encontrados, r.veredicto) for r in gi.recall_gate(spark.createDataFrame(indexed, schema), spark.createDataFrame(exact, schema), rules).collect()}
    assert got == {
        "good": (400, 396, "cumple"), "bad": (400, 100, "no_cumple"), "unsure": (10, 8, "indeciso"), "low": (0, 0, "sin_datos"), "unasked": (0, 0, "sin_datos"),
    }


def test_publishing_again_adds_only_what_changed(spark, sf, tmp_path):
    marts, key, root = st.marts(spark, sf), F.lit("0123456789abcdef0123456789abcdef"), f"{tmp_path}/chunks"
    kept = spark.createDataFrame(marts["promedios_planta"].collect(), marts["promedios_planta"].schema)
    at = F.lit("2026-01-01").cast("timestamp")
    publish.publish_chunks({"promedios_planta": kept}, root, key, "r1", at, "s", ["P3", "P5"])
    first = publish.read_chunks(spark, root, key)
    n = first.count()
    assert n > 1 and spark.read.parquet(root).where(F.col("texto") == "").count() == 0
    publish.publish_chunks({"promedios_planta": kept}, root, key, "r2", at, "s", ["P3", "P5"])
    assert publish.read_chunks(spark, root, key).count() == n
    plant = kept.orderBy("planta_canon").first().planta_canon
    changed = kept.withColumn("maximo_mg_m3", F.when(F.col("planta_canon") == plant, F.col("maximo_mg_m3") + 1000).otherwise(F.col("maximo_mg_m3")))
    publish.publish_chunks({"promedios_planta": changed}, root, key, "r3", at, "s", ["P3"])
    added = publish.read_chunks(spark, root, key).where("corrida_id = 'r3'").collect()
    assert [r.chunk_id for r in added] == [plant] and added[0].chunk_clave == f"P3|{plant}" and added[0].regla_version == publish.rule_version(q.QUESTIONS["P3"])
    raw = spark.read.parquet(root).where(F.col("texto").contains(plant)).count()
    assert raw == 0  # stored text is cipher text
    assert publish.rule_version(q.QUESTIONS["P3"]) != publish.rule_version(q.QUESTIONS["P5"])


def test_missing_chunks_are_those_of_an_upsert_and_shuffle_no_text(spark, monkeypatch):
    at = F.lit("2026-01-01").cast("timestamp")
    rows = spark.createDataFrame([(f"P{i % 7}", i, "x" * 50, i / 3) for i in range(60)], "planta_canon string, n int, dicho string, v double")
    made = lambda df, run: ch.build_chunks(df, "R", "m", ["n"], "{dicho} {v}", {"planta": "column:planta_canon"}, ["dicho"], run, at, "s")
    twice = rows.unionByName(rows.where("n < 5")).unionByName(rows.where("n = 3").withColumn("planta_canon", F.lit("P9")))
    stored = made(rows.where("n < 40").withColumn("v", F.when(F.col("n") == 4, 9.0).otherwise(F.col("v"))), "antes")
    said = lambda df: sorted(map(str, df.collect()))
    for few in (100, 0):
        monkeypatch.setattr(ch, "FEW_KEYS", few)
        for src, known in ((rows, None), (twice, None), (rows, stored), (twice, stored), (rows.where("n > 50"), stored)):
            new = made(src, "ahora")
            assert said(ch.missing_chunks(new, known).select(*new.columns)) == said(ch.upsert_chunks(new, known).select(*new.columns))
        assert ch.missing_chunks(made(rows.where("n = 2"), "ahora"), stored) is None
    # what is all new stays in the tasks that make it
    assert "Exchange" not in ch.missing_chunks(made(rows, "ahora"), None)._jdf.queryExecution().executedPlan().toString()


def test_published_copies_are_one_chunk_and_a_rule_is_a_folder(spark, sf, tmp_path):
    marts, key, root = st.marts(spark, sf), F.lit("0123456789abcdef0123456789abcdef"), f"{tmp_path}/chunks"
    mart = spark.createDataFrame(marts["promedios_planta"].collect(), marts["promedios_planta"].schema)
    monday = F.lit("2026-01-01").cast("timestamp")
    rules = ["P3", "P4", "P13"]
    windows = spark.createDataFrame(marts["ventanas_temporales"].limit(0).collect(), marts["ventanas_temporales"].schema)  # a rule without an answer
    for run in ("r1", "r2"):
        publish.publish_chunks({"promedios_planta": mart, "ventanas_temporales": windows}, root, key, run, monday, "s", rules)
    got = publish.read_chunks(spark, root, key)
    want = publish.rule_chunks({"promedios_planta": mart, "ventanas_temporales": windows}, rules, "r1", monday, "s")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, ch.upsert_chunks(want, None).collect()))
    stored = sorted(x.name for x in (tmp_path / "chunks").iterdir() if x.is_dir())
    assert stored == ["regla_id=P3", "regla_id=P4"]
    assert all(x.name.endswith(".zstd.parquet") for x in (tmp_path / "chunks").glob("*/part-*"))
