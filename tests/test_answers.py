import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgauge import standin as st
from airgauge.operators import chunks as ch
from airgauge.operators import governance as g
from airgauge.operators import vectors as vec
from airgauge.plans import questions as q
from airgauge.plans import reports as rep
from airgauge.plans.frames import SUBJECTS, Frames
from airgauge.plans.marts import measurement_detail
from airgauge.plans.templates import TEMPLATES
from airgauge.registry import TABLES, table_audit
from airgauge.session import shared_dir
from airgauge.sources import landing as ld
from airgauge.streaming import incremental as inc


@pytest.fixture(scope="module")
def marts(spark, sf):
    return st.marts(spark, sf)


def test_one_parameter_gives_its_part_of_the_whole(marts):
    planta = "NATION_20"
    for qid in ("P3", "P13", "P16"):
        whole = {tuple(r) for r in q.QUESTIONS[qid].run(marts).where(F.col("planta_canon") == planta).collect()}
        assert whole == {tuple(r) for r in q.QUESTIONS[qid].run(marts, planta=planta).collect()}
    for qid in ("P7", "P9", "P10", "P14", "P15", "P19", "P20", "P22", "P23", "P24"):
        rows = q.QUESTIONS[qid].run(marts)
        part = q.QUESTIONS[qid].run(marts, punto=1)
        assert sorted(map(str, rows.where("punto_nro = 1").collect())) == sorted(map(str, part.collect())), qid
    name = "equipo supplier#00000000%"
    assert q.QUESTIONS["P18"].run(marts, maquina=name).count() == 1
    assert q.QUESTIONS["P8"].run(marts, maquina=name).count() == q.QUESTIONS["P8"].run(marts).count()
    orders = [r.orden_nro for r in marts["ot_en_curso"].select("orden_nro").distinct().limit(3).collect()]
    assert {r.orden_nro for r in q.QUESTIONS["P26"].run(marts, ordenes=orders).collect()} == set(orders)


def test_window_against_brute_force(spark):
    rng = random.Random(1)
    data = [("P", 1, "n", y, w, None, None, rng.choice([1.0, 3.0]), "medido", "f") for y in (2024, 2025)
            for w in range(1, 53) for _ in range(rng.randint(0, 2))]
    schema = ("planta_canon string, punto_nro int, nombre_punto string, anio int, semana_nro int, a date, b date, "
              "concentracion_mg_m3 double, estado string, ambito string")  # fmt: skip
    mart = spark.createDataFrame(data, schema)
    per = {}
    for r in data:
        if r[7] >= 2.5:
            per[r[3], r[4]] = per.get((r[3], r[4]), 0) + 1
    for mode in ("rows", "range"):
        best = []
        for y in (2024, 2025):
            weeks = sorted(w for yy, w in per if yy == y)
            for i, w in enumerate(weeks):
                inside = weeks[i : i + 4] if mode == "rows" else [x for x in weeks if w <= x <= w + 3]
                best.append((-sum(per[y, x] for x in inside), y, w))
        n, y, w = min(best)
        r = q.high_window(mart, mode=mode).first()
        assert (r.anio, r.semana_inicio, r.semana_fin, r.n_altos_ventana) == (y, w, w + 3, -n)


def test_trend_needs_two_weeks(spark):
    data = [("sola", 1, "n", 2025, 1, 9.0), ("sube", 2, "n", 2025, 1, 1.0), ("sube", 2, "n", 2025, 2, 2.0)]
    mart = spark.createDataFrame(
        [(*r, "medido", "f") for r in data],
        "planta_canon string, punto_nro int, nombre_punto string, anio int, semana_nro int, concentracion_mg_m3 double, "
        "estado string, ambito string",
    )
    assert [(r.planta_canon, r.pendiente) for r in q.rising_plant(mart).collect()] == [("sube", 1.0)]
    labels = {r.planta_canon: r.tendencia for r in rep.plant_trends(mart).collect()}
    assert labels == {"sola": None, "sube": "creciente"}


def test_every_question_has_its_chunk_columns_and_text(marts):
    assert TEMPLATES.keys() == q.QUESTIONS.keys()
    for question in q.QUESTIONS.values():
        rows = question.run(marts, ordered=False)
        chunks = question.chunks(rows, "c", F.current_timestamp(), "s")
        assert tuple(chunks.columns) == ch.CHUNK_COLUMNS


def test_chunk_text_hash_and_tokens(spark):
    df = spark.createDataFrame([("Ana", None, 2.5, True), ("Luis", "x", None, False)], "n string, e string, v double, f boolean")
    made = ch.build_chunks(df, "R", "M", ["n", "e"], (("f", "sí {v}", "no {v}"), " de {n}."), {"a": "column:n", "b": "fijo"},
                           ["n"], "c", F.current_timestamp(), "s").collect()
    token = "PII_" + hashlib.sha256(b"sAna").hexdigest()
    first = made[0]
    assert first.texto == f"sí 2.5 de {token}." and made[1].texto.startswith("no None de PII_")
    assert first.chunk_id == f"{token}_None" and first.pii_tokens == {"n": token}
    assert first.datos_negocio == f'{{"f":"true","n":"{token}","v":"2.5"}}'
    want = hashlib.sha256(f"{first.texto}|{first.datos_negocio}".encode()).hexdigest()[:16]
    assert first.hash_contenido == want and first.dimensiones["b"] == "fijo"


def test_chunk_upsert_validity_and_counts(spark):
    def rows(data):
        return spark.createDataFrame(data, "regla_id string, chunk_id string, hash_contenido string, valido_hasta long")

    old = rows([("R", "1", "a", -1), ("R", "2", "a", 10)])
    new = rows([("R", "1", "a", -1), ("R", "2", "b", 10), ("R", "2", "b", 10)])
    assert [r.chunk_id for r in ch.upsert_chunks(new, old).collect()] == ["2"]
    assert {r.chunk_id for r in ch.valid_chunks(old, F.lit(10)).collect()} == {"1"}
    limits = spark.createDataFrame([("R", 1, 1), ("S", 0, 5), ("T", 1, 5)], "regla_id string, minimo int, maximo int")
    assert {r.regla_id: r.cumple for r in ch.check_counts(old, limits).collect()} == {"R": False, "S": True, "T": False}


def test_governance_fails_closed(spark):
    df = spark.createDataFrame([("A", "x", "Interno"), ("B", "x", "Restringido"), ("C", "y", "?")], "p string, s string, c string")
    grants = spark.createDataFrame(
        [("u", "planta", "G"), ("u", "planta", "nada"), ("u", "ambito", "x"), ("u", "clasificacion", "Interno"), ("w", "planta", "C")],
        "user_id string, dimension string, value string",
    )
    groups = spark.createDataFrame([("planta", "G", "A"), ("planta", "G", "B")], "dimension string, grupo string, valor string")
    domain = spark.createDataFrame(
        [("planta", "A"), ("planta", "B"), ("planta", "C"), ("ambito", "x"), ("clasificacion", "Interno")],
        "dimension string, valor string",
    )
    known = g.expand_groups(grants, groups, domain)
    dims = {"planta": "p", "ambito": "s"}

    def seen(user, dims, **kw):
        return sorted(r.p for r in g.governed(df, known, user, dims, **kw).collect())

    assert seen("u", dims) == ["A", "B"]
    assert seen("w", dims) == [] and seen("w", {"planta": "p"}) == ["C"] and seen("nadie", dims) == []
    assert seen("u", {"planta": "p"}, required=("otra",)) == []
    levels = {"clasificacion": g.LEVELS}
    assert seen("u", {**dims, "clasificacion": "c"}, levels=levels) == ["A"]
    by_user = {(r.user_id, r.p) for r in g.governed_by_user(df, known, dims).collect()}
    assert by_user == {("u", "A"), ("u", "B")}


def test_report_rows_are_plants_times_years(spark, marts):
    grants = spark.createDataFrame([("u", "planta", p) for p in ("NATION_15", "NATION_20")], "user_id string, dimension string, value string")
    rows = rep.report("concentracion_anual", marts, grants, "u").collect()
    whole = rep.annual_concentration(marts["cobertura_semanal"]).where("planta in ('NATION_15', 'NATION_20')")
    assert len(rows) == whole.count() and {r.planta for r in rows} <= {"NATION_15", "NATION_20"}
    one = rep.report("concentracion_anual", marts, grants, "u", anio=1998).collect()
    assert {r.anio for r in one} == {1998}


@pytest.mark.parametrize("few, blocks", [(True, (1024, 16384)), (False, (3, 7)), (False, (1024, 16384))])
def test_topk_against_brute_force(spark, few, blocks):
    rng = np.random.default_rng(3)
    v, u = rng.normal(size=(60, 8)), rng.normal(size=(11, 8))
    v[5] = 0.0  # a vector of length 0 is never near
    v[7] = v[8]  # equal scores: lowest id first
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "query_id long, query_vector array<double>")
    got = {}
    none = spark.createDataFrame([(90, None), (91, [])], queries.schema)
    vectors = vectors.unionByName(spark.createDataFrame([(90, None), (91, [])], vectors.schema)).repartition(5)
    found = vec.topk_cosine(queries.unionByName(none), vectors, 4, query_block=blocks[0], vector_block=blocks[1], few_queries=few)
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.lugar] = r.vec_id
    f = v.astype(np.float32).astype(float)
    with np.errstate(invalid="ignore"):
        scores = (u / np.linalg.norm(u, axis=1, keepdims=True)) @ (f / np.linalg.norm(f, axis=1, keepdims=True)).T
    for i, s in enumerate(scores):
        want = sorted((-x, j) for j, x in enumerate(s) if not np.isnan(x))[:4]
        assert [got[i][k] for k in range(1, 5)] == [j for _, j in want]


def test_task_functions_run_without_the_package(tmp_path):
    """From another folder, where the Python workers cannot import this repository."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from airgauge.session import build_session\n"
        "s = build_session(master='local[1]', **{'spark.ui.enabled': 'false'})\n"
        "from airgauge.operators.vectors import topk_cosine\n"
        "v = s.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], 'vec_id long, embedding array<float>')\n"
        "q = s.createDataFrame([(1, [1.0, 0.1])], 'query_id long, query_vector array<float>')\n"
        "q2 = q.unionByName(s.createDataFrame([(2, [0.1, 1.0])], q.schema))\n"
        "assert [r.vec_id for r in topk_cosine(q, v, 1, few_queries=True).collect()] == [1]\n"
        "assert sorted(r.vec_id for r in topk_cosine(q2, v, 1, query_block=1).collect()) == [1, 2]\n"
    )
    env = {k: x for k, x in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, timeout=300)
    assert done.returncode == 0, done.stderr.decode()[-2000:]


def test_vector_table_checks_size(spark):
    path = shared_dir(spark, "v")
    ld.ensure_vector_table(spark, path, 2)
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "vec_id long, embedding array<float>")
    ld.append_vectors(rows, path, 2)
    ld.append_vectors(rows, path, 2)
    assert ld.ensure_vector_table(spark, path, 2).count() == 1
    with pytest.raises(ValueError):
        ld.ensure_vector_table(spark, path, 3)


def test_sources(spark, sf, tmp_path):
    (tmp_path / "a.csv").write_text('etiqueta,column01\n"Punto, A",1.5\n B ,\n', encoding="utf-8")
    spec = ld.SourceSpec("a", str(tmp_path / "a.csv"), tags={"planta": "P"})
    gone = ld.SourceSpec("b", str(tmp_path / "b.csv"), ("etiqueta",))
    df, report = ld.scan_all(spark, [spec, gone])
    assert report == {"a": True, "b": False}
    assert sorted((r.etiqueta, r.column01) for r in df.collect()) == [(" B ", None), ("Punto, A", "1.5")]
    empty, present = ld.scan_optional(spark, gone)
    assert (empty.count(), empty.columns, present) == (0, ["etiqueta"], False)
    (tmp_path / "p.csv").write_text("condicion_codigo,problema_raiz_codigo\nX,Y\n")
    assert ld.load_reference(spark, "condiciones_problema", str(tmp_path / "p.csv")).first().problema_raiz_codigo == "Y"
    assert table_audit(spark, sf).count() == len(TABLES)


def test_stream_in_batches_equals_one_batch(spark, sf, tmp_path):
    events = st.Tables(spark, sf).events
    src = str(tmp_path / "src")
    events.repartition(4).write.parquet(src)
    whole = inc.weekly_readings(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", ["event_type"])
    stream = inc.read_files(spark, src, events.schema, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))
    weekly = inc.weekly_readings(stream, "ts", "value", ["event_type"], late="60 days")
    inc.stream_weekly(weekly, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = inc.latest_windows(spark, f"{tmp_path}/out", ["event_type"])
    assert got.select(*whole.columns).exceptAll(whole).count() == 0 and got.count() == whole.count()


def test_landing_stream_restarts_without_doubles(spark, sf, tmp_path):
    events = st.Tables(spark, sf).events
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    events.coalesce(1).write.parquet(src)

    def run(checkpoint):
        landed = inc.read_files(spark, src, events.schema)
        inc.stream_landing(landed, root, f"{tmp_path}/{checkpoint}",
                           lambda b: {"condiciones_observadas": st.conditions_of(b)}).awaitTermination()
        return spark.read.parquet(f"{root}/relacion_condicion_observada").count()

    first = run("cp1")
    assert first == st.conditions_of(events).count()
    assert run("cp1") == first and run("cp2") == first  # a lost checkpoint replays everything
    assert spark.read.parquet(f"{root}/detalle_condicion_estado").count() == first


@pytest.mark.parametrize("files", [1, 4])
def test_landing_stream_does_not_depend_on_batches(spark, sf, tmp_path, files):
    """The severity a key ends with is the worst of all its events, in one batch or in one per file."""
    from airgauge.operators import history as h
    from airgauge.registry import worst_conditions

    events = st.Tables(spark, sf).events
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    events.repartition(files).write.parquet(src)
    landed = inc.read_files(spark, src, events.schema, files_per_batch=1)
    inc.stream_landing(
        landed, root, f"{tmp_path}/cp", lambda b: {"condiciones_observadas": worst_conditions(b, root)}
    ).awaitTermination()
    key = ["punto_nro", "condicion_codigo", "anio", "semana_nro"]
    state = h.current_version(spark.read.parquet(f"{root}/detalle_condicion_estado")).select(h.KEY, "severidad")
    got = spark.read.parquet(f"{root}/relacion_condicion_observada").select(h.KEY, *key).join(state, h.KEY).drop(h.KEY)
    want = st.conditions_of(events).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_streams_take_a_folder_or_a_file(spark, sf, tmp_path):
    events = st.Tables(spark, sf).events
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for n, path in enumerate((f"{tmp_path}/events.parquet", f"{sf}/events.parquet")):
        stream = inc.read_table(spark, path, events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
        inc.stream_weekly(inc.weekly_readings(stream, "ts", "value", ["event_type"]), f"{tmp_path}/o{n}", f"{tmp_path}/c{n}").awaitTermination()
        assert inc.latest_windows(spark, f"{tmp_path}/o{n}", ["event_type"]).agg(F.sum("n")).first()[0] == events.count()


def test_one_hot_key_stays_whole(spark):
    """A point with a third of all rows: same answers, and aggregates combine before the shuffle."""
    n = 30000
    data = spark.range(n).select(
        F.lit("P").alias("planta_canon"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("punto_nro"),
        F.lit("x").alias("nombre_punto"), F.lit(2025).alias("anio"), (F.col("id") % 52 + 1).cast("int").alias("semana_nro"),
        (F.col("id") % 50 / 10.0).cast("double").alias("concentracion_mg_m3"), F.lit("medido").alias("estado"),
    )
    spans = q.high_span(data)
    assert spans.agg(F.sum("n_eventos")).first()[0] == data.where("concentracion_mg_m3 >= 2.5").count()
    plan = spans._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_plans_push_down_and_avoid_products(spark, sf):
    from airgauge.registry import runnable

    queries = runnable()
    for name in ("question_p13_high_window", "question_p24_not_maintained_on_time", "report_concentracion_anual",
                 "mart_causa_raiz", "dense_measurements", "nearest_vectors"):
        plan = queries[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    scan = [x for x in queries["question_p13_high_window"](spark, sf)._jdf.queryExecution().executedPlan().toString().split("\n")
            if "FileScan" in x and "lineitem" in x]
    assert scan and all("l_extendedprice" not in x for x in scan)


def test_each_token_is_made_once(spark):
    """A person's token serves the text, the JSON and the list of tokens."""
    rows = spark.createDataFrame([(1, "Ana", None), (2, None, "Eva"), (3, None, None)], "k int, a string, b string")
    made = ch.tokenize_pii(rows, ["a", "b"], "sal")
    seen = made.select("k", F.concat_ws("|", "a", "b").alias("t"), F.size("pii_tokens").alias("n"), F.col("pii_tokens")["a"].alias("pa"))
    assert seen._jdf.queryExecution().optimizedPlan().toString().count("sha2(") <= 2
    token = {x: "PII_" + hashlib.sha256(f"sal{x}".encode()).hexdigest() for x in ("Ana", "Eva")}
    assert made.columns == ["k", "a", "b", "pii_tokens"]
    assert sorted(map(tuple, seen.collect())) == [(1, token["Ana"], 1, token["Ana"]), (2, token["Eva"], 1, None), (3, "", 0, None)]


def test_people_meet_measurements_where_these_lie(spark):
    """People are sorted once by measurement, and measurements that lie by point and week are not moved to them."""
    week = "punto_nro bigint, anio int, semana_nro int"
    some = [(1, 2020, 5), (1, 2020, 6), (2, 2020, 5), (None, 2020, 5), (1, 2020, 5)]
    cells = spark.createDataFrame(some, week).groupBy("punto_nro", "anio", "semana_nro").agg(F.count(F.lit(1)).cast("double").alias("concentracion_mg_m3"))
    texts = ("fecha_medicion", "hora_inicio", "hora_termino", "estado", "motivo_no_medicion")
    key = "dni string, tipo_dni string, dni_pais_emisor string"
    people = [(1, 2020, 5, "operador", "a"), (1, 2020, 5, "operador", "b"), (1, 2020, 5, "tecnico", "b"), (2, 2020, 5, "tecnico", "z"), (None, 2020, 5, "tecnico", "a")]
    made = {
        "medicion": cells.select("*", *[F.lit(None).cast("string").alias(x) for x in texts]),
        "punto": spark.createDataFrame([(1, "uno", "P"), (2, "dos", "Q"), (2, "otra", "Q")], "punto_nro bigint, nombre_punto string, planta_canon string"),
        "semana": spark.createDataFrame([(2020, 5, "x", "y")], "anio int, semana_nro int, a string, b string").select(
            "anio", "semana_nro", F.lit("2020-01-27").cast("date").alias("fecha_inicio_semana"), F.lit("2020-02-02").cast("date").alias("fecha_fin_semana")),
        "medicion_persona": spark.createDataFrame([(*x[:4], x[4], "RUN", "CL") for x in people], f"{week}, rol string, {key}"),
        "persona": spark.createDataFrame([("a", "RUN", "CL", "Ana"), ("b", "RUN", "CL", "Berta")], f"{key}, nombre_completo string"),
    }
    f = Frames({name: lambda name=name: made[name] for name in SUBJECTS})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = measurement_detail(f).select("punto_nro", "semana_nro", "nombre_punto", "concentracion_mg_m3", "operador_panel", "tecnico_higiene")
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, rows), key=str) == sorted([
        (1, 5, "uno", 2.0, "Berta", "Berta"), (1, 6, "uno", 1.0, None, None), (2, 5, "dos", 1.0, None, None), (2, 5, "otra", 1.0, None, None),
        (None, 5, None, 1.0, None, None),
    ], key=str)
    key_of_a_cell = r"punto_nro#\d+L?, anio#\d+L?, semana_nro#\d+L?"
    assert len(re.findall(rf"hashpartitioning\({key_of_a_cell}", plan)) == 2
    assert len(re.findall(r"Sort \[punto_nro#\d+L? ASC NULLS FIRST, anio", plan)) == 2
