from pyspark.sql import functions as F

from airgauge import standin as st
from airgauge.operators import history as h
from airgauge.plans import vault
from airgauge.plans.catalog import HUBS, LINKS, SATELLITES
from airgauge.plans.marts import MARTS
from airgauge.session import shared_dir


def ts(n):
    return F.lit(f"2026-01-{n:02d}").cast("timestamp")


def rows(spark, data):
    return spark.createDataFrame(data, "k string, a string, b double")


def load(spark, stored, data, day):
    new = h.new_satellite_rows(rows(spark, data), ["k"], ["a", "b"], stored, ts(day), "t")
    return new if stored is None else stored.unionByName(new)


def test_satellite_versions(spark):
    s = load(spark, None, [("x", "A", 1.0), ("y", "A", 1.0), ("x", "A", 1.0)], 1)
    assert s.count() == 2  # copies collapse
    s = load(spark, s, [("x", "B", 1.0), ("y", "A", 1.0)], 2)
    s = load(spark, s, [("x", "A", 1.0), ("z", "A", None)], 3)  # x returns to an older content
    assert load(spark, s, [("x", "A", 1.0), ("z", "A", None)], 4).count() == s.count()
    closed = h.with_valid_to(s)
    x = h.current_version(s).count()
    assert x == 3
    by_key = closed.groupBy(h.KEY).agg(
        F.count("*").alias("n"), F.sum(F.col("valid_to").isNull().cast("int")).alias("abiertas")
    )
    assert sorted(r.n for r in by_key.collect()) == [1, 1, 3]
    assert all(r.abiertas == 1 for r in by_key.collect())
    assert h.as_of(s, ts(2)).where("a = 'B'").count() == 1
    assert h.as_of(s, ts(3)).where("a = 'B'").count() == 0


def test_conflicting_rows_of_one_batch_are_settled_alike(spark):
    data = [("x", "A", 1.0), ("x", "B", 2.0), ("x", None, None)]
    picks = {tuple(load(spark, None, d, 1).select("a", "b").first()) for d in (data, data[::-1], data[1:] + data[:1])}
    assert len(picks) == 1


def test_hub_and_link_take_only_new_keys(spark):
    one = spark.createDataFrame([(1, "p"), (1, "p"), (2, None)], "n int, m string")
    two = spark.createDataFrame([(2, None), (3, "q")], "n int, m string")
    hub = h.new_hub_rows([one, two], ["n"], None, ts(1), "s")
    assert hub.count() == 3 and h.new_hub_rows([two], ["n"], hub, ts(2), "s").count() == 0
    link = h.new_link_rows(one, ["n", "m"], {"n_hk": ["n"], "m_hk": ["m"]}, None, ts(1), "s", ["m"])
    assert [(r.n, r.m) for r in link.collect()] == [(1, "p")]
    assert h.new_link_rows(two, ["n", "m"], {"n_hk": ["n"], "m_hk": ["m"]}, link, ts(2), "s", ["m"]).count() == 1


def test_roles(spark):
    fact = spark.createDataFrame([(1, " ANA ", "luis"), (2, None, "nadie")], "p int, o string, t string")
    alias = spark.createDataFrame([("ana", "1", "R", "C"), ("Ana", "1", "R", "C"), ("Luis", "2", "R", "C")],
                                  "alias_fuente string, dni string, tipo_dni string, dni_pais_emisor string")
    out = h.resolve_roles(fact, alias, ["p"], {"operador": "o", "tecnico": "t"})
    assert sorted((r.p, r.rol, r.dni) for r in out.collect()) == [(1, "operador", "1"), (1, "tecnico", "2")]


def test_snapshot(spark):
    def src(data):
        return spark.createDataFrame(data, "k string, a string")

    s1 = h.snapshot_check(src([("x", "1"), ("y", "1")]), None, ["k"], ts(1))
    s2 = h.snapshot_check(src([("x", "2"), ("z", None)]), s1, ["k"], ts(2))
    s3 = h.snapshot_check(src([("x", "2"), ("z", None)]), s2, ["k"], ts(3))
    state = sorted((r.k, r.a or "-", r.snap_valid_to is None) for r in s3.collect())
    assert state == [("x", "1", False), ("x", "2", True), ("y", "1", True), ("z", "-", True)]
    assert s3.select("scd_id").distinct().count() == 4
    assert sorted(r.k for r in h.snapshot_current(s3).collect()) == ["x", "y", "z"]
    # a check on the key alone never opens a version
    only_key = h.snapshot_check(src([("x", "9")]), s1, ["k"], ts(2), ["k"])
    assert only_key.count() == 2


def test_snapshot_of_a_sheet_by_label(spark):
    one = spark.createDataFrame([("Semanas", "1"), ("Punto A", "2.0")], "etiqueta string, column01 string")
    two = spark.createDataFrame([("Semanas", "1"), ("Punto A", "2.5")], "etiqueta string, column01 string")
    s = h.snapshot_check(two, h.snapshot_check(one, None, ["etiqueta"], ts(1)), ["etiqueta"], ts(2))
    assert s.count() == 3


def test_marts_from_history_equal_marts_from_sources(spark, sf):
    root = shared_dir(spark, "historia")
    sources = st.history_sources(spark, sf)
    vault.load_history(spark, root, sources, ts(1))
    counts = {x.name: spark.read.parquet(f"{root}/{x.name}").count() for x in (*HUBS, *LINKS, *SATELLITES)}
    vault.load_history(spark, root, sources, ts(2))
    again = {x.name: spark.read.parquet(f"{root}/{x.name}").count() for x in (*HUBS, *LINKS, *SATELLITES)}
    assert counts == again
    stored, direct = vault.frames_from_history(spark, root), st.frames(spark, sf)
    for name in ("promedios_planta", "detalle_medicion", "causa_raiz", "no_ejecucion_ot", "ejecucion_ot", "ot_en_curso"):
        a, b = MARTS[name](stored), MARTS[name](direct)
        assert a.count() == b.count(), name
        assert a.select(*b.columns).exceptAll(b).count() == 0, name


def test_order_marts_keep_their_grain(spark, sf):
    m = st.marts(spark, sf)
    for name in ("no_ejecucion_ot", "ejecucion_ot", "ot_en_curso"):
        key = ["orden_nro", "ubicacion_tecnica", "anio", "semana_nro", "punto_nro"]
        assert m[name].count() == m[name].select(*key).distinct().count()
    assert m["ot_en_curso"].where("cumpl_prog is null").count() > 0


def test_snapshot_keeps_one_open_row_without_a_key(spark):
    src = spark.createDataFrame([(None, "a"), ("k", "b")], "clave string, valor string")
    at = [F.lit(f"2026-01-0{d}").cast("timestamp") for d in (1, 2, 3)]
    one = h.snapshot_check(src, None, ["clave"], at[0])
    two = h.snapshot_check(src, one, ["clave"], at[1])
    assert two.count() == 2 and h.snapshot_current(two).count() == 2
    changed = spark.createDataFrame([(None, "c"), ("k", "b")], src.schema)
    three = h.snapshot_check(changed, two, ["clave"], at[2])
    assert three.count() == 3 and {tuple(r) for r in h.snapshot_current(three).collect()} == {(None, "c"), ("k", "b")}
