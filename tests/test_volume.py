"""What loads shuffle and store: digests travel as bytes or not at all, and rows that lie by their key stay there."""

import re
from datetime import date, datetime

from pyspark.sql import functions as F

from airgauge import registry
from airgauge import standin as st
from airgauge.functions import columns as c
from airgauge.operators import bucketed as b
from airgauge.operators import calendar as cal
from airgauge.operators import history as h
from airgauge.plans import vault
from airgauge.plans.catalog import LINK, SATELLITE
from airgauge.session import kept, shared_dir


def now():
    return F.lit(datetime(2024, 1, 1))


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_of_cells_are_grouped_where_the_cells_lie(spark, sf):
    spec = SATELLITE["detalle_medicion"]
    plan = physical(h.hash_rows(st.measurements(st.Tables(spark, sf)), spec.key, spec.attributes))
    assert plan.count("Exchange hashpartitioning") == 1


def test_key_rows_keep_the_greatest_content_of_each_key(spark):
    rows = [(1, None, "a"), (1, None, "b"), (1, None, "b"), (None, 2, "c"), (1, -2, "d"), (11, -2, None)]
    df = spark.createDataFrame(rows, "k bigint, w int, v string")
    for frame, key in ((df, ["k", "w"]), (df.withColumns({"k": F.col("k").cast("string")}), ["k", "w"])):
        got = {(r[h.KEY], r[h.CONTENT], r.v) for r in h.hash_rows(frame, key, ["v"]).collect()}
        every = frame.select(c.record_key(frame, key).alias("k"), c.content_hash(frame, ["v"]).alias("c"), "v").collect()
        want = {max((r.k, r.c, r.v) for r in every if r.k == one) for one in {r.k for r in every}}
        assert got == want
    # texts that agree are one key, whatever columns they come from
    same = spark.createDataFrame([("a-b", "c", 1), ("a", "b-c", 2)], "k string, w string, v int")
    assert h.hash_rows(same, ["k", "w"], ["v"]).count() == 1


def test_link_rows_make_member_hashes_of_what_is_left(spark, sf):
    spec = LINK["relacion_medicion_persona"]
    plan = physical(registry.link_query(spec.name)(spark, sf))
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(huella_registro" in line]
    assert len(shuffled) == 2
    # below the anti-join no member's hash is made: md5 is of the key alone
    below = plan[plan.index("LeftAnti") :]
    assert not any(re.search(rf"AS {m}#", below[: below.rindex("Exchange hashpartitioning(huella_registro")]) for m in spec.members)


def test_a_later_load_of_links_is_shuffled_once_and_the_first_is_made_once(spark, sf):
    spec = LINK["relacion_medicion_persona"]
    plan = physical(registry.link_query(spec.name)(spark, sf))
    placed = [line for line in plan.splitlines() if "Exchange hashpartitioning(huella_registro" in line and "REPARTITION_BY_COL" in line]
    assert len(placed) == 1  # the later load's rows, which are looked through for copies where their digests put them
    assert "Expand" not in plan and not re.search(r"isnotnull\((unhex|huella|md5)", plan)


def test_link_rows_of_a_later_load_are_those_whose_key_is_not_stored(spark):
    kinds = "a int, t string, u string"
    first = [(1, "x", None), (1, "x", "y"), (None, "x-y", "z")]
    later = [*first, (1, "x", None), (2, "x", None), (2, "x", None), (None, "x", "y-z"), (None, None, None)]
    for many in (True, False):
        made = lambda rows, stored: h.new_link_rows(spark.createDataFrame(rows, kinds), ["a", "t", "u"], {"a_hk": ["a"]}, stored, now(), "s", many=many)  # noqa: B023, E731
        stored = made(first, None)
        # texts that agree with a stored key's are that key, whatever columns they come from
        assert sorted(map(str, made(later, stored).select("a", "t", "u").collect())) == ["Row(a=2, t='x', u=None)", "Row(a=None, t=None, u=None)"]
        assert made(later, stored).columns == stored.columns


def test_a_repeated_load_of_links_adds_nothing_and_holds_what_the_plan_gives(spark):
    path = f"{shared_dir(spark, 'volumen')}/relacion_medicion"
    spec = LINK["relacion_medicion"]
    src = spark.createDataFrame([(p, 2020, w) for p in (1, 2, None) for w in (1, 14, 40, None)] * 2, "punto_nro bigint, anio int, semana_nro int")
    made = vault.link_rows(spec.name, {spec.source: src}, None, now())
    for _ in range(3):
        vault.append_keys(spec, made, path)
    stored = b.stored_rows(spark, path).drop(b.BUCKET)
    assert sorted(map(str, stored.select(*made.columns).collect())) == sorted(map(str, made.collect()))


def test_a_repeated_load_of_versions_adds_those_that_changed(spark):
    path = f"{shared_dir(spark, 'volumen')}/detalle_medicion"
    spec = SATELLITE["detalle_medicion"]
    kinds = "punto_nro bigint, anio int, semana_nro int, concentracion_mg_m3 double, fecha_medicion date, hora_inicio string, hora_termino string, estado string, motivo_no_medicion string"
    cell = lambda p, w, v: (p, 2020, w, v, None, "07:00", None, "medido", None)
    for value in (1.5, 1.5, 2.5, 1.5):
        rows = [cell(p, w, value if p == 1 else 9.25) for p in (1, 2, None) for w in (1, 30)]
        vault.append_versions(spec, spark.createDataFrame(rows, kinds), path, now())
    stored = b.stored_rows(spark, path)
    assert sorted(r[0] for r in stored.groupBy(h.KEY).count().select("count").collect()) == [1, 1, 1, 1, 3, 3]
    want = stored.select(c.content_hash(stored, spec.attributes).alias("c"), h.CONTENT, F.length(h.KEY).alias("n")).collect()
    assert all(r.c == r[h.CONTENT] and r.n == 32 for r in want)


def test_cells_and_versions_are_merged_and_not_broadcast_by_the_size_of_their_files(spark):
    cells = spark.range(0, 200_000, 1, 1).select(
        (F.col("id") % 4000).alias("punto_nro"), F.lit(2020).alias("anio"), (F.floor(F.col("id") / 4000) + 1).cast("int").alias("semana_nro")
    )
    fact = kept(cells.withColumn("concentracion_mg_m3", F.lit(1.5)).withColumns({"estado": F.lit("medido"), "motivo_no_medicion": F.lit(None).cast("string")}), "hechos")
    keys = fact.select("punto_nro", "anio", "semana_nro")
    points = spark.range(4000).select(F.col("id").alias("punto_nro"))
    blank = F.col("punto_nro") % 7 == 0
    taken = cal.withdrawn_cells(fact.where(~blank), points, keys.where(blank), keys)
    empty = cal.missing_cells(fact, points, date(2020, 1, 1), date(2020, 12, 20), keys)
    rows = kept(h.key_rows(fact, list(keys.columns), ["estado"]), "filas")
    stored = kept(h.as_versions(h.changed_versions(rows, ["estado"], None), ["estado"], now(), "x"), "versiones")
    changed = h.changed_versions(rows, ["estado"], stored.select(h.KEY, h.CONTENT, h.SEQ))
    for frame, n in ((taken, 28_600), (empty, 4000), (changed, 0)):
        assert "BroadcastHashJoin" not in physical(frame)
        assert frame.count() == n


def test_missing_cells_are_found_by_point_and_week_and_then_described(spark):
    points = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "c", None), (None, "d", "z")], "punto_nro bigint, nombre_punto string, planta string")
    kinds = "punto_nro bigint, anio int, semana_nro int, planta string, nombre_punto string, concentracion_mg_m3 double, estado string, motivo_no_medicion string"
    fact = spark.createDataFrame([(1, 2020, 2, "x", "a", 1.5, "medido", None)], kinds)
    known = spark.createDataFrame([(2, 2020, 3), (1, 2020, 3)], "punto_nro bigint, anio int, semana_nro int")
    out = cal.missing_cells(fact, points, date(2020, 1, 6), date(2020, 1, 20), known)
    # a point that comes twice, or has no number, has its weeks as often as before
    want = [(1, 4, "a"), (1, 4, "b"), (2, 2, "c"), (2, 4, "c"), *[(None, w, "d") for w in (2, 3, 4)]]
    assert sorted(map(str, [(r.punto_nro, r.semana_nro, r.nombre_punto) for r in out.collect()])) == sorted(map(str, want))
    # weeks are made of points that are spread over all tasks
    plan = physical(out)
    assert "REPARTITION_BY_NUM" in plan[plan.index("Generate") :]


def test_a_load_compares_only_buckets_that_hold_other_keys(spark, monkeypatch):
    path, spec = f"{shared_dir(spark, 'volumen')}/relacion_medicion", LINK["relacion_medicion"]
    week = lambda weeks: spark.createDataFrame([(p, 2020, w) for p in range(50) for w in weeks], "punto_nro bigint, anio int, semana_nro int")
    load = lambda weeks: vault.append_keys(spec, vault.link_rows(spec.name, {spec.source: week(weeks)}, None, now()), path)
    load((1, 2, 20))
    compared = []
    monkeypatch.setattr(b, "grown", lambda df: compared.append({r[0] for r in df.select("_semana_nro").distinct().collect()}) or df)
    for weeks in ((1, 2, 20), (1, 2, 3, 20, 40), (1, 2, 3, 20, 40)):
        met = load(weeks)
        assert {"2020-0", "2020-1"} <= set(met.read)
    assert compared == [set(), {1, 2}, set()]  # weeks 1 and 2 share a bucket with week 3, which was new
    stored = b.stored_rows(spark, path)
    assert sorted(r.semana_nro for r in stored.collect()) == sorted([1, 2, 3, 20, 40] * 50) and stored.select(h.KEY).distinct().count() == 250
