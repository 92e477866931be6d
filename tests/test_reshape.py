from datetime import date

from pyspark.sql import functions as F

from airgauge import registry, standin
from airgauge.functions import bands, columns as c
from airgauge.operators import reshape as rs
from airgauge.operators.calendar import densify, iso_calendar
from airgauge.operators.orders import OrderSheet, ORDER_COLUMNS, normalize_orders, resolve_machine
from airgauge.plans import ingest


def one(spark, expr):
    return spark.range(1).select(expr).first()[0]


def test_numbers_from_text(spark):
    rows = [("3.7", 4), ("1.0", 1), (" 12 ", 12), ("1d", None), ("NaN", None), ("", None), (None, None), ("99999999999", None),
            ("-2.5", -3)]
    df = spark.createDataFrame([(r[0],) for r in rows], "t string").select(c.to_int(F.col("t")))
    assert [r[0] for r in df.collect()] == [r[1] for r in rows]


def test_keys(spark):
    df = spark.createDataFrame([(" ab ", 1.5, None), ("", None, "x"), (None, 1e-7, "-")], "k string, d double, s string")
    assert [r[0] for r in df.select(c.clean_key(F.col("k"))).collect()] == ["AB", "-1", "-1"]
    import hashlib

    got = [r[0] for r in df.select(c.record_key(df, ["k", "d", "s"])).collect()]
    token = c.NULL_TOKEN
    want = [f" ab -1.500000-{token}", f"-{token}-x", f"{token}-7555786372591432p-76--"]
    assert got == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_iso_weeks_match_the_calendar(spark):
    days = spark.sql("select explode(sequence(date'1994-12-20', date'2026-01-10')) d")
    bad = days.select("d", c.iso_year(F.col("d")).alias("y"), c.iso_week(F.col("d")).alias("w")).collect()
    assert all((r.y, r.w) == tuple(r.d.isocalendar()[:2]) for r in bad)


def test_weeks_outside_the_calendar_stay(spark, tmp_path):
    """A reading of 1985 and an order of 2041: no week of the data is missing from the calendar, the satellite's source and the ingest."""
    for name, schema in standin.TABLE_SCHEMAS.items():
        day = {"lineitem": ("l_shipdate", "1985-07-03"), "orders": ("o_orderdate", "2041-03-08")}.get(name)
        df = spark.createDataFrame([], schema)
        if day:
            one_row = spark.range(1).select(*[F.lit(day[1] if f.name == day[0] else None).cast(f.dataType).alias(f.name) for f in df.schema])
            df = df.unionByName(one_row)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    fixed = iso_calendar(spark, *standin.CALENDAR)
    rows = standin.history_sources(spark, str(tmp_path))["semanas"]
    assert rows.count() == fixed.count() + 2 and fixed.exceptAll(rows).count() == 0
    more = {(r.anio, r.semana_nro): r.fecha_inicio_semana for r in rows.join(fixed, fixed.columns, "left_anti").collect()}
    assert more == {(1985, 27): date(1985, 7, 1), (2041, 10): date(2041, 3, 4)}
    got = registry.week_calendar(spark, str(tmp_path)).collect()
    assert [(r.fecha_inicio_semana, r.lecturas) for r in got] == [(date(1985, 7, 1), 1)]
    weeks = spark.createDataFrame([(2019, 52, 1), (2041, 1, 1), (2030, 5, 1), (2041, 54, 1), (None, None, 1)], "anio int, semana_nro int, punto_nro int")
    out = ingest.sources_of(spark, "", weeks.where("anio < 2030"), weeks.where("anio >= 2030 or anio is null"))["semanas"]
    late = out.where("anio > 2040 or anio < 2020").select("anio", "semana_nro", "fecha_inicio_semana").collect()
    assert {tuple(r) for r in late} == {(2019, 52, date(2019, 12, 23)), (2041, 1, date(2040, 12, 31))} | {
        tuple(r) for r in iso_calendar(spark, *ingest.CALENDAR).where("anio > 2040").select("anio", "semana_nro", "fecha_inicio_semana").collect()
    }


def test_calendar_rows(spark):
    rows = {(r.anio, r.semana_nro): r for r in iso_calendar(spark, date(2025, 12, 29), date(2026, 5, 10)).collect()}
    assert len(rows) == 19
    first, fifth, ninth, w14, w18 = (rows[2026, w] for w in (1, 5, 9, 14, 18))
    assert (first.fecha_inicio_semana, first.fecha_fin_semana, first.mes) == (date(2025, 12, 29), date(2026, 1, 4), 1)
    assert (fifth.mes, ninth.mes, w14.trimestre, w14.mes, w18.mes) == (2, 3, 2, 4, 5)


def test_local_time(spark):
    t = F.lit("2026-05-27 10:13:57").cast("timestamp_ntz")
    assert one(spark, c.local_to_utc(t, "America/Santiago")) == "2026-05-27T14:13:57.000Z"


def test_equipment_codes(spark):
    for code, kind, family in (
        ("A-CS-CST-SCP-HDP01-MEC", "HDP", "abatidor_polvo"),
        ("A-SVE-VEX", "VEX", "renovacion_aire"),
        ("A-XXX-VEX", None, None),
    ):
        assert one(spark, c.equipment_type(F.lit(code))) == kind
        assert one(spark, c.equipment_family(F.lit(code))) == family


def test_bands(spark):
    values = [(-1.0, None), (0.0, "bajo"), (0.25, "controlado"), (0.5, "alerta"), (2.49, "alerta"), (2.5, "peligroso"),
              (5.0, "critico"), (None, None)]
    df = spark.createDataFrame([(v[0],) for v in values], "v double")
    assert [r[0] for r in df.select(bands.band_of(F.col("v"))).collect()] == [v[1] for v in values]
    assert bands.internal_limit() == 2.5
    assert one(spark, bands.kpi_severity(F.lit(1.995), "concentracion-maxima-ultima-jornada")) == "ok"
    assert one(spark, bands.kpi_severity(F.lit(2.995), "concentracion-maxima-ultima-jornada")) == "warning"


SHEET = [
    ("Lugar Monitoreo", "x", "x", "x"),
    (" Semanas ", "51", "1", None),
    ("Fecha medicion", "2025-12-18", "2026-01-02", "2026-01-09"),
    ("Operador Panel", " Ana ", "", None),
    ("Técnico Higiene", "Luis", None, None),
    ("Hora inicio", "08:00", "09:00", "10:00"),
    ("Hora termino", "09:00", None, None),
    ("Punto  A (1)", "0", "99.99", "5"),
    ("punto b", "-1", "100", "1"),
    ("Punto C", "texto", " 2.5 ", None),
    ("Tratamiento tph", "1500", "1600", "1700"),
    ("", "1", "1", "1"),
]


def sheet(spark):
    df = spark.createDataFrame(SHEET, "etiqueta string, column51 string, column53 string, column54 string")
    return df.withColumn("planta", F.lit("P"))


def test_melt_sheet(spark):
    got = {
        (r.punto_evaluacion, r.anio, r.semana_nro): r
        for r in rs.melt_sheet(sheet(spark)).collect()
    }
    # column54 has no week number and is dropped
    assert set(got) == {("Punto  A (1)", 2025, 51), ("Punto  A (1)", 2026, 1), ("Punto C", 2026, 1)}
    a = got["Punto  A (1)", 2025, 51]
    assert (a.concentracion_mg_m3, a.operador_alias, a.tecnico_alias, a.hora_termino) == (0.0, "Ana", "Luis", "09:00")
    assert a.fecha_medicion == date(2025, 12, 18)
    b = got["Punto  A (1)", 2026, 1]
    assert (b.operador_alias, b.hora_termino) == (None, None)


def test_unfilled_cells_are_the_rest_of_the_sheet(spark):
    """Every cell of a point's row in a column with a week is either measured or unfilled; header rows are neither."""
    points = {label.strip() for label, *_ in SHEET} & {r.punto_evaluacion for r in rs.unfilled_cells(sheet(spark)).collect()}
    empty = {(r.punto_evaluacion, r.anio, r.semana_nro) for r in rs.unfilled_cells(sheet(spark)).collect()}
    full = {(r.punto_evaluacion, r.anio, r.semana_nro) for r in rs.melt_sheet(sheet(spark)).collect()}
    assert ("Punto C", 2025, 51) in empty and not empty & full
    assert all({(p, 2025, 51), (p, 2026, 1)} <= empty | full for p in points)
    assert not any(p.startswith(("Semana", "Fecha", "Hora", "Operador")) for p, *_ in empty)


def test_parts_of_a_melt_agree_with_the_whole(spark):
    long = rs.unpivot_wide(sheet(spark), ["planta", "etiqueta"])
    joined = rs.value_rows(long, ["planta"]).join(rs.header_rows(long, ["planta"]), ["planta", rs.POSITION])
    assert joined.count() == rs.melt_sheet(sheet(spark)).count()
    assert rs.pivot_metadata(long, ["planta"]).count() == 3


def test_union_of_sheets_that_grew(spark):
    a = sheet(spark)
    b = a.withColumn("column55", F.lit("1"))
    assert rs.week_columns(rs.union_sheets([a, b])) == ["column51", "column53", "column54", "column55"]


def test_normalized_join(spark):
    left = spark.createDataFrame([("  Correa   M3 ",), ("otra",)], "a string")
    right = spark.createDataFrame([("correa m3", 25)], "b string, n int")
    assert sorted(rs.join_normalized(left, right, "a", "b").collect(), key=str) == [("  Correa   M3 ", 25), ("otra", None)]


def test_densify(spark):
    points = spark.createDataFrame([(1,), (2,)], "punto_nro int")
    rows = [(1, 2026, 1, 2.0), (7, 2026, 1, 3.0), (1, 2026, 30, 4.0)]
    fact = spark.createDataFrame(rows, "punto_nro int, anio int, semana_nro int, concentracion_mg_m3 double")
    out = densify(fact, points, date(2025, 12, 29), date(2026, 1, 18)).collect()
    # facts of a point or a week outside the grid stay
    assert {(r.punto_nro, r.semana_nro) for r in out if r.trimestre is None} == {(7, 1), (1, 30)}
    out = [r for r in out if r.trimestre is not None]
    assert len(out) == 6
    assert sorted((r.punto_nro, r.semana_nro, r.estado, r.motivo_no_medicion) for r in out if r.punto_nro == 1) == [
        (1, 1, "medido", None),
        (1, 2, "no_medido", "sin_registro"),
        (1, 3, "no_medido", "sin_registro"),
    ]


DAYS = {"2026-05-18 00:00:00": date(2026, 5, 18), "2026-05-19 00:00:00": date(2026, 5, 19)}


def test_normalize_orders(spark):
    names = list(ORDER_COLUMNS.values())
    base = dict.fromkeys([*names, *DAYS])
    rows = [
        {**base, "Orden": " ab1 ", "CumplProg": "1.0", " PersonalProg": "3.0", "2026-05-19 00:00:00": "4"},
        {**base, "Orden": "b2", "CumplProg": "0", "HorasHombreProg.": "1d", "Denominación": "  "},
        {**base, "Orden": "c3"},
        {**base, "Orden": "   "},
        {**base},
    ]
    schema = ", ".join(f"`{n}` string" for n in base)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    out = {r.orden_nro: r for r in normalize_orders(df, OrderSheet(DAYS, 2026, 19)).collect()}
    assert set(out) == {"AB1", "B2", "C3"}
    done, not_done, open_ = out["AB1"], out["B2"], out["C3"]
    assert (done.cumpl_prog, done.personal_prog, done.inicio_programado) == (1, 3, date(2026, 5, 5))
    assert (done.dia_ejecutado, done.motivo_no_ejecucion) == (date(2026, 5, 5), None)
    assert (not_done.hh_planificadas, not_done.equipo_denom, not_done.dia_ejecutado) == (None, None, None)
    assert not_done.inicio_programado == date(2026, 5, 4) and not_done.fecha_reprogramacion == date(2026, 5, 11)
    assert not_done.motivo_no_ejecucion is not None and not_done.peso_motivo in (0.9, 0.7, 0.5, 0.6)
    assert (open_.cumpl_prog, open_.peso_motivo) == (None, None)


def test_ambiguous_machine_names(spark):
    orders = spark.createDataFrame([("1", "Equipo  X", "P"), ("2", "equipo y", "P"), ("3", "nadie", "P")],
                                   "orden_nro string, equipo_denom string, planta_canon string")
    catalog = spark.createDataFrame([("U1", "equipo x", "P"), ("U2", "EQUIPO X", "Q"), ("U3", "Equipo Y", "P")],
                                    "ubicacion_tecnica string, equipo_denom string, planta_canon string")
    by_name = {r.orden_nro: r for r in resolve_machine(orders.drop("planta_canon"), catalog).collect()}
    assert [(by_name[k].ubicacion_tecnica, by_name[k].nombre_ambiguo) for k in "123"] == [
        (None, True), ("U3", False), (None, False)
    ]
    with_plant = {r.orden_nro: r for r in resolve_machine(orders, catalog, also_on=["planta_canon"]).collect()}
    assert with_plant["1"].ubicacion_tecnica == "U1" and len(with_plant) == 3
