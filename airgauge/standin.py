"""The given tables read as this domain: points, weekly cells, orders, people.

Supplier stands for measurement point, generator and control machine; nation for
plant; a line item for a reading; an order for a work order; a customer for a
person; an event for an observed condition. Every frame covers its whole table.

`batch=1` is an earlier state of the same subject, for the history operators:
readings and orders before CUT, readings with their first value, orders not
closed yet. `batch=2` is the full present state.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.functions import columns as c
from airgauge.operators.calendar import iso_calendar, monday, with_weeks_of
from airgauge.operators.history import resolve_roles
from airgauge.operators.orders import OrderSheet, reason_of, weight_of
from airgauge.plans.frames import ROLES, Frames, Lazy
from airgauge.plans.marts import MARTS
from airgauge.session import shared_dir

CUT = date(1998, 1, 5)  # a Monday, so no weekly cell straddles it
CALENDAR = (date(1990, 1, 1), date(2030, 12, 31))
INSPECTED = date(2001, 12, 31)
EVENT_YEAR_SHIFT = 24
POINT_WEEK = ["punto_nro", "anio", "semana_nro"]
PERSON = ["dni", "tipo_dni", "dni_pais_emisor"]


# Columns of the given tables.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The given tables, opened when asked for. Declared columns save a job that reads footers."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_SCHEMAS:
            raise AttributeError(name)
        table = self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.directory}/{name}.parquet")
        setattr(self, name, table)  # its schema is read once
        return table


def weeks(t: Tables) -> DataFrame:
    """The fixed calendar, and every other week of a reading or an order."""
    days = t.lineitem.select(F.col("l_shipdate").cast("date").alias("dia"))
    days = days.unionByName(t.orders.select(F.col("o_orderdate").cast("date").alias("dia")))
    return with_weeks_of(iso_calendar(t.spark, *CALENDAR), days)


def plants(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("planta_canon"),
        F.concat(F.lit("Planta "), "n_name").alias("nombre_planta"),
        F.col("r_name").alias("area"),
        F.concat(F.lit("Sector "), F.col("n_nationkey").cast("string")).alias("sector"),
    )


def _generator(key: Column) -> Column:
    return F.floor(key / 3)


def _component_code(key: Column) -> Column:
    return F.concat(F.lit("MG_"), _generator(key).cast("string"), F.lit("_C"), (key % 5).cast("string"))


def sheet_label(name: Column, key: Column) -> Column:
    """A point's name as a sheet spells it: blanks and case differ from the catalogue."""
    spaced = F.regexp_replace(name, "#", "   #")
    return F.when(key % 2 == 0, F.upper(spaced)).otherwise(F.concat(spaced, F.lit("  ")))


def points(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    number = _generator(key).cast("string")
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ("correa", "harnero", "alimentador", "chancador")]),
        (_generator(key) % 4 + 1).cast("int"),
    )
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("punto_nro"),
        F.concat(F.lit(" "), F.regexp_replace("s_name", "#", " #")).alias("punto_evaluacion"),
        F.col("n_name").alias("planta_canon"),
        F.concat(F.lit("MG_"), number).alias("maquina_gen_codigo"),
        F.concat(F.lit("C"), (key % 5).cast("string")).alias("componente_codigo"),
        F.col("s_name").alias("nombre_punto"),
        F.concat(F.lit("Punto "), "s_name").alias("descripcion_punto"),
        F.when(F.col("s_acctbal") >= 0, "real").otherwise("sintetico").alias("tipo_punto"),
        F.concat(F.lit("Máquina "), number).alias("maquina_gen_nombre"),
        kind.alias("tipo_maquina_gen"),
        F.concat(F.lit("Generadora "), number).alias("descripcion"),
    )


def cells(t: Tables, batch: int = 2) -> DataFrame:
    """One reading per point and week: a partial aggregate over the line items."""
    day = F.col("l_shipdate").cast("date")
    lines = t.lineitem
    if batch == 1:
        lines = lines.where(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))
    value = F.min("l_quantity") if batch == 1 else F.max("l_quantity")
    # grouped by the key of a cell, so that what is grouped or joined by it afterwards finds its rows in place
    grouped = lines.groupBy(F.col("l_suppkey").alias("punto_nro"), c.iso_year(day).alias("anio"), c.iso_week(day).alias("semana_nro")).agg(
        value.alias("_valor"),
        F.max(day).alias("fecha_medicion"),
        F.min("l_linenumber").alias("_primera"),
        F.max("l_linenumber").alias("_ultima"),
        F.min("l_orderkey").alias("primera_orden"),
        F.max("l_orderkey").alias("ultima_orden"),
    )
    return grouped.select(
        *POINT_WEEK,
        (F.col("_valor") / 10).alias("concentracion_mg_m3"),
        "fecha_medicion",
        F.format_string("%02d:00", F.col("_primera") + 6).alias("hora_inicio"),
        F.format_string("%02d:30", F.col("_ultima") + 12).alias("hora_termino"),
        "primera_orden",
        "ultima_orden",
    )


def measurements(t: Tables, batch: int = 2) -> DataFrame:
    """Long measurements joined to the point catalogue, without people."""
    value = F.col("concentracion_mg_m3")
    return (
        cells(t, batch)
        .drop("primera_orden", "ultima_orden")
        .join(points(t), "punto_nro", "left")
        .select(
            "*",
            F.col("planta_canon").alias("planta"),
            c.concat_code(F.col("maquina_gen_codigo"), F.col("componente_codigo")).alias("componente_codigo_full"),
            c.measured_state(value).alias("estado"),
            c.unmeasured_reason(value).alias("motivo_no_medicion"),
        )
    )


def spelled_alias(customer: Column, order: Column) -> Column:
    """A person's name as a sheet spells it: one of two aliases, with case and blanks off."""
    full = F.format_string("  CUSTOMER#%09d ", customer)
    return F.when(order % 2 == 0, full).otherwise(F.concat(F.lit("P-"), customer.cast("string")))


def cells_with_people(t: Tables, batch: int = 2) -> DataFrame:
    """Cells with the spelled names of who placed their first and last order."""
    first = t.orders.select(F.col("o_orderkey").alias("primera_orden"), F.col("o_custkey").alias("_op"))
    last = t.orders.select(F.col("o_orderkey").alias("ultima_orden"), F.col("o_custkey").alias("_te"))
    return (
        cells(t, batch)
        .join(first, "primera_orden", "left")
        .join(last, "ultima_orden", "left")
        .withColumn("operador_alias", spelled_alias(F.col("_op"), F.col("primera_orden")))
        .withColumn("tecnico_alias", spelled_alias(F.col("_te"), F.col("ultima_orden")))
        .drop("_op", "_te")
    )


def _person_columns() -> list[Column]:
    return [
        F.col("c_custkey").cast("string").alias("dni"),
        F.lit("RUN").alias("tipo_dni"),
        F.concat(F.lit("PAIS_"), F.col("c_nationkey").cast("string")).alias("dni_pais_emisor"),
    ]


def persons(t: Tables) -> DataFrame:
    """One row per person."""
    kind = F.element_at(
        F.array(*[F.lit(x) for x in ("tecnico", "operador", "contratista")]), (F.col("c_custkey") % 3 + 1).cast("int")
    )
    return t.customer.select(
        *_person_columns(),
        F.concat_ws(" ", "c_name", "c_mktsegment").alias("nombre_completo"),
        kind.alias("tipo_persona"),
    )


def people(t: Tables) -> DataFrame:
    """Alias catalogue: two aliases per person, a plain number and the padded full name."""
    number = F.col("dni").cast("bigint")
    aliases = F.array(F.format_string("Customer#%09d", number), F.concat(F.lit("p-"), F.col("dni")))
    return persons(t).select(F.explode(aliases).alias("alias_fuente"), "*")


def measurement_people(t: Tables, batch: int = 2) -> DataFrame:
    return resolve_roles(cells_with_people(t, batch), people(t), POINT_WEEK, ROLES)


def machines(t: Tables) -> DataFrame:
    """Control machines; type and family are read from the code."""
    key = F.col("s_suppkey")
    family = F.when(key % 4 < 2, "SCP").otherwise("SVE")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("HDP", "CDS", "VEX", "VIN")]), (key % 4 + 1).cast("int"))
    code = F.concat(
        F.format_string("PLT-%02d-", F.col("s_nationkey")), family, F.lit("-"), kind, F.format_string("%07d-MEC", key)
    )
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return (
        t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("maquina_nro"),
            code.alias("ubicacion_tecnica"),
            F.concat(F.lit("Equipo "), "s_name").alias("equipo_denom"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("planta_canon"),
        )
        .withColumn("tipo_equipo", c.equipment_type(F.col("ubicacion_tecnica")))
        .withColumn("familia_equipo", c.equipment_family(F.col("ubicacion_tecnica")))
    )


def coverage(t: Tables) -> DataFrame:
    """Machine m covers the points m, m+1 and m+7 that exist: three rows a machine at most."""
    offered = machines(t).select(
        "ubicacion_tecnica",
        F.explode(F.array(*[F.col("maquina_nro") + i for i in (0, 1, 7)])).alias("punto_nro"),
    )
    existing = t.supplier.select(F.col("s_suppkey").alias("punto_nro"))
    return offered.join(existing, "punto_nro", "left_semi").select("punto_nro", "ubicacion_tecnica")


def order_lines(t: Tables) -> DataFrame:
    """Line items of each order, added up before they meet the orders."""
    real = (F.col("l_quantity") * (1 + F.col("l_tax"))).cast("decimal(18,4)")
    return t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("maquina_nro"),
        F.count(F.lit(1)).alias("lineas"),
        F.max("l_linenumber").alias("mayor_linea"),
        F.sum("l_linenumber").alias("suma_linea"),
        F.sum("l_quantity").alias("cantidad"),
        F.sum(real).cast("double").alias("cantidad_real"),
        F.max("l_discount").alias("mayor_descuento"),
    )


def operations(t: Tables, batch: int = 2) -> DataFrame:
    """The operations of each order: an order has several, and some of one order are alike."""
    rows = t.lineitem
    if batch == 1:
        rows = rows.where(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))
    return rows.select(
        F.col("l_orderkey").cast("string").alias("orden_nro"),
        F.col("l_returnflag").alias("estado"),
        (F.floor(F.col("l_quantity") / 10) * 10.0).cast("double").alias("hh"),
    )


# The events' own first day, the first day of the readings, and the stretch that maps one span to the other.
EVENTS_START, READINGS_START, EVENT_STRETCH = "2024-01-01", "1995-01-01", 80


def condition_versions(t: Tables) -> DataFrame:
    """What was known of a point from a moment on: each event holds until the next one, over the years of the readings."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lit(EVENTS_START).cast("timestamp"))
    since = F.timestamp_seconds(F.unix_seconds(F.lit(READINGS_START).cast("timestamp")) + seconds * EVENT_STRETCH)
    return t.events.select(F.col("user_id").alias("punto_nro"), since.alias("desde"), "event_id", F.col("event_type").alias("condicion"), F.col("value").alias("medida"))


def component_tree(t: Tables) -> DataFrame:
    """Components in a tree as deep as their number's logarithm; two of them are each other's parents."""
    key = F.col("s_suppkey")
    parent = F.when(key == 3, 7).when(key > 0, F.floor(key / 2))
    code = lambda c: F.concat(F.lit("C"), c.cast("string"))
    return t.supplier.select(code(key).alias("componente_codigo"), code(parent).alias("componente_padre_codigo"))


def week_header(t: Tables, weeks: int = 156) -> DataFrame:
    """The week row of one wide sheet per plant and `weeks` weeks, and the year of its first filled column."""
    place = points(t).select("punto_nro", F.col("planta_canon").alias("planta"))
    week = F.floor(F.datediff(monday(F.col("fecha_medicion")), F.lit(SHEET_EPOCH)) / 7).cast("int")
    rows = cells(t).join(place, "punto_nro", "left").select("planta", F.floor(week / weeks).cast("int").alias("bloque"), (week % weeks + 1).alias("pos"), "anio", "semana_nro")
    spread = [F.max(F.expr(f"case when pos = {p} then semana_nro end")).cast("string").alias(f"column{p:03d}") for p in range(1, weeks + 1)]
    return rows.groupBy(*SHEET_IDS).agg(F.min("anio").alias("primer_anio"), *spread).withColumn("etiqueta", F.lit(WEEK_ROW))


def done_flag(status: Column) -> Column:
    return F.when(status == "F", 1).when(status == "O", 0)


def orders(t: Tables, batch: int = 2) -> DataFrame:
    """Work orders in the common format, one row per order; some have no machine."""
    day = F.col("o_orderdate").cast("date")
    rows = t.orders
    flag = done_flag(F.col("o_orderstatus"))
    if batch == 1:
        rows = rows.where(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
        flag = F.lit(None).cast("int")
    machine = machines(t).select("maquina_nro", "ubicacion_tecnica", "equipo_denom", "planta_canon")
    joined = rows.join(order_lines(t), "o_orderkey", "left").join(machine, "maquina_nro", "left")
    base = joined.select(
        F.col("o_orderkey").cast("string").alias("orden_nro"),
        "ubicacion_tecnica",
        "equipo_denom",
        "planta_canon",
        F.col("o_orderpriority").alias("ot_texto_breve"),
        F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("responsable"),
        F.col("cantidad").alias("hh_planificadas"),
        (F.col("lineas") * 2.0).alias("duracion_planificada"),
        F.col("lineas").cast("int").alias("personal_prog"),
        F.col("cantidad_real").alias("hh_reales"),
        (F.col("suma_linea") * 1.0).alias("duracion_real"),
        F.col("mayor_linea").cast("int").alias("personal_real"),
        flag.alias("cumpl_prog"),
        F.col("mayor_descuento").alias("adherencia_prog"),
        c.iso_year(day).alias("anio"),
        c.iso_week(day).alias("semana_nro"),
        day.alias("inicio_programado"),
        F.col("equipo_denom").alias("denom_ubic_tecnica"),
        *[
            F.lit(None).cast("string").alias(x)
            for x in ("fecha_inicio_extrema", "fecha_liberacion", "clase_orden", "clase_actividad_pm", "status_sistema")
        ],
    )
    pending = F.col("cumpl_prog") == 0
    return base.select(
        "*",
        F.when(F.col("cumpl_prog") == 1, F.col("inicio_programado")).alias("dia_ejecutado"),
        F.when(pending, reason_of(F.col("orden_nro"))).alias("motivo_no_ejecucion"),
        F.when(pending, weight_of(F.col("orden_nro"))).alias("peso_motivo"),
        F.when(pending, F.date_add("inicio_programado", 7)).alias("fecha_reprogramacion"),
    )


def order_people(t: Tables, batch: int = 2) -> DataFrame:
    """Person in charge of each order, found by alias as for the measurements."""
    rows = t.orders
    if batch == 1:
        rows = rows.where(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
    named = rows.select(
        F.col("o_orderkey").cast("string").alias("orden_nro"),
        F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias("responsable"),
    )
    return resolve_roles(named, people(t), ["orden_nro"], {"responsable": "responsable"}).drop("rol")


def components(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    return t.supplier.select(
        _component_code(key).alias("componente_codigo"),
        F.concat(F.lit("Componente "), _component_code(key)).alias("componente_nombre"),
        F.when(key % 2 == 0, "CHUTE").otherwise("FALDON").alias("tipo_componente"),
        (key % 2).cast("int").alias("nivel_jerarquia"),
        F.lit("A_componente_correa").alias("familia_causa"),
        F.concat(F.lit("MG_"), _generator(key).cast("string")).alias("maquina_gen_codigo"),
        F.when(key % 2 == 1, _component_code(key - 1)).alias("componente_padre_codigo"),
    )


def component_states(t: Tables) -> DataFrame:
    broken = F.col("s_acctbal") < 0
    return t.supplier.select(
        _component_code(F.col("s_suppkey")).alias("componente_codigo"),
        F.when(broken, "defectuoso").otherwise("operativo").alias("estado_actual"),
        F.when(broken, "grave").otherwise("ninguna").alias("severidad"),
        F.lit(INSPECTED).alias("fecha_inspeccion"),
    )


def conditions_of(events: DataFrame) -> DataFrame:
    """One observed condition per point, kind and week, as grave as its worst event."""
    day = F.col("ts").cast("date")
    worst = F.max("value")
    return events.groupBy(
        F.col("user_id").alias("punto_nro"),
        F.upper("event_type").alias("condicion_codigo"),
        (c.iso_year(day) - EVENT_YEAR_SHIFT).alias("anio"),
        c.iso_week(day).alias("semana_nro"),
    ).agg(F.when(worst >= 100, "grave").when(worst >= 50, "medio").otherwise("leve").alias("severidad"))


def observed_conditions(t: Tables) -> DataFrame:
    return conditions_of(t.events)


def condition_types(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return (
        t.events.select("event_type")
        .distinct()
        .select(
            F.upper(kind).alias("condicion_codigo"),
            F.concat(F.lit("Condición "), kind).alias("condicion_nombre"),
            (F.length(kind) / 10.0).cast("double").alias("peso_causa_default"),
            F.concat(F.lit("PR_"), F.upper(F.substring(kind, 1, 1))).alias("problema_raiz_codigo"),
        )
    )


def root_problems(t: Tables) -> DataFrame:
    letter = F.substring("problema_raiz_codigo", 4, 1)
    family = (
        F.when(letter.isin("E", "S"), "A_componente_correa")
        .when(letter == "P", "B_maqctrl_falla")
        .otherwise("C_ambiental_aseo")
    )
    return (
        condition_types(t)
        .select("problema_raiz_codigo")
        .distinct()
        .select(
            "problema_raiz_codigo",
            F.concat(F.lit("Problema "), letter).alias("problema_raiz_nombre"),
            family.alias("familia_causa"),
        )
    )


def frames(spark: SparkSession, directory: str) -> Frames:
    t = Tables(spark, directory)
    value = F.col("concentracion_mg_m3")

    def measured() -> DataFrame:
        return cells(t).select(
            *POINT_WEEK,
            "concentracion_mg_m3",
            "fecha_medicion",
            "hora_inicio",
            "hora_termino",
            c.measured_state(value).alias("estado"),
            c.unmeasured_reason(value).alias("motivo_no_medicion"),
        )

    def point() -> DataFrame:
        full = c.concat_code(F.col("maquina_gen_codigo"), F.col("componente_codigo"))
        return points(t).select(
            "punto_nro", "nombre_punto", "descripcion_punto", "tipo_punto", "planta_canon", "maquina_gen_codigo",
            full.alias("componente_codigo_full"),
        )

    def component() -> DataFrame:
        state = component_states(t).select("componente_codigo", F.col("estado_actual").alias("estado_componente"))
        return components(t).join(state, "componente_codigo", "left")

    generator = ("maquina_gen_codigo", "maquina_gen_nombre", "tipo_maquina_gen", "descripcion")
    return Frames(
        {
            "medicion": measured,
            "punto": point,
            "planta": lambda: plants(t),
            "maquina_gen": lambda: points(t).select(*generator).distinct(),
            "semana": lambda: iso_calendar(spark, *CALENDAR),
            "medicion_persona": lambda: measurement_people(t),
            "persona": lambda: persons(t),
            "orden": lambda: orders(t).drop("equipo_denom", "planta_canon", "responsable"),
            "orden_responsable": lambda: order_people(t),
            "maquina_control": lambda: machines(t).drop("maquina_nro"),
            "cobertura": lambda: coverage(t),
            "componente": component,
            "condicion_observada": lambda: observed_conditions(t),
            "condicion_tipo": lambda: condition_types(t).drop("problema_raiz_codigo"),
            "condicion_problema": lambda: condition_types(t).select("condicion_codigo", "problema_raiz_codigo"),
            "problema_raiz": lambda: root_problems(t),
        }
    )


def marts(spark: SparkSession, directory: str) -> Lazy:
    f = frames(spark, directory)
    return Lazy({name: lambda build=build: build(f) for name, build in MARTS.items()})


def history_sources(spark: SparkSession, directory: str, batch: int = 2) -> Lazy:
    """Sources of the history tables, as of the given batch."""
    t = Tables(spark, directory)
    kind = F.col("tipo_equipo").alias("tipo_equipo_codigo")
    return Lazy(
        {
            "mediciones": lambda: measurements(t, batch),
            "mediciones_personas": lambda: measurement_people(t, batch),
            "ordenes": lambda: orders(t, batch),
            "ordenes_personas": lambda: order_people(t, batch),
            "componentes": lambda: components(t),
            "componentes_estado": lambda: component_states(t),
            "condiciones_observadas": lambda: observed_conditions(t),
            "condiciones_tipo": lambda: condition_types(t),
            "condiciones_problema": lambda: condition_types(t).select("condicion_codigo", "problema_raiz_codigo"),
            "problemas": lambda: root_problems(t),
            "equipos": lambda: machines(t),
            "tipos_equipo": lambda: machines(t).select(kind, "familia_equipo").distinct(),
            "plantas_tipos": lambda: machines(t).select("planta_canon", kind),
            "cobertura": lambda: coverage(t),
            "personas": lambda: people(t),
            "plantas": lambda: plants(t),
            "semanas": lambda: weeks(t),
        }
    )


# --- sheets ------------------------------------------------------------------

# Header labels of a measurement sheet.
WEEK_ROW, DATE_ROW = "Semanas", "Fecha medicion"
OPERATOR_ROW, TECHNICIAN_ROW = "Operador Panel", "Técnico Higiene"
START_ROW, END_ROW, TONNAGE_ROW = "Hora inicio", "Hora termino", "Tratamiento tph"


SHEET_EPOCH = date(1990, 1, 1)  # a Monday
SHEET_WEEKS = 52
SHEET_IDS = ("planta", "bloque")


def reading_span(t: Tables) -> tuple[date, date]:
    """First and last Monday of the readings: one row to the driver."""
    day = F.col("l_shipdate").cast("date")
    return tuple(t.lineitem.agg(monday(F.min(day)), monday(F.max(day))).first())


def wide_sheets(t: Tables) -> DataFrame:
    """Every plant's readings as wide sheets of 52 week columns with their header rows.

    A sheet is one plant and one run of 52 weeks, so its width stays the same
    however long the history grows.
    """
    place = points(t).select("punto_nro", F.col("planta_canon").alias("planta"), "nombre_punto")
    week = F.floor(F.datediff(monday(F.col("fecha_medicion")), F.lit(SHEET_EPOCH)) / 7).cast("int")
    rows = (
        cells_with_people(t)
        .join(place, "punto_nro", "left")
        .withColumn("bloque", F.floor(week / SHEET_WEEKS).cast("int"))
        .withColumn("pos", week % SHEET_WEEKS + 1)
    )
    head = rows.groupBy(*SHEET_IDS, "pos").agg(
        F.max("semana_nro").cast("string").alias(WEEK_ROW),
        F.max("fecha_medicion").cast("string").alias(DATE_ROW),
        F.max("operador_alias").alias(OPERATOR_ROW),
        F.max("tecnico_alias").alias(TECHNICIAN_ROW),
        F.max("hora_inicio").alias(START_ROW),
        F.max("hora_termino").alias(END_ROW),
        (F.max("semana_nro") + 1100).cast("string").alias(TONNAGE_ROW),
    )
    labels = [WEEK_ROW, DATE_ROW, OPERATOR_ROW, TECHNICIAN_ROW, START_ROW, END_ROW, TONNAGE_ROW]
    head_long = head.unpivot([*SHEET_IDS, "pos"], labels, "etiqueta", "valor")
    value_long = rows.select(
        *SHEET_IDS,
        "pos",
        sheet_label(F.col("nombre_punto"), F.col("punto_nro")).alias("etiqueta"),
        F.col("concentracion_mg_m3").alias("valor"),
    )
    keys = [*SHEET_IDS, "etiqueta"]
    names = {p: f"column{p:02d}" for p in range(1, SHEET_WEEKS + 1)}

    def spread(long: DataFrame) -> DataFrame:
        # numbers stay numbers until they are spread: their maxima need no sort
        wide = long.groupBy(*keys).agg(*[F.max(F.expr(f"case when pos = {p} then valor end")).alias(n) for p, n in names.items()])
        return wide.selectExpr(*keys, *[f"cast({n} as string) {n}" for n in names.values()])

    return spread(head_long).unionByName(spread(value_long))


def landed_sheets(t: Tables) -> DataFrame:
    """The sheets as files of the landing, which is how they arrive."""
    folder = shared_dir(t.spark, "hojas")
    wide = wide_sheets(t)
    wide.write.parquet(folder)
    return t.spark.read.schema(wide.schema).parquet(folder)


def sheet_monday(position: Column) -> Column:
    """Monday of a week column of sheet `bloque`."""
    return F.date_add(F.lit(SHEET_EPOCH), (F.col("bloque") * SHEET_WEEKS + position - 1) * 7)


# The week the sample order sheets cover.
SHEET_DAYS = {f"2026-05-{d} 00:00:00": date(2026, 5, d) for d in range(18, 25)}
ORDER_SHEET = OrderSheet(SHEET_DAYS, year=2026, week=19)


def order_sheet(t: Tables) -> DataFrame:
    """All orders as a work-order sheet: text cells with stray blanks, '1.0' flags, marked days."""
    o = ORDER_SHEET.columns
    weekday = F.dayofweek("o_orderdate")
    flag = F.when(F.col("o_orderstatus") == "F", "1.0").when(F.col("o_orderstatus") == "O", " 0")
    key = F.col("o_orderkey").cast("string")
    return t.orders.join(order_lines(t), "o_orderkey", "left").select(
        F.concat(F.lit(" ot-"), key, F.lit(" ")).alias(o["orden"]),
        F.concat(F.lit("equipo   NRO "), F.floor(F.col("maquina_nro") / 2).cast("string")).alias(o["equipo_denom"]),
        F.concat(F.lit("  "), F.col("o_orderpriority")).alias(o["ot_texto_breve"]),
        F.concat(F.lit("P-"), F.col("o_custkey").cast("string")).alias(o["responsable"]),
        F.lit("   ").alias(o["pto_trabajo_ejecutor"]),
        F.col("cantidad").cast("string").alias(o["hh_planificadas"]),
        F.col("lineas").cast("string").alias(o["duracion_planificada"]),
        (F.col("lineas") * 1.0).cast("string").alias(o["personal_prog"]),
        F.col("cantidad_real").cast("string").alias(o["hh_reales"]),
        F.when(F.col("lineas") > 1, F.col("suma_linea").cast("string")).otherwise("sin dato").alias(o["duracion_real"]),
        (F.col("mayor_linea") + 0.5).cast("string").alias(o["personal_real"]),
        flag.alias(o["cumpl_prog"]),
        F.col("mayor_descuento").cast("string").alias(o["adherencia_prog"]),
        F.col("o_orderdate").cast("date").cast("string").alias(o["fecha_inicio_extrema"]),
        # day 1 is Sunday; orders of a Sunday mark no day and fall back to the first
        *[F.when(weekday == i + 2, F.col("lineas").cast("string")).alias(name) for i, name in enumerate(SHEET_DAYS)],
    )


def shared_name_machines(t: Tables) -> DataFrame:
    """Machine catalogue in which two machines share a name, some of them within one plant."""
    return machines(t).withColumn(
        "equipo_denom", F.concat(F.lit("Equipo nro "), F.floor(F.col("maquina_nro") / 2).cast("string"))
    )
