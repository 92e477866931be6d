"""Every operator and query as a runnable entry over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgauge import registry_history
from airgauge import standin as st
from airgauge.functions import bands
from airgauge.functions import columns as c
from airgauge.operators import bucketed as b
from airgauge.operators import chunks as ch
from airgauge.operators import governance as g
from airgauge.operators import history as h
from airgauge.operators import reshape as rs
from airgauge.operators import vectors as vec
from airgauge.operators.calendar import densify, monday
from airgauge.operators.orders import normalize_orders, resolve_machine
from airgauge.plans import questions as q
from airgauge.plans import reports as rep
from airgauge.plans import vault
from airgauge.plans.catalog import HUB, LINK, SATELLITE
from airgauge.plans.frames import Frames
from airgauge.plans.marts import MARTS, bridge, build_marts, measurement_detail, point_dimension, root_causes, stored_marts
from airgauge.session import kept, shared_dir
from airgauge.sources import landing as ld
from airgauge.streaming import incremental as inc

Query = Callable[[SparkSession, str], DataFrame]
FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-08 00:00:00"
SALT = "sal"
RUN = "corrida-1"
ZONE = "America/Santiago"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text: the form in which results are compared."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double").alias(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string").alias(f.name)
        out.append(col)
    return df.select(*out)


def moment(text: str):
    return F.lit(text).cast("timestamp")


# --- marts, questions, reports -----------------------------------------------


def mart_query(name: str) -> Query:
    return lambda spark, d: st.marts(spark, d)[name]


def kept_frames(spark: SparkSession, d: str) -> Frames:
    """Frames for all marts: those that grow with readings and orders, and that several marts are made from, are made once."""
    f = st.frames(spark, d)
    return f.replaced(**{name: kept(f[name], name) for name in ("medicion", "medicion_persona", "punto", "orden")})


def dense_frames(spark: SparkSession, d: str, f: Frames | None = None) -> Frames:
    """Frames whose measurements include every missing (point, week) as not measured."""
    f = f or st.frames(spark, d)
    first, last = st.reading_span(st.Tables(spark, d))
    dense = densify(f.medicion, f.punto.select("punto_nro"), first, last)
    return f.replaced(medicion=dense)


def dense_detail(spark: SparkSession, d: str, f: Frames | None = None) -> DataFrame:
    f = dense_frames(spark, d, f)
    weekless = f.medicion.drop("fecha_inicio_semana", "fecha_fin_semana", "trimestre", "mes")
    return measurement_detail(f.replaced(medicion=weekless))


def question_query(qid: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        if qid == "P11":
            return q.why_not_measured(dense_detail(spark, d))
        return q.QUESTIONS[qid].run(st.marts(spark, d), ordered=False)

    return run


def earlier_query(bid: str) -> Query:
    mart, answer = q.EARLIER_QUESTIONS[bid]
    return lambda spark, d: answer(st.marts(spark, d)[mart])


def root_causes_argmax(spark: SparkSession, d: str) -> DataFrame:
    return root_causes(st.frames(spark, d), "argmax")


def windows_by_calendar(spark: SparkSession, d: str) -> DataFrame:
    return q.high_window(st.marts(spark, d)["ventanas_temporales"], mode="range")


def full_bridge(spark: SparkSession, d: str) -> DataFrame:
    f = st.frames(spark, d)
    rows = bridge(f.medicion, point_dimension(f, plant=True, machine=True, component=True), f.semana)
    return rows.select(
        "planta_canon", "nombre_planta", "punto_nro", "nombre_punto", "maquina_gen_codigo", "tipo_maquina_gen",
        "componente_codigo_full", "tipo_componente", "estado_componente", "anio", "semana_nro", "fecha_inicio_semana",
        "concentracion_mg_m3", "estado",
    )


def dust_bands(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("concentracion_mg_m3")
    return st.cells(st.Tables(spark, d)).select(
        "punto_nro", "anio", "semana_nro", v,
        bands.band_of(v, "level").alias("nivel"),
        bands.band_of(v, "colour").alias("color"),
        bands.band_of(v, "label").alias("etiqueta"),
        bands.band_of(v, "over_limit").alias("sobre_limite"),
    )


# --- landing and reshaping ----------------------------------------------------


def _long(spark: SparkSession, d: str) -> DataFrame:
    return rs.unpivot_wide(st.wide_sheets(st.Tables(spark, d)), [*st.SHEET_IDS, rs.LABEL])


def sheet_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return _long(spark, d)


def sheet_header_rows(spark: SparkSession, d: str) -> DataFrame:
    return rs.header_rows(_long(spark, d), st.SHEET_IDS)


def sheet_metadata(spark: SparkSession, d: str) -> DataFrame:
    return rs.pivot_metadata(_long(spark, d), st.SHEET_IDS)


def sheet_value_rows(spark: SparkSession, d: str) -> DataFrame:
    return rs.value_rows(_long(spark, d), st.SHEET_IDS)


def sheet_to_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Wide sheets to long rows, points found by name."""
    t = st.Tables(spark, d)
    year = c.iso_year(st.sheet_monday(rs.position_number(F.col(rs.POSITION))))
    long = rs.melt_sheet(st.landed_sheets(t), st.SHEET_IDS, year)
    catalog = st.points(t).select("punto_nro", F.col("punto_evaluacion").alias("nombre_catalogo"))
    return rs.join_normalized(long, catalog, "punto_evaluacion", "nombre_catalogo").select(
        "planta", "punto_nro", "anio", "semana_nro", "concentracion_mg_m3", "fecha_medicion", "operador_alias",
        "tecnico_alias", "hora_inicio", "hora_termino",
    )


def sheets_union(spark: SparkSession, d: str) -> DataFrame:
    """Two sheets with different week columns stacked; filled cells of each per plant."""
    wide = st.wide_sheets(st.Tables(spark, d))
    weeks = rs.week_columns(wide)
    half = len(weeks) // 2
    parts = [
        wide.select(*st.SHEET_IDS, rs.LABEL, *cols).withColumn("hoja", F.lit(name))
        for name, cols in (("antes", weeks[:half]), ("despues", weeks[half:]))
    ]
    long = rs.unpivot_wide(rs.union_sheets(parts), [*st.SHEET_IDS, rs.LABEL, "hoja"])
    return long.groupBy("planta", "hoja").agg(F.count(F.lit(1)).alias("celdas"))


def point_names_resolved(spark: SparkSession, d: str) -> DataFrame:
    t = st.Tables(spark, d)
    spelled = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "l_linenumber", st.sheet_label(F.col("s_name"), F.col("s_suppkey")).alias("escrito")
    )
    catalog = st.points(t).select("punto_nro", F.col("punto_evaluacion").alias("nombre_catalogo"))
    return (
        rs.join_normalized(spelled, catalog, "escrito", "nombre_catalogo")
        .groupBy("punto_nro")
        .agg(F.count(F.lit(1)).alias("lineas"))
    )


def dense_measurements(spark: SparkSession, d: str) -> DataFrame:
    return dense_frames(spark, d).medicion.select("punto_nro", "anio", "semana_nro", "fecha_inicio_semana", "concentracion_mg_m3", "estado",
                        "motivo_no_medicion")


ORDER_OUT = (
    "orden_nro", "equipo_denom", "ot_texto_breve", "responsable", "pto_trabajo_ejecutor", "hh_planificadas",
    "duracion_planificada", "personal_prog", "hh_reales", "duracion_real", "personal_real", "cumpl_prog",
    "adherencia_prog", "fecha_inicio_extrema", "anio", "semana_nro", "inicio_programado", "dia_ejecutado",
    "motivo_no_ejecucion", "peso_motivo", "fecha_reprogramacion",
)


def orders_normalized(spark: SparkSession, d: str) -> DataFrame:
    sheet = st.order_sheet(st.Tables(spark, d))
    return (
        normalize_orders(sheet, st.ORDER_SHEET)
        .select(*ORDER_OUT)
        .withColumn("inicio_programado", c.iso_text(F.col("inicio_programado")))
    )


def orders_from_csv(spark: SparkSession, d: str) -> DataFrame:
    """The order sheet written as CSV, scanned as declared text columns, then normalised.

    A second declared source is absent and is skipped.
    """
    folder = shared_dir(spark, "csv")
    sheet = st.order_sheet(st.Tables(spark, d))
    # blanks around a cell are part of it
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True, "escape": '"'}
    sheet.write.options(**keep).csv(f"{folder}/general")
    specs = [
        ld.SourceSpec("programa_general", f"{folder}/general", tuple(sheet.columns)),
        ld.SourceSpec("programa_molienda", f"{folder}/molienda", tuple(sheet.columns)),
    ]
    rows, _ = ld.scan_all(spark, specs)
    return (
        normalize_orders(rows, st.ORDER_SHEET)
        .select(*ORDER_OUT)
        .withColumn("inicio_programado", c.iso_text(F.col("inicio_programado")))
    )


def _named_orders(t: st.Tables) -> DataFrame:
    sheet = normalize_orders(st.order_sheet(t), st.ORDER_SHEET).select("orden_nro", "equipo_denom")
    plant = st.orders(t).select(F.concat(F.lit("OT-"), "orden_nro").alias("orden_nro"), F.col("planta_canon").alias("planta_hoja"))
    return sheet.join(plant, "orden_nro", "left")


def machines_by_name(spark: SparkSession, d: str) -> DataFrame:
    t = st.Tables(spark, d)
    out = resolve_machine(_named_orders(t).drop("planta_hoja"), st.shared_name_machines(t))
    return out.select("orden_nro", "ubicacion_tecnica", "planta_canon", "nombre_ambiguo")


def machines_by_name_and_plant(spark: SparkSession, d: str) -> DataFrame:
    t = st.Tables(spark, d)
    rows = _named_orders(t).withColumnRenamed("planta_hoja", "planta_canon")
    out = resolve_machine(rows, st.shared_name_machines(t), also_on=["planta_canon"])
    return out.select("orden_nro", "planta_canon", "ubicacion_tecnica", "nombre_ambiguo")


def equipment_codes(spark: SparkSession, d: str) -> DataFrame:
    return st.machines(st.Tables(spark, d)).select("ubicacion_tecnica", "tipo_equipo", "familia_equipo", "planta_canon")


def local_times(spark: SparkSession, d: str) -> DataFrame:
    return st.Tables(spark, d).events.select("event_id", c.local_to_utc(F.col("ts"), ZONE).alias("utc"))


def week_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Calendar of every week the readings and orders span, with what happened in each."""
    t = st.Tables(spark, d)
    readings = t.lineitem.groupBy(monday(F.col("l_shipdate")).alias("fecha_inicio_semana")).agg(
        F.count(F.lit(1)).alias("lecturas")
    )
    return st.weeks(t).join(readings, "fecha_inicio_semana")


# --- sinks ---------------------------------------------------------------------


def mart_table(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "mart")
    ld.write_mart(st.marts(spark, d)["tendencias"], folder)
    return spark.read.parquet(folder)


def overwritten_table(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "tabla")
    t = st.Tables(spark, d)
    for batch in (1, 2):
        ld.write_overwrite(st.cells(t, batch).select("punto_nro", "anio", "semana_nro", "concentracion_mg_m3"), folder)
    return ld.as_view(spark.read.parquet(folder), "celdas_escritas")


def appended_table(spark: SparkSession, d: str) -> DataFrame:
    """Cells of both batches appended by key, the second batch twice."""
    folder = shared_dir(spark, "agregada")
    t = st.Tables(spark, d)
    key = ["punto_nro", "anio", "semana_nro"]
    for batch in (1, 2, 2):
        ld.append_new(st.cells(t, batch).select(*key, "concentracion_mg_m3"), folder, key)
    return spark.read.parquet(folder)


def report_json(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "json")
    rows = plain(rep.annual_concentration(st.marts(spark, d)["cobertura_semanal"]))
    ld.write_json(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


def chunks_json(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "chunks")
    rows = question_chunks("P14")(spark, d)
    ld.write_json(rows, folder)
    return spark.read.schema(rows.schema).json(folder)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def table_audit(spark: SparkSession, d: str) -> DataFrame:
    t = st.Tables(spark, d)
    return ld.audit_counts({name: getattr(t, name) for name in TABLES}, {"lineitem": 1000, "region": 5})


def vector_table(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "vectores")
    size = 64
    ld.ensure_vector_table(spark, folder, size)
    for _ in range(2):
        ld.append_vectors(st.Tables(spark, d).embeddings, folder, size)
    table = ld.ensure_vector_table(spark, folder, size)
    parts = F.transform("embedding", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    first = F.round(F.element_at("embedding", 1).cast("double"), 6).alias("primera")
    return table.select("vec_id", "dimension", "distancia", first, F.array_join(parts, ",").alias("componentes"))


def rejected_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = vec.check_vectors(st.Tables(spark, d).embeddings, "embedding", 32)
    return rows.groupBy("rechazo").agg(F.count(F.lit(1)).alias("filas"))


# --- history -------------------------------------------------------------------


def two_loads(rows: Callable, name: str, cols: list[str]) -> Query:
    """A table after two loads, with the load that brought each row."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        first = rows(name, st.history_sources(spark, d, 1), None, moment(FIRST_LOAD))
        second = rows(name, st.history_sources(spark, d, 2), first, moment(SECOND_LOAD))
        return (
            first.withColumn("carga", F.lit(1)).unionByName(second.withColumn("carga", F.lit(2))).select(*cols, "carga")
        )

    return run


def hub_query(name: str) -> Query:
    return two_loads(vault.hub_rows, name, [h.KEY, *HUB[name].key])


def link_query(name: str) -> Query:
    spec = LINK[name]
    cols = list(dict.fromkeys([h.KEY, *spec.members, *spec.key, *[x for m in spec.members.values() for x in m]]))
    return two_loads(vault.link_rows, name, cols)


def satellite_query(name: str) -> Query:
    return two_loads(vault.satellite_rows, name, [h.KEY, h.CONTENT, *SATELLITE[name].attributes, h.SEQ])


def _stored_execution(spark: SparkSession, d: str) -> DataFrame:
    first = vault.satellite_rows("detalle_ot_ejecucion", st.history_sources(spark, d, 1), None, moment(FIRST_LOAD))
    second = vault.satellite_rows("detalle_ot_ejecucion", st.history_sources(spark, d, 2), first, moment(SECOND_LOAD))
    return first.unionByName(second)


VERSION_OUT = (h.KEY, "cumpl_prog", "hh_reales", h.SEQ)


def versions_current(spark: SparkSession, d: str) -> DataFrame:
    return h.current_version(_stored_execution(spark, d)).select(*VERSION_OUT)


def versions_as_of(spark: SparkSession, d: str) -> DataFrame:
    return h.as_of(_stored_execution(spark, d), moment("2024-01-03 00:00:00")).select(*VERSION_OUT)


def versions_closed(spark: SparkSession, d: str) -> DataFrame:
    return h.with_valid_to(_stored_execution(spark, d)).select(*VERSION_OUT, h.FROM, h.TO)


SNAP_COLS = ("orden_nro", "ot_texto_breve", "cumpl_prog", "hh_reales")


def _snapshot(spark: SparkSession, d: str, check: list[str] | None) -> DataFrame:
    t = st.Tables(spark, d)
    one, two = (st.orders(t, b).select(*SNAP_COLS) for b in (1, 2))
    first = h.snapshot_check(one, None, ["orden_nro"], moment(FIRST_LOAD), check)
    return h.snapshot_check(two, first, ["orden_nro"], moment(SECOND_LOAD), check).select(*SNAP_COLS, h.SNAP_FROM, h.SNAP_TO)


def snapshot_orders(spark: SparkSession, d: str) -> DataFrame:
    return _snapshot(spark, d, None)


def snapshot_orders_key_only(spark: SparkSession, d: str) -> DataFrame:
    """Checking the text only: a change of another column opens no version."""
    return _snapshot(spark, d, ["ot_texto_breve"])


def snapshot_orders_current(spark: SparkSession, d: str) -> DataFrame:
    return h.snapshot_current(_snapshot(spark, d, None))


def component_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    parts = st.components(st.Tables(spark, d)).select("componente_codigo", "componente_padre_codigo")
    return h.resolve_hierarchy(parts, "componente_codigo", "componente_padre_codigo")


def people_roles(spark: SparkSession, d: str) -> DataFrame:
    return st.measurement_people(st.Tables(spark, d))


# --- governance -----------------------------------------------------------------


def grants_of(t: st.Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Grants, groups and domain values: a customer may see the plants of its region's group.

    One in seven holds a plant directly, one in eleven a name nobody knows.
    """
    key = F.col("c_custkey")
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    plant = (
        F.when(key % 11 == 0, F.lit("desconocida")).when(key % 7 == 0, F.col("n_name")).otherwise(F.concat(F.lit("G_"), "r_name"))
    )
    scope = F.when(key % 3 == 0, F.lit("Todos")).when(key % 3 == 1, F.lit("fiscalizacion")).otherwise(F.lit("mantencion"))
    level = F.element_at(F.array(*[F.lit(x) for x in (*g.LEVELS, "otro")]), (key % 5 + 1).cast("int"))
    grants = who.select(
        F.col("c_name").alias("user_id"),
        F.explode(F.create_map(F.lit("planta"), plant, F.lit("ambito"), scope, F.lit("clasificacion"), level)).alias(
            "dimension", "value"
        ),
    )
    plants = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    scopes = F.array(F.lit("fiscalizacion"), F.lit("mantencion"))
    groups = plants.select(
        F.lit("planta").alias("dimension"), F.concat(F.lit("G_"), "r_name").alias("grupo"), F.col("n_name").alias("valor")
    ).unionByName(
        t.region.sparkSession.range(1).select(F.lit("ambito").alias("dimension"), F.lit("Todos").alias("grupo"), F.explode(scopes).alias("valor"))
    )
    domain = (
        t.nation.select(F.lit("planta").alias("dimension"), F.col("n_name").alias("valor"))
        .unionByName(t.region.sparkSession.range(1).select(F.lit("ambito").alias("dimension"), F.explode(scopes).alias("valor")))
        .unionByName(
            t.region.sparkSession.range(1).select(
                F.lit("clasificacion").alias("dimension"), F.explode(F.array(*[F.lit(x) for x in g.LEVELS])).alias("valor")
            )
        )
    )
    return grants, groups, domain


def _expanded(spark: SparkSession, d: str) -> DataFrame:
    return g.expand_groups(*grants_of(st.Tables(spark, d)))


def grants_expanded(spark: SparkSession, d: str) -> DataFrame:
    return _expanded(spark, d)


def report_by_user(spark: SparkSession, d: str) -> DataFrame:
    """What the annual report holds for every user: its rows are governed by plant and by scope."""
    rows = rep.annual_concentration(st.marts(spark, d)["cobertura_semanal"]).withColumn("ambito", F.lit("fiscalizacion"))
    dims = {"planta": "planta", "ambito": "ambito"}
    return g.totals_by_user(rows, _expanded(spark, d), dims, "filas", {"registros": "total_registros"})


def report_for_user(name: str) -> Query:
    user = "Customer#000000001"
    return lambda spark, d: rep.report(name, st.marts(spark, d), _expanded(spark, d), user)


def kpi_for_user(name: str) -> Query:
    user = "Customer#000000001"
    return lambda spark, d: rep.kpi(name, st.marts(spark, d)["cobertura_semanal"], _expanded(spark, d), user)


def points_by_level(spark: SparkSession, d: str) -> DataFrame:
    """Points each user may see by classification: the user's level must reach the point's."""
    t = st.Tables(spark, d)
    level = F.element_at(
        F.array(*[F.lit(x) for x in g.LEVELS]),
        F.when(F.col("s_acctbal") < 0, 4).when(F.col("s_acctbal") < 3000, 3).when(F.col("s_acctbal") < 6000, 2).otherwise(1),
    )
    per_level = t.supplier.groupBy(level.alias("_nivel")).agg(F.count(F.lit(1)).alias("n"))
    mine = _expanded(spark, d).where("dimension = 'clasificacion'")
    reached = mine.select("user_id", "value", F.explode(F.array(*[F.lit(x) for x in g.LEVELS])).alias("_nivel")).where(
        g.ordinal_ok(F.col("value"), F.col("_nivel"))
    )
    return reached.join(per_level, "_nivel").groupBy("user_id").agg(F.sum("n").alias("puntos"))


# --- chunks -----------------------------------------------------------------------


def question_chunks(qid: str) -> Query:
    """Chunks of a question's whole answer, as far as they do not depend on the run."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        question = q.QUESTIONS[qid]
        rows = question_query(qid)(spark, d)
        made = question.chunks(rows, RUN, moment(FIRST_LOAD), SALT)
        return made.select(
            "chunk_id",
            "regla_id",
            "medallon_id",
            F.col("dimensiones")["planta"].alias("planta"),
            F.col("dimensiones")["ambito"].alias("ambito"),
            F.size("pii_tokens").alias("n_pii"),
            "valido_hasta",
            "texto",
        )

    return run


def _document_chunks(t: st.Tables) -> DataFrame:
    """Documents as chunks; one in five has an expiry."""
    expiry = F.when(F.col("doc_id") % 5 == 0, F.col("n_chars")).otherwise(F.lit(ch.NO_EXPIRY).cast("bigint"))
    return t.documents.select(
        F.lit("documentos").alias("regla_id"),
        F.col("doc_id").cast("string").alias("chunk_id"),
        g.dimension_map({"documento": "column:doc_id", "idioma": "column:lang", "fuente": "column:source"}).alias("dimensiones"),
        ch.chunk_hash(F.col("text")).alias("hash_contenido"),
        expiry.alias("valido_hasta"),
        F.col("text").alias("texto"),
    )


def chunk_hashes(spark: SparkSession, d: str) -> DataFrame:
    return _document_chunks(st.Tables(spark, d)).select("chunk_id", "hash_contenido", F.col("dimensiones")["idioma"].alias("idioma"))


def chunks_valid(spark: SparkSession, d: str) -> DataFrame:
    rows = ch.valid_chunks(_document_chunks(st.Tables(spark, d)), F.lit(2000))
    return rows.select("chunk_id", "valido_hasta", "hash_contenido")


def chunks_forgotten(spark: SparkSession, d: str) -> DataFrame:
    """Chunks left after those of documents marked toxic are forgotten."""
    t = st.Tables(spark, d)
    values = t.labels.where("toxic = 1").select(F.col("doc_id").cast("string").alias("valor"))
    return ch.forget(_document_chunks(t), "documento", values).select("chunk_id", "hash_contenido")


def chunks_labelled(spark: SparkSession, d: str) -> DataFrame:
    rows = g.labelled(_document_chunks(st.Tables(spark, d)), "dimensiones", {"idioma": "es"})
    return rows.groupBy(F.col("dimensiones")["fuente"].alias("fuente")).agg(F.count(F.lit(1)).alias("chunks"))


def _cell_chunks(t: st.Tables, batch: int) -> DataFrame:
    rows = st.cells(t, batch)
    text = ch.fill("Punto {punto_nro}, semana {semana_nro} de {anio}: {concentracion_mg_m3} mg/m³ el {fecha_medicion}.")
    return rows.select(
        F.lit("celdas").alias("regla_id"),
        ch.chunk_key(["punto_nro", "anio", "semana_nro"]).alias("chunk_id"),
        ch.chunk_hash(text).alias("hash_contenido"),
        text.alias("texto"),
    )


def chunks_upserted(spark: SparkSession, d: str) -> DataFrame:
    """Stored chunks of the first batch, then what the second batch adds."""
    t = st.Tables(spark, d)
    stored = ch.upsert_chunks(_cell_chunks(t, 1), None)
    added = ch.upsert_chunks(_cell_chunks(t, 2), stored)
    both = stored.withColumn("carga", F.lit(1)).unionByName(added.withColumn("carga", F.lit(2)))
    return both.select("chunk_id", "hash_contenido", "texto", "carga")


def chunk_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every question, asked of stored marts, against the limits it declares."""
    folder = shared_dir(spark, "marts")
    frames = kept_frames(spark, d)
    build_marts(frames, folder)
    marts, rows = stored_marts(spark, folder), None
    for qid, question in q.QUESTIONS.items():
        answer = q.why_not_measured(dense_detail(spark, d, frames)) if qid == "P11" else question.run(marts, ordered=False)
        part = answer.select(F.lit(qid).alias("regla_id"))
        rows = part if rows is None else rows.unionByName(part)
    limits = spark.createDataFrame(
        [(i, q.QUESTIONS[i].min_rows, q.QUESTIONS[i].max_rows) for i in q.QUESTIONS], "regla_id string, minimo int, maximo int"
    )
    return ch.check_counts(rows, limits)


def pii_tokens(spark: SparkSession, d: str) -> DataFrame:
    rows = st.people(st.Tables(spark, d)).select("dni", "nombre_completo")
    return ch.pii_mapping(rows, ["dni", "nombre_completo"], SALT)


def people_tokenized(spark: SparkSession, d: str) -> DataFrame:
    rows = st.people(st.Tables(spark, d)).select("alias_fuente", "nombre_completo", "tipo_persona")
    out = ch.tokenize_pii(rows, ["alias_fuente", "nombre_completo"], SALT)
    return out.select("alias_fuente", "nombre_completo", "tipo_persona", F.size("pii_tokens").alias("n_pii"))


def texts_protected(spark: SparkSession, d: str) -> DataFrame:
    """Whole document texts encrypted and decrypted again, with what the cipher text is longer by."""
    key = F.lit("0123456789abcdef0123456789abcdef")
    rows = st.Tables(spark, d).documents.select("doc_id", F.col("text").alias("texto"))
    locked = ch.protect(rows, ["texto"], key)
    # a GCM cipher text carries 12 bytes of nonce and 16 of tag
    extra = F.octet_length(F.unbase64("texto"))
    opened = ch.unprotect(locked.withColumn("cifrado_bytes", extra), ["texto"], key)
    return opened.select("doc_id", "texto", (F.col("cifrado_bytes") - F.octet_length("texto")).cast("int").alias("sobrecarga"))


# --- vectors -----------------------------------------------------------------------


def label_centres(t: st.Tables) -> DataFrame:
    """Mean vector of each label: the query vectors. Summed exactly, per position, before the shuffle."""
    sums = [F.sum(F.col("embedding")[i].cast("decimal(20,10)")).cast("double").alias(f"s{i}") for i in range(64)]
    return (
        t.embeddings.groupBy(F.col("label").alias("query_id"))
        .agg(F.count(F.lit(1)).alias("n"), *sums)
        .select("query_id", F.array(*[F.col(f"s{i}") / F.col("n") for i in range(64)]).alias("query_vector"))
    )


def _hits(spark: SparkSession, d: str, k: int = 10) -> DataFrame:
    t = st.Tables(spark, d)
    return vec.topk_cosine(label_centres(t), t.embeddings, k, few_queries=True)  # a row per label


def nearest_vectors(spark: SparkSession, d: str) -> DataFrame:
    return _hits(spark, d).select("query_id", "vec_id", F.round("score", 6).alias("score"), "lugar")


def nearest_vectors_scored(spark: SparkSession, d: str) -> DataFrame:
    rows = vec.min_score(_hits(spark, d), 0.3)
    return rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("cercanos"))


def nearest_vectors_recall(spark: SparkSession, d: str) -> DataFrame:
    """Share of each label's own vectors among the 50 nearest to its centre."""
    relevant = st.Tables(spark, d).embeddings.select(F.col("label").alias("query_id"), "vec_id")
    return vec.recall_at_k(_hits(spark, d, 50), relevant)


# --- streams -------------------------------------------------------------------------


def weekly_stream(spark: SparkSession, d: str) -> DataFrame:
    folder = shared_dir(spark, "semanas")
    schema = st.Tables(spark, d).events.schema
    events = inc.read_table(spark, f"{d}/events.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    weekly = inc.weekly_readings(events, "ts", "value", ["event_type"])
    inc.stream_weekly(weekly, f"{folder}/datos", f"{folder}/control").awaitTermination()
    return inc.latest_windows(spark, f"{folder}/datos", ["event_type"])


def worst_conditions(batch: DataFrame, root: str) -> DataFrame:
    """Conditions of a batch, as grave as the worst event of this batch or any before it."""
    key = SATELLITE["detalle_condicion_estado"].key
    seen = st.conditions_of(batch)
    touched = b.buckets_of(seen.select(b.buckets_for(key).of().alias(b.BUCKET)))  # a batch's weeks
    stored = b.stored_rows(batch.sparkSession, f"{root}/detalle_condicion_estado", touched)
    return inc.no_milder(seen, stored, key, "severidad", ("leve", "medio", "grave"))


def landing_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events land as a stream and load the observed-condition tables."""
    folder = shared_dir(spark, "aterrizaje")
    schema = st.Tables(spark, d).events.schema
    events = inc.read_table(spark, f"{d}/events.parquet", schema)

    def sources(batch: DataFrame) -> dict[str, DataFrame]:
        return {"condiciones_observadas": worst_conditions(batch, f"{folder}/datos")}

    inc.stream_landing(events, f"{folder}/datos", f"{folder}/control", sources).awaitTermination()
    link = spark.read.parquet(f"{folder}/datos/relacion_condicion_observada")
    state = h.current_version(spark.read.parquet(f"{folder}/datos/detalle_condicion_estado"))
    return link.join(state.select(h.KEY, "severidad", h.SEQ), h.KEY).select(
        h.KEY, "punto_nro", "condicion_codigo", "anio", "semana_nro", "severidad", h.SEQ
    )


# --- all -------------------------------------------------------------------------------


def slug(qid: str) -> str:
    return f"{qid[0].lower()}{int(qid[1:]):02d}_{q.QUESTIONS[qid].answer.__name__}"


def runnable() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in MARTS:
        out[f"mart_{name}"] = mart_query(name)
    out["mart_causa_raiz_argmax"] = root_causes_argmax
    out["measurement_bridge"] = full_bridge
    for qid in q.QUESTIONS:
        out[f"question_{slug(qid)}"] = question_query(qid)
    out["question_p13_by_calendar_weeks"] = windows_by_calendar
    for bid, (_, answer) in q.EARLIER_QUESTIONS.items():
        out[f"question_{bid.lower()}_{answer.__name__}"] = earlier_query(bid)
    out["report_concentracion_anual"] = lambda s, d: rep.annual_concentration(st.marts(s, d)["cobertura_semanal"])
    out["report_ot_no_ejecutadas"] = lambda s, d: rep.unexecuted_orders(st.marts(s, d)["no_ejecucion_ot"])
    out["report_tendencias_planta"] = lambda s, d: rep.plant_trends(st.marts(s, d)["tendencias"])
    out["kpi_concentracion_maxima_ultima_jornada"] = lambda s, d: rep.kpi_max_last_session(st.marts(s, d)["cobertura_semanal"])
    out["kpi_pct_sobre_limite_anual"] = lambda s, d: rep.kpi_percent_over_limit(st.marts(s, d)["cobertura_semanal"])
    out["kpi_puntos_criticos_ultima_jornada"] = lambda s, d: rep.kpi_critical_points(st.marts(s, d)["cobertura_semanal"])
    for fn in (
        dust_bands, sheet_unpivot, sheet_header_rows, sheet_metadata, sheet_value_rows, sheet_to_measurements, sheets_union,
        point_names_resolved, dense_measurements, orders_normalized, orders_from_csv, machines_by_name,
        machines_by_name_and_plant, equipment_codes, local_times, week_calendar, mart_table, overwritten_table,
        appended_table, report_json, chunks_json, table_audit, vector_table, rejected_vectors,
    ):
        out[fn.__name__] = fn
    for name in HUB:
        out[f"hub_{name}"] = hub_query(name)
    for name in LINK:
        out[f"link_{name}"] = link_query(name)
    for name in SATELLITE:
        out[f"satellite_{name}"] = satellite_query(name)
    for fn in (
        versions_current, versions_as_of, versions_closed, snapshot_orders, snapshot_orders_key_only,
        snapshot_orders_current, component_hierarchy, people_roles, grants_expanded, report_by_user, points_by_level,
    ):
        out[fn.__name__] = fn
    for name in rep.REPORTS:
        out[f"report_for_user_{name}"] = report_for_user(name)
    for name in rep.KPIS:
        out[f"kpi_{name}_for_user"] = kpi_for_user(name)
    for qid in q.QUESTIONS:
        out[f"chunks_{slug(qid)}"] = question_chunks(qid)
    for fn in (
        chunk_hashes, chunks_valid, chunks_forgotten, chunks_labelled, chunks_upserted, chunk_counts, pii_tokens,
        people_tokenized, texts_protected, nearest_vectors, nearest_vectors_scored, nearest_vectors_recall, weekly_stream,
        landing_stream,
    ):
        out[fn.__name__] = fn
    from airgauge import registry_retrieval  # which builds on the queries above

    return out | registry_history.QUERIES | registry_retrieval.QUERIES
