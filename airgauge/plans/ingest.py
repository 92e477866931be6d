"""From landing files and reference tables to the history, in one application.

scan -> snapshot -> long rows -> history tables. Sheets of a kind are stacked
before anything else happens, so nine sheets cost one plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.functions import columns as c
from airgauge.operators import history as h
from airgauge.operators import multi_active as ma
from airgauge.operators import reshape as rs
from airgauge.operators.calendar import day_of_week, iso_calendar, with_weeks_of
from airgauge.operators.orders import OrderSheet, normalize_orders, resolve_machine
from airgauge.plans.frames import ROLES, Lazy
from airgauge.plans.vault import kept, load_history, with_missing_cells, with_withdrawn_cells
from airgauge.sources.landing import SourceSpec, load_reference, path_exists, scan_all, write_overwrite

# Sheet name, its file, and the plant it measures.
MEASUREMENT_FILES = (
    ("puntos_prechancado", "Prechancado.csv", "Prechancado"),
    ("puntos_chancado_2_3", "2_y_3.csv", "Chancado 2° y 3°"),
    ("puntos_terciario", "Terciario.csv", "Chancado Fino 3°"),
    ("puntos_cuaternario", "Cuaternario.csv", "Chancado Fino 4°"),
    ("puntos_molienda_sag", "Molienda_Sag.csv", "Molienda SAG"),
    ("puntos_molienda_convencional", "Molienda_Convencional.csv", "Molienda Convencional"),
    ("puntos_cdm_1", "CDM_(1).csv", "CDM Linea 1"),
    ("puntos_cdm_2", "CDM_(2).csv", "CDM Linea 2"),
    ("puntos_nodo", "Nodo.csv", "Nodo 3500"),
)
ORDER_FILES = (
    ("programa_general", "Programa.csv"),
    ("programa_chancado_fino", "Chancado_Fino.csv"),
    ("programa_molienda", "Molienda.csv"),
    ("programa_chancado_primario", "Chancado_Primario.csv"),
)
CALENDAR = (date(2020, 1, 1), date(2040, 12, 31))


def measurement_sources(root: str) -> list[SourceSpec]:
    return [
        SourceSpec(name, f"{root}/{file}", snapshot_key=("planta", rs.LABEL), tags={"planta": plant})
        for name, file, plant in MEASUREMENT_FILES
    ]


def order_sources(root: str) -> list[SourceSpec]:
    return [SourceSpec(name, f"{root}/{file}", snapshot_key=("_fuente", "Orden")) for name, file in ORDER_FILES]


def snapshot_landing(src: DataFrame, root: str, key: Sequence[str], now: Column, several: bool = False) -> DataFrame:
    """Bring the snapshot under `root` up to `src` and return its current rows; `several`: a key may have more than one.

    A new state is written beside the old one and counts once its job has
    committed: a job lost half way leaves the old state in force.
    """
    spark = src.sparkSession
    n = 0
    while path_exists(spark, f"{root}/estado={n}/_SUCCESS"):
        n += 1
    stored = spark.read.parquet(f"{root}/estado={n - 1}") if n else None
    if stored is not None:
        # a sheet that grew has week columns its older states lack, or the other way round
        for col in set(src.columns) - set(stored.columns):
            stored = stored.withColumn(col, F.lit(None).cast("string"))
        for col in set(stored.columns) - set(src.columns) - {*h.SNAP_COLUMNS, ma.COPIES}:
            src = src.withColumn(col, F.lit(None).cast("string"))
    if not several:
        write_overwrite(h.snapshot_check(src, stored, key, now), f"{root}/estado={n}")
        return h.snapshot_current(spark.read.parquet(f"{root}/estado={n}"))
    if stored is not None and ma.COPIES not in stored.columns:
        stored = stored.withColumn(ma.COPIES, F.lit(1))
    write_overwrite(ma.snapshot_rows(src, stored, key, now), f"{root}/estado={n}")
    return ma.each_copy(ma.snapshot_rows_current(spark.read.parquet(f"{root}/estado={n}")))


def measurements_from_sheets(sheets: DataFrame, catalog: DataFrame, year: Column | None = None) -> DataFrame:
    """Long measurements with the point, machine and component each label stands for."""
    value = F.col("concentracion_mg_m3")
    points = catalog.withColumnRenamed("punto_evaluacion", "_texto")
    return rs.join_normalized(rs.melt_sheet(sheets, year=year), points, "punto_evaluacion", "_texto").select(
        "planta", "planta_canon", "punto_evaluacion", "punto_nro", "maquina_gen_codigo", "componente_codigo",
        c.concat_code(F.col("maquina_gen_codigo"), F.col("componente_codigo")).alias("componente_codigo_full"),
        "nombre_punto", "descripcion_punto", "tipo_punto", "maquina_gen_nombre", "tipo_maquina_gen", "descripcion",
        "anio", "semana_nro", "concentracion_mg_m3",
        c.measured_state(value).alias("estado"),
        c.unmeasured_reason(value).alias("motivo_no_medicion"),
        "fecha_medicion", "operador_alias", "tecnico_alias", "hora_inicio", "hora_termino", rs.POSITION,
        c.utc_now().alias("_bronce_loaded_at"),
    )


def blank_cells(sheets: DataFrame, catalog: DataFrame, year: Column | None = None) -> DataFrame:
    """(point, year, week) of the cells that sheets have for points of the catalogue, but without a reading."""
    points = catalog.select("punto_nro", F.col("punto_evaluacion").alias("_texto"))
    cells = rs.join_normalized(rs.unfilled_cells(sheets, year=year), points, "punto_evaluacion", "_texto", "inner")
    return cells.select("punto_nro", "anio", "semana_nro").distinct()


def catalogue_points(catalog: DataFrame) -> DataFrame:
    """The catalogue's points with the columns that measurements carry of them."""
    return catalog.select(
        F.col("planta_canon").alias("planta"), "planta_canon", "punto_evaluacion", "punto_nro", "maquina_gen_codigo", "componente_codigo",
        c.concat_code(F.col("maquina_gen_codigo"), F.col("componente_codigo")).alias("componente_codigo_full"),
        "nombre_punto", "descripcion_punto", "tipo_punto", "maquina_gen_nombre", "tipo_maquina_gen", "descripcion",
        c.utc_now().alias("_bronce_loaded_at"),
    )


def orders_from_sheets(sheets: DataFrame, machines: DataFrame, sheet: OrderSheet) -> DataFrame:
    return resolve_machine(normalize_orders(sheets, sheet), machines)


def sources_of(
    spark: SparkSession, references: str, measurements: DataFrame | None = None, orders: DataFrame | None = None
) -> Lazy:
    """Sources of the history tables, from what has landed and the reference tables under `references`."""

    def ref(name: str) -> DataFrame:
        return load_reference(spark, name, f"{references}/{name}.csv")

    def weeks() -> DataFrame:
        out = iso_calendar(spark, *CALENDAR)
        for rows in (measurements, orders):
            if rows is not None:
                out = with_weeks_of(out, rows.select(day_of_week(F.col("anio"), F.col("semana_nro"))))
        return out

    kind = F.col("tipo_equipo").alias("tipo_equipo_codigo")
    makers = {
        "componentes": lambda: ref("componentes_estructurales"),
        "componentes_estado": lambda: ref("componentes_estado_semanal"),
        "condiciones_observadas": lambda: ref("condiciones_observadas"),
        "condiciones_tipo": lambda: ref("condiciones_tipo").withColumnRenamed("nombre", "condicion_nombre"),
        "condiciones_problema": lambda: ref("condiciones_problema"),
        "problemas": lambda: ref("problemas_raiz").withColumnsRenamed(
            {"nombre": "problema_raiz_nombre", "familia": "familia_causa"}
        ),
        "equipos": lambda: ref("equipos_ventilacion_catalogo"),
        "tipos_equipo": lambda: ref("tipos_equipo_ctrl"),
        "plantas_tipos": lambda: ref("equipos_ventilacion_catalogo").select("planta_canon", kind),
        "cobertura": lambda: ref("punto_maqctrl_cobertura"),
        "personas": lambda: ref("personas_alias"),
        "plantas": lambda: ref("plantas_descripcion"),
        "semanas": weeks,
    }
    if measurements is not None:
        # labels outside the catalogue have no point to hang from; `write_rejects` keeps them
        known = measurements.where(F.col("punto_nro").isNotNull())
        key = ["punto_nro", "anio", "semana_nro"]
        makers["mediciones"] = lambda: known
        makers["mediciones_personas"] = lambda: h.resolve_roles(known, ref("personas_alias"), key, ROLES)
    if orders is not None:
        makers["ordenes"] = lambda: orders
        makers["ordenes_personas"] = lambda: h.resolve_roles(
            orders, ref("personas_alias"), ["orden_nro"], {"responsable": "responsable"}
        ).drop("rol")
    return Lazy(makers)


def write_rejects(measurements: DataFrame, root: str) -> None:
    """The measurements whose label is not in the catalogue, and their number per sheet and label.

    Both hold the state of the landed sheets: a label that enters the catalogue later leaves them.
    """
    unknown = measurements.where(F.col("punto_nro").isNull())
    write_overwrite(unknown, f"{root}/rechazos/mediciones")
    stored = measurements.sparkSession.read.schema(unknown.schema).parquet(f"{root}/rechazos/mediciones")
    counts = stored.groupBy("planta", "punto_evaluacion").agg(F.count(F.lit(1)).alias("n_filas"))
    write_overwrite(counts, f"{root}/rechazos/mediciones_por_etiqueta")


def ingest(
    spark: SparkSession, landing: str, references: str, root: str, sheet: OrderSheet, now: Column, dense: bool = True
) -> dict[str, bool]:
    """Everything under `landing` into the tables under `root`; which declared sources were there.

    Running it again on the same files adds nothing but a load of equal state. An order may have several
    operations, all of which are kept. A stored reading whose cell a later state of its sheet leaves blank is taken
    back: its cell becomes `no_medido`. With `dense`, points of the catalogue that were not measured in one of
    the sheets' weeks get a `no_medido` cell there, until a reading for it comes in.
    """
    sheets, found = scan_all(spark, measurement_sources(landing))
    programme, found_orders = scan_all(spark, order_sources(landing))
    current = snapshot_landing(sheets, f"{root}/instantaneas/puntos", ["planta", rs.LABEL], now)
    numbered = programme.where(F.trim(F.col("Orden")) != "")
    current_orders = snapshot_landing(numbered, f"{root}/instantaneas/programa", ["_fuente", "Orden"], now, several=True)
    catalog = load_reference(spark, "puntos_catalogo", f"{references}/puntos_catalogo.csv")
    machines = load_reference(spark, "equipos_ventilacion_catalogo", f"{references}/equipos_ventilacion_catalogo.csv")
    # the sheets melt once, however many tables are loaded from their rows
    measurements = kept(measurements_from_sheets(current, catalog), "celdas")
    write_rejects(measurements, root)
    known, points = measurements.where(F.col("punto_nro").isNotNull()), catalogue_points(catalog)
    measurements = with_withdrawn_cells(known, points, kept(blank_cells(current, catalog), "vacias"), root)
    if dense:
        measurements = with_missing_cells(measurements, points, root)
    orders = kept(orders_from_sheets(current_orders, machines, sheet), "ordenes")
    load_history(spark, root, sources_of(spark, references, kept(measurements, "mediciones"), orders), now)
    return {**found, **found_orders}
