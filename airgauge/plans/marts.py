"""The ten marts.

Dimensions are joined to one another before they meet a fact, so a fact is
shuffled at most once per mart, and not at all when Catalyst finds the finished
dimension below its broadcast threshold. No broadcast is forced: dimensions grow
with the data, and only the engine knows their size. All joins are on natural
keys that are unique on the dimension side; the stated fan-outs are machine to
covered points, and fact to causes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgauge.functions.columns import exact_avg, to_numeric
from airgauge.operators.calendar import day_of_week
from airgauge.plans.frames import (
    DONE,
    MEASURED,
    NOT_DONE,
    ROLE_OPERATOR,
    ROLE_TECHNICIAN,
    SCOPE_INSPECTION,
    SCOPE_MAINTENANCE,
    STOPPED_MACHINE,
    Frames,
    Lazy,
)
from airgauge.sources.landing import path_exists, write_mart, write_overwrite

SCHEMAS = "esquemas"
WEEK = ["anio", "semana_nro"]
POINT_WEEK = ["punto_nro", *WEEK]
MAIN_CAUSE_WEIGHT = 0.80


def measured(f: Frames) -> DataFrame:
    return f.medicion.where(F.col("estado") == MEASURED)


def point_dimension(f: Frames, plant: bool = False, machine: bool = False, component: bool = False) -> DataFrame:
    """Points with whatever hangs from them, joined small to small."""
    out = f.punto
    if plant:
        out = out.join(f.planta.select("planta_canon", "nombre_planta"), "planta_canon", "left")
    if machine:
        out = out.join(
            f.maquina_gen.select("maquina_gen_codigo", "maquina_gen_nombre", "tipo_maquina_gen"),
            "maquina_gen_codigo",
            "left",
        )
    if component:
        state = f.componente.select(
            F.col("componente_codigo").alias("componente_codigo_full"),
            "componente_nombre",
            "tipo_componente",
            "estado_componente",
        )
        out = out.join(state, "componente_codigo_full", "left")
    return out


def bridge(fact: DataFrame, points: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """One denormalised row per fact: the shared base of the measurement marts.

    Weeks that the calendar does not hold have the dates of the ISO calendar.
    """
    out = fact.join(points, "punto_nro", "left")
    if weeks is not None:
        out = out.join(weeks.select(*WEEK, "fecha_inicio_semana", "fecha_fin_semana"), WEEK, "left")
        first = day_of_week(F.col("anio"), F.col("semana_nro"))
        out = out.withColumns(
            {"fecha_inicio_semana": F.coalesce("fecha_inicio_semana", first), "fecha_fin_semana": F.coalesce("fecha_fin_semana", F.date_add(first, 6))}
        )
    return out


def _scoped(df: DataFrame, cols: Sequence[str | Column], scope: str) -> DataFrame:
    return df.select(*cols, F.lit(scope).alias("ambito"))


def weekly_ranking(f: Frames) -> DataFrame:
    """M1: plant, point, week."""
    return _scoped(
        bridge(f.medicion, point_dimension(f, plant=True, machine=True), f.semana),
        [
            "planta_canon", "nombre_planta", "punto_nro", "nombre_punto", "descripcion_punto", "tipo_punto",
            "maquina_gen_codigo", "maquina_gen_nombre", "anio", "semana_nro", "fecha_inicio_semana",
            "fecha_fin_semana", "fecha_medicion", "hora_inicio", "hora_termino", "concentracion_mg_m3",
            "estado", "motivo_no_medicion",
        ],
        SCOPE_INSPECTION,
    )


def plant_averages(f: Frames) -> DataFrame:
    """M2: plant, week. Pre-aggregated on each task before the shuffle."""
    value = F.col("concentracion_mg_m3")
    grouped = bridge(measured(f), point_dimension(f, plant=True)).groupBy("planta_canon", "nombre_planta", *WEEK)
    return _scoped(
        grouped.agg(
            F.count(F.lit(1)).alias("n_mediciones"),
            to_numeric(exact_avg(value)).alias("promedio_mg_m3"),
            to_numeric(F.max(value)).alias("maximo_mg_m3"),
            to_numeric(F.min(value)).alias("minimo_mg_m3"),
        ),
        ["planta_canon", "nombre_planta", *WEEK, "n_mediciones", "promedio_mg_m3", "maximo_mg_m3", "minimo_mg_m3"],
        SCOPE_INSPECTION,
    )


def people_by_measurement(f: Frames) -> DataFrame:
    """Operator and technician of each measurement, one row per (point, week)."""
    named = f.medicion_persona.join(f.persona.select("dni", "tipo_dni", "dni_pais_emisor", "nombre_completo"),
                                    ["dni", "tipo_dni", "dni_pais_emisor"], "left")

    def of(role: str) -> Column:
        return F.max(F.when(F.col("rol") == role, F.col("nombre_completo")))

    # a measurement has few people: rows are sorted once, where they meet, as texts have no partial aggregate without a sort
    return named.repartition(*POINT_WEEK).groupBy(*POINT_WEEK).agg(
        of(ROLE_OPERATOR).alias("operador_panel"), of(ROLE_TECHNICIAN).alias("tecnico_higiene")
    )


def measurement_detail(f: Frames) -> DataFrame:
    """M3: measurement with its people."""
    # people first: measurements that lie by point and week stay where they are
    base = bridge(f.medicion.join(people_by_measurement(f), POINT_WEEK, "left"), f.punto, f.semana)
    return _scoped(
        base,
        [
            "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_inicio_semana",
            "fecha_fin_semana", "fecha_medicion", "hora_inicio", "hora_termino", "concentracion_mg_m3",
            "estado", "motivo_no_medicion", "operador_panel", "tecnico_higiene",
        ],
        SCOPE_INSPECTION,
    )


def weekly_coverage(f: Frames) -> DataFrame:
    """M4: generator, point, week."""
    return _scoped(
        bridge(measured(f), point_dimension(f, machine=True), f.semana),
        [
            "planta_canon", "maquina_gen_codigo", "maquina_gen_nombre", "tipo_maquina_gen", "punto_nro",
            "nombre_punto", "anio", "semana_nro", "fecha_inicio_semana", "fecha_fin_semana", "fecha_medicion",
            "concentracion_mg_m3", "estado",
        ],
        SCOPE_INSPECTION,
    )


def time_windows(f: Frames) -> DataFrame:
    """M5: measured series with week dates."""
    return _scoped(
        bridge(measured(f), f.punto, f.semana),
        [
            "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_inicio_semana",
            "fecha_fin_semana", "concentracion_mg_m3", "estado",
        ],
        SCOPE_INSPECTION,
    )


def trend_series(f: Frames) -> DataFrame:
    """M6: measured series without dates."""
    return _scoped(
        bridge(measured(f), f.punto),
        ["planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "concentracion_mg_m3", "estado"],
        SCOPE_INSPECTION,
    )


def _cause_family(c: Column) -> Column:
    return F.substring(c, 1, 1)


def root_causes(f: Frames, mode: str = "threshold") -> DataFrame:
    """M7: one row per contributing cause of a measured (point, week).

    `mode='threshold'` marks a cause as main from weight 0.80 on; `mode='argmax'`
    marks the heaviest of each (point, week).
    """
    facts = measured(f).select(*POINT_WEEK, "concentracion_mg_m3")
    problems = (
        f.condicion_tipo.select("condicion_codigo", "condicion_nombre", "peso_causa_default")
        .join(f.condicion_problema, "condicion_codigo", "left")
        .join(f.problema_raiz.select("problema_raiz_codigo", "problema_raiz_nombre", "familia_causa"),
              "problema_raiz_codigo", "left")
    )
    point = point_dimension(f, component=True).select(
        "planta_canon", "punto_nro", "nombre_punto", F.col("componente_codigo_full").alias("componente_codigo"),
        "componente_nombre", "tipo_componente", "estado_componente",
    )
    conditions = (
        f.condicion_observada.join(facts, POINT_WEEK)
        .join(problems, "condicion_codigo", "left")
        .join(point, "punto_nro", "left")
        .select(
            "planta_canon", *POINT_WEEK, "nombre_punto", "concentracion_mg_m3",
            F.lit("condicion").alias("tipo_causa"),
            F.col("condicion_nombre").alias("causa_descripcion"),
            "condicion_nombre", "condicion_codigo", "severidad", "problema_raiz_nombre",
            _cause_family(F.col("familia_causa")).alias("familia_causa"),
            "componente_codigo", "componente_nombre", "tipo_componente", "estado_componente",
            F.col("peso_causa_default").alias("peso_causa"),
            F.lit(SCOPE_INSPECTION).alias("ambito"),
        )
    )
    machines = f.cobertura.join(
        f.maquina_control.select("ubicacion_tecnica", "equipo_denom", "tipo_equipo", "familia_equipo"),
        "ubicacion_tecnica", "left",
    )
    idle = (
        f.orden.where((F.col("cumpl_prog") == NOT_DONE) & F.col("ubicacion_tecnica").isNotNull())
        .select("orden_nro", "ubicacion_tecnica", *WEEK, "ot_texto_breve", "motivo_no_ejecucion", "peso_motivo",
                "fecha_reprogramacion")
        .join(machines, "ubicacion_tecnica")
        .join(facts, POINT_WEEK)
        .join(f.punto.select("punto_nro", "planta_canon", "nombre_punto"), "punto_nro", "left")
        .select(
            "planta_canon", *POINT_WEEK, "nombre_punto", "concentracion_mg_m3",
            F.lit("mantencion").alias("tipo_causa"),
            F.col("ot_texto_breve").alias("causa_descripcion"),
            F.lit(STOPPED_MACHINE).alias("problema_raiz_nombre"),
            F.lit("B").alias("familia_causa"),
            "equipo_denom", "tipo_equipo", "familia_equipo",
            F.col("orden_nro").alias("ot_relacionada"),
            "motivo_no_ejecucion", "fecha_reprogramacion",
            F.col("peso_motivo").alias("peso_causa"),
            F.lit(SCOPE_MAINTENANCE).alias("ambito"),
        )
    )
    causes = conditions.unionByName(idle, allowMissingColumns=True)
    if mode == "argmax":
        heaviest = causes.groupBy(*POINT_WEEK).agg(F.max("peso_causa").alias("_mayor"))
        causes = causes.join(heaviest, POINT_WEEK).withColumn(
            "es_causa_principal", F.coalesce(F.col("peso_causa") == F.col("_mayor"), F.lit(False))
        )
    else:
        causes = causes.withColumn(
            "es_causa_principal", F.coalesce(F.col("peso_causa") >= MAIN_CAUSE_WEIGHT, F.lit(False))
        )
    return causes.select(
        "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "concentracion_mg_m3", "tipo_causa",
        "causa_descripcion", "condicion_nombre", "condicion_codigo", "severidad", "problema_raiz_nombre",
        "familia_causa", "componente_codigo", "componente_nombre", "tipo_componente", "estado_componente",
        "equipo_denom", "tipo_equipo", "familia_equipo", "ot_relacionada", "motivo_no_ejecucion",
        "fecha_reprogramacion", "peso_causa", "es_causa_principal", "ambito",
    )


def machine_dimension(f: Frames) -> DataFrame:
    """Control machines with their own plant and the points they cover, one row per (machine, point)."""
    machines = f.maquina_control.select(
        "ubicacion_tecnica", "equipo_denom", "tipo_equipo", "familia_equipo", "sector", "planta_canon"
    ).join(f.planta.select("planta_canon", "nombre_planta"), "planta_canon", "left")
    covered = f.cobertura.join(f.punto.select("punto_nro", "nombre_punto"), "punto_nro", "left")
    return machines.join(covered, "ubicacion_tecnica", "left")


ORDER_BASE = (
    "orden_nro", "ot_texto_breve", "ubicacion_tecnica", "equipo_denom", "tipo_equipo", "familia_equipo", "sector",
    "planta_canon", "nombre_planta", "anio", "semana_nro", "inicio_programado", "hh_planificadas",
    "duracion_planificada", "personal_prog",
)


def _orders(f: Frames, keep: Column) -> DataFrame:
    on_machine = f.orden.where(F.col("ubicacion_tecnica").isNotNull() & keep)
    return on_machine.join(machine_dimension(f), "ubicacion_tecnica", "left")


def orders_not_done(f: Frames) -> DataFrame:
    """M8: orders not executed, per covered point."""
    return _scoped(
        _orders(f, F.col("cumpl_prog") == NOT_DONE),
        [*ORDER_BASE, "cumpl_prog", "motivo_no_ejecucion", "peso_motivo", "fecha_reprogramacion", "punto_nro",
         "nombre_punto"],
        SCOPE_MAINTENANCE,
    )


def orders_done(f: Frames) -> DataFrame:
    """M9: orders executed with the person in charge, per covered point."""
    person = ["dni", "tipo_dni", "dni_pais_emisor"]
    charge = f.orden_responsable.join(
        f.persona.select(
            *person,
            F.col("nombre_completo").alias("responsable_nombre"),
            F.col("tipo_persona").alias("responsable_tipo"),
        ),
        person,
        "left",
    ).select("orden_nro", "responsable_nombre", "responsable_tipo")
    return _scoped(
        _orders(f, F.col("cumpl_prog") == DONE).join(charge, "orden_nro", "left"),
        [*ORDER_BASE, "hh_reales", "personal_real", "duracion_real", "cumpl_prog", "adherencia_prog",
         "dia_ejecutado", "responsable_nombre", "responsable_tipo", "punto_nro", "nombre_punto"],
        SCOPE_MAINTENANCE,
    )


def orders_open(f: Frames) -> DataFrame:
    """M10: orders not closed (flag NULL or 0), per covered point."""
    return _scoped(
        _orders(f, F.col("cumpl_prog").isNull() | (F.col("cumpl_prog") == NOT_DONE)),
        [*ORDER_BASE, "cumpl_prog", "punto_nro", "nombre_punto"],
        SCOPE_MAINTENANCE,
    )


MARTS: dict[str, Callable[[Frames], DataFrame]] = {
    "ranking_semanal": weekly_ranking,
    "promedios_planta": plant_averages,
    "detalle_medicion": measurement_detail,
    "cobertura_semanal": weekly_coverage,
    "ventanas_temporales": time_windows,
    "tendencias": trend_series,
    "causa_raiz": root_causes,
    "no_ejecucion_ot": orders_not_done,
    "ejecucion_ot": orders_done,
    "ot_en_curso": orders_open,
}


AT_ONCE = 4  # marts that are written at the same time


def _editions(spark: SparkSession, root: str) -> int:
    """How many editions of the marts are whole. The schemas are an edition's last file."""
    n = 0
    while path_exists(spark, f"{root}/edicion={n}/{SCHEMAS}/_SUCCESS"):
        n += 1
    return n


def build_marts(frames: Frames, root: str, only: Collection[str] | None = None) -> None:
    """Stores every mart (or those named), those with a year partitioned by it, as a new edition.

    An edition counts once its last table is written: a lost job leaves the one before in force, and a rerun
    replaces what it left. The schemas are stored beside the marts: one without rows has no file that could tell
    its own.
    """
    made = {name: build(frames) for name, build in MARTS.items() if only is None or name in only}
    spark = next(iter(made.values())).sparkSession
    folder = f"{root}/edicion={_editions(spark, root)}"

    def store(name: str) -> None:
        write = write_mart if "anio" in made[name].columns else write_overwrite
        write(made[name], f"{folder}/{name}")

    # marts have nothing to do with each other: a few at a time keep the cluster busy between small ones
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(store, name) for name in made]:
            done.result()
    schemas = [(name, mart.schema.json()) for name, mart in made.items()]
    write_overwrite(spark.createDataFrame(schemas, "mart string, esquema string"), f"{folder}/{SCHEMAS}")


def stored_marts(spark: SparkSession, root: str) -> Lazy:
    """The latest edition of the stored marts: questions scan a mart and prune its years instead of building it."""
    n = _editions(spark, root)
    if not n:
        raise FileNotFoundError(f"no whole edition of the marts under {root}")
    folder = f"{root}/edicion={n - 1}"
    rows = spark.read.parquet(f"{folder}/{SCHEMAS}").collect()  # one row per mart
    schemas = {r.mart: T.StructType.fromJson(json.loads(r.esquema)) for r in rows}
    return Lazy({m: lambda m=m: spark.read.schema(schemas[m]).parquet(f"{folder}/{m}").select(*schemas[m].names) for m in schemas})
