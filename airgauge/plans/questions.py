"""The 26 parameterised questions and the four earlier ones.

A question reads one mart. Every parameter is optional: with none given the
question is answered for all points, plants, machines or orders in one plan, as
the chunk jobs need it. "Best one of each" is always an aggregate over an
ordered struct, which combines on each task first; a window appears only over
week counts, at most 53 rows per plant and year.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgauge.functions.bands import band_of, internal_limit
from airgauge.functions.columns import exact_avg, to_numeric
from airgauge.operators.chunks import build_chunks
from airgauge.plans.frames import DONE, MEASURED, SCOPE_INSPECTION, SCOPE_MAINTENANCE
from airgauge.plans.templates import TEMPLATES

# Thresholds of the questions, in mg/m3, and the window length in weeks.
HIGH = 2.5
LOW_FROM, LOW_TO = 0.01, 1.0
WINDOW_WEEKS = 4

WEEK = ("anio", "semana_nro")


# functions, since a Column needs a running session and a module does not


def value() -> Column:
    return F.col("concentracion_mg_m3")


def is_measured() -> Column:
    return F.col("estado") == MEASURED


def is_low() -> Column:
    return is_measured() & value().between(LOW_FROM, LOW_TO)


def is_high() -> Column:
    return value() >= HIGH


def week_key() -> Column:
    return F.col("anio") * 100 + F.col("semana_nro")


def in_latest_week(rows: DataFrame, over: DataFrame | None = None) -> DataFrame:
    """Rows of the latest week of `over`. The broadcast side is a global aggregate: one row."""
    latest = (rows if over is None else over).agg(F.max(week_key()).alias("_clave"))
    return rows.join(F.broadcast(latest), week_key() == F.col("_clave"), "left_semi")


def best_of(df: DataFrame, keys: Sequence[str], first: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """The row of each group that comes first in ascending order of `first`."""
    rest = [c for c in cols if c not in keys]
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(first)])
    top = F.min(F.struct(order.alias("o"), F.struct(*rest).alias("r"))).alias("_m")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_m.r.{c}").alias(c) for c in rest]).select(*cols)


def _optional(df: DataFrame, **equal) -> DataFrame:
    """Equality filters for the parameters that are given."""
    for column, wanted in equal.items():
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    return df


def _order_or_machine(df: DataFrame, orden: str | None, maquina: str | None) -> DataFrame:
    tests = []
    if orden is not None:
        tests.append(F.col("orden_nro") == orden)
    if maquina is not None:
        tests.append(F.col("equipo_denom").ilike(maquina))
    return df.where(reduce(lambda a, b: a | b, tests)) if tests else df


def _machine(df: DataFrame, maquina: str | None) -> DataFrame:
    return _order_or_machine(df, None, maquina)


# --- measurement -------------------------------------------------------------

RANKING = ("planta_canon", "punto_nro", "nombre_punto", "maquina_gen_nombre", "anio", "semana_nro", "fecha_medicion",
           "concentracion_mg_m3", "estado", "ambito")


def highest_point(mart: DataFrame) -> DataFrame:
    # latest week first, then the highest value: one ordered pass finds both
    return (
        mart.where(is_measured())
        .orderBy(F.desc("anio"), F.desc("semana_nro"), value().desc(), F.asc("punto_nro"))
        .limit(1)
        .select(*RANKING)
    )


def lowest_point(mart: DataFrame) -> DataFrame:
    rows = mart.where(is_measured())
    return (
        in_latest_week(rows.where(value() > 0), rows)
        .orderBy(value().asc(), F.asc("punto_nro"))
        .limit(1)
        .select(*RANKING)
    )


def _weighted() -> Column:
    total = F.sum(F.col("promedio_mg_m3") * F.col("n_mediciones").cast("decimal(18,0)")).cast("double")
    return to_numeric(total / F.nullif(F.sum("n_mediciones").cast("double"), F.lit(0.0))).alias("promedio_mg_m3")


def _count() -> Column:
    return F.sum("n_mediciones").alias("n_mediciones")


def _highest(name: str = "maximo_mg_m3") -> Column:
    return F.max("maximo_mg_m3").alias(name)


def _lowest() -> Column:
    return F.min("minimo_mg_m3").alias("minimo_mg_m3")


def plant_average(mart: DataFrame, planta: str | None = None) -> DataFrame:
    return (
        _optional(mart, planta_canon=planta)
        .groupBy("planta_canon", "ambito")
        .agg(_count(), _weighted(), _highest(), _lowest())
    )


def all_plants_average(mart: DataFrame) -> DataFrame:
    """Every plant and one grand total; `es_total` tells it from a plant without name."""
    p, a = F.col("planta_canon"), F.col("ambito")
    return mart.groupingSets([[p, a], [a]], p, a).agg(
        _count(), _weighted(), _highest(), _lowest(), (F.grouping("planta_canon") == 1).alias("es_total")
    )


def highest_plant(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("planta_canon", "ambito")
        .agg(_count(), _weighted(), _highest("pico_mg_m3"))
        .orderBy(F.desc("promedio_mg_m3"), F.asc_nulls_last("planta_canon"))
        .limit(1)
    )


def lowest_plant(mart: DataFrame) -> DataFrame:
    return (
        mart.where(F.col("promedio_mg_m3") > 0)
        .groupBy("planta_canon", "ambito")
        .agg(_count(), _weighted(), _lowest())
        .orderBy(F.asc_nulls_last("promedio_mg_m3"), F.asc_nulls_last("planta_canon"))
        .limit(1)
    )


def why_high(mart: DataFrame, punto: int | None = None, umbral: float = HIGH) -> DataFrame:
    """All causes of each point's peak week, where the peak reaches the threshold."""
    rows = _optional(mart, punto_nro=punto)
    peak = best_of(
        rows.where(value() >= umbral).select("punto_nro", *WEEK, "concentracion_mg_m3"),
        ["punto_nro"],
        [-value(), F.col("anio"), F.col("semana_nro")],
        ["punto_nro", *WEEK],
    )
    return rows.join(peak, ["punto_nro", *WEEK], "left_semi").select(
        "punto_nro", "anio", "semana_nro", "tipo_causa", "causa_descripcion", "condicion_codigo", "condicion_nombre",
        "severidad", "problema_raiz_nombre", "familia_causa", "ot_relacionada", "peso_causa", "es_causa_principal",
        "planta_canon", "ambito",
    )


def why_not_maintained(mart: DataFrame, maquina: str | None = None) -> DataFrame:
    return _machine(mart.where((F.col("familia_causa") == "B") & F.col("ot_relacionada").isNotNull()), maquina).select(
        "punto_nro", "nombre_punto", "equipo_denom", "tipo_equipo", "familia_equipo", "ot_relacionada",
        "motivo_no_ejecucion", "fecha_reprogramacion", "planta_canon", "anio", "semana_nro", "ambito",
    )


def when_measured(mart: DataFrame, punto: int | None = None, planta: str | None = None) -> DataFrame:
    return _optional(mart, punto_nro=punto, planta_canon=planta).select(
        "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_medicion", "hora_inicio",
        "hora_termino", "concentracion_mg_m3", "estado",
    )


def who_measured(mart: DataFrame, punto: int | None = None, planta: str | None = None) -> DataFrame:
    return _optional(mart, punto_nro=punto, planta_canon=planta).select(
        "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_medicion", "operador_panel",
        "tecnico_higiene",
    )


def why_not_measured(mart: DataFrame, hasta: date | None = None) -> DataFrame:
    rows = mart.where(F.col("estado") == "no_medido")
    if hasta is not None:
        rows = rows.where(F.col("fecha_inicio_semana") <= F.lit(hasta))
    return rows.select(
        "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_inicio_semana", "estado",
        "motivo_no_medicion",
    )


def machines_measured(mart: DataFrame, anio: int | None = None, semana: int | None = None) -> DataFrame:
    return (
        _optional(mart.where(is_measured()), anio=anio, semana_nro=semana)
        .select("planta_canon", "maquina_gen_nombre", "punto_nro", "nombre_punto", "concentracion_mg_m3",
                "fecha_medicion", "anio", "semana_nro")
        .distinct()
    )


def best_window(
    mart: DataFrame, event: Column, name: str, planta: str | None = None, weeks: int = WINDOW_WEEKS, mode: str = "rows"
) -> DataFrame:
    """The window of `weeks` weeks with most events, per plant.

    `mode='rows'` slides over weeks that have events; `mode='range'` over calendar weeks.
    """
    per_week = (
        _optional(mart, planta_canon=planta).where(event).groupBy("planta_canon", *WEEK).agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = Window.partitionBy("planta_canon", "anio").orderBy("semana_nro")
    frame = ordered.rangeBetween(0, weeks - 1) if mode == "range" else ordered.rowsBetween(0, weeks - 1)
    windows = per_week.select(
        "planta_canon",
        "anio",
        F.col("semana_nro").alias("semana_inicio"),
        (F.col("semana_nro") + (weeks - 1)).alias("semana_fin"),
        F.sum("n").over(frame).alias(name),
    )
    return best_of(
        windows,
        ["planta_canon"],
        [-F.col(name), F.col("anio"), F.col("semana_inicio")],
        ["planta_canon", "anio", "semana_inicio", "semana_fin", name],
    )


def high_window(mart: DataFrame, planta: str | None = None, mode: str = "rows") -> DataFrame:
    return best_window(mart, is_high(), "n_altos_ventana", planta, mode=mode)


def low_window(mart: DataFrame, planta: str | None = None, mode: str = "rows") -> DataFrame:
    return best_window(mart, is_low(), "n_bajos_ventana", planta, mode=mode)


def _span(mart: DataFrame, event: Column, punto: int | None) -> DataFrame:
    return (
        _optional(mart, punto_nro=punto)
        .where(event)
        .groupBy("planta_canon", "punto_nro", "anio")
        .agg(
            F.min("semana_nro").alias("desde"),
            F.max("semana_nro").alias("hasta"),
            F.count(F.lit(1)).alias("n_eventos"),
        )
        .select("punto_nro", "anio", "desde", "hasta", "n_eventos", "planta_canon")
    )


def high_span(mart: DataFrame, punto: int | None = None) -> DataFrame:
    return _span(mart, is_high(), punto)


def low_span(mart: DataFrame, punto: int | None = None) -> DataFrame:
    return _span(mart, is_low(), punto)


def rising_plant(mart: DataFrame) -> DataFrame:
    """The plant with the steepest rise and the average of each of its points.

    A plant needs two weeks for a slope. The broadcast side is one row.
    """
    rows = mart.where(is_measured())
    weekly = rows.groupBy("planta_canon", "semana_nro").agg(exact_avg(value()).alias("prom"))
    trend = weekly.groupBy("planta_canon").agg(
        F.regr_slope("prom", "semana_nro").alias("pendiente"),
        F.regr_r2("prom", "semana_nro").alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )
    top = (
        trend.where((F.col("n") >= 2) & (F.col("pendiente") > 0))
        .orderBy(F.desc("pendiente"), F.asc("planta_canon"))
        .limit(1)
        .select("planta_canon", F.round("pendiente", 6).alias("pendiente"), F.round("r2", 6).alias("r2"))
    )
    return (
        rows.join(F.broadcast(top), "planta_canon")
        .groupBy("planta_canon", "pendiente", "r2", "punto_nro", "nombre_punto")
        .agg(to_numeric(exact_avg(value())).alias("promedio_punto"))
    )


# --- maintenance -------------------------------------------------------------


def _latest_done(mart: DataFrame, cols: Sequence[str], maquina: str | None, punto: int | None) -> DataFrame:
    """Latest done order: of everything the pattern matches, or of each machine when none is given."""
    rows = _optional(_machine(mart.where(F.col("cumpl_prog") == DONE), maquina), punto_nro=punto)
    if maquina is not None:
        order = [F.desc("anio"), F.desc("semana_nro"), F.asc("equipo_denom"), F.asc("orden_nro"), F.asc("punto_nro")]
        return rows.orderBy(*order).limit(1).select(*cols)
    order = [-F.col("anio"), -F.col("semana_nro"), F.col("orden_nro"), F.col("punto_nro")]
    return best_of(rows, ["equipo_denom"], order, cols)


def last_maintenance(mart: DataFrame, maquina: str | None = None, punto: int | None = None) -> DataFrame:
    return _latest_done(
        mart,
        ["punto_nro", "nombre_punto", "equipo_denom", "orden_nro", "ot_texto_breve", "inicio_programado", "anio",
         "semana_nro", "hh_reales", "responsable_nombre", "planta_canon"],
        maquina,
        punto,
    )


def who_maintained(mart: DataFrame, maquina: str | None = None, punto: int | None = None) -> DataFrame:
    return _optional(_machine(mart.where(F.col("cumpl_prog") == DONE), maquina), punto_nro=punto).select(
        "punto_nro", "nombre_punto", "equipo_denom", "orden_nro", "anio", "semana_nro", "responsable_nombre",
        "planta_canon",
    )


def staff(mart: DataFrame, orden: str | None = None, maquina: str | None = None, punto: int | None = None) -> DataFrame:
    return _optional(_order_or_machine(mart, orden, maquina), punto_nro=punto).select(
        "punto_nro", "nombre_punto", "orden_nro", "equipo_denom", "anio", "semana_nro",
        F.col("personal_real").alias("personas_que_trabajaron"),
        F.col("personal_prog").alias("personas_planificadas"),
        "planta_canon",
    )


def last_maintenance_date(mart: DataFrame, maquina: str | None = None, punto: int | None = None) -> DataFrame:
    cols = ["punto_nro", "nombre_punto", "equipo_denom", "orden_nro", "inicio_programado", "anio", "semana_nro",
            "planta_canon"]
    return _latest_done(mart, cols, maquina, punto).withColumnRenamed("inicio_programado", "fecha_planificada")


def planned_versus_real(
    mart: DataFrame, orden: str | None = None, maquina: str | None = None, punto: int | None = None
) -> DataFrame:
    return _optional(_order_or_machine(mart, orden, maquina), punto_nro=punto).select(
        "punto_nro", "nombre_punto", "orden_nro", "equipo_denom", "ot_texto_breve", "anio", "semana_nro",
        "hh_planificadas", "hh_reales", "duracion_planificada", "duracion_real",
        (F.col("hh_reales") - F.col("hh_planificadas")).alias("desviacion_hh"),
        "planta_canon",
    )


def rescheduled(
    mart: DataFrame, orden: str | None = None, maquina: str | None = None, punto: int | None = None
) -> DataFrame:
    rows = _order_or_machine(mart, orden, maquina).where(F.col("fecha_reprogramacion").isNotNull())
    return _optional(rows, punto_nro=punto).select(
        "punto_nro", "nombre_punto", "orden_nro", "equipo_denom", "ot_texto_breve",
        F.col("inicio_programado").alias("fecha_original"),
        "motivo_no_ejecucion", "fecha_reprogramacion", "anio", "semana_nro", "planta_canon",
    )


def not_maintained_on_time(mart: DataFrame, punto: int | None = None) -> DataFrame:
    return _optional(mart.where(F.col("cumpl_prog") == 0), punto_nro=punto).select(
        "punto_nro", "nombre_punto", "equipo_denom", "ubicacion_tecnica", "tipo_equipo", "familia_equipo",
        "planta_canon", "orden_nro", "ot_texto_breve",
        F.col("inicio_programado").alias("fecha_programada"),
        "motivo_no_ejecucion", "fecha_reprogramacion", "anio", "semana_nro",
    )


def orders_in_progress(
    mart: DataFrame, anio: int | None = None, semana: int | None = None, punto: int | None = None
) -> DataFrame:
    """Open orders of the given week, or of the latest week of the mart when none is given."""
    rows = mart.where(F.col("cumpl_prog").isNull() | (F.col("cumpl_prog") == 0))
    rows = in_latest_week(rows) if anio is None or semana is None else _optional(rows, anio=anio, semana_nro=semana)
    return _optional(rows, punto_nro=punto).select(
        "punto_nro", "nombre_punto", "orden_nro", "ot_texto_breve", "equipo_denom", "planta_canon",
        "inicio_programado", "anio", "semana_nro",
    )


def work_of_orders(mart: DataFrame, ordenes: Sequence[str] | None = None, punto: int | None = None) -> DataFrame:
    rows = mart if ordenes is None else mart.where(F.col("orden_nro").isin(*ordenes))
    return _optional(rows, punto_nro=punto).select(
        "punto_nro", "nombre_punto", "orden_nro", "ot_texto_breve", "equipo_denom", "ubicacion_tecnica",
        "planta_canon", "tipo_equipo", "inicio_programado", "hh_planificadas", "anio", "semana_nro",
    )


# --- earlier questions -------------------------------------------------------


def over_limit_last_session(mart: DataFrame) -> DataFrame:
    """Points over the limit in each plant's own latest week, with band and times over the limit."""
    rows = mart.where(is_measured())
    limit = internal_limit()
    latest = rows.groupBy("planta_canon").agg(F.max(week_key()).alias("_clave"))
    return (
        rows.where(value() >= limit)
        .withColumn("_clave", week_key())
        .join(latest, ["planta_canon", "_clave"], "left_semi")
        .select(
            "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "concentracion_mg_m3",
            band_of(value()).alias("etiqueta_semaforo"),
            F.lit(limit).alias("limite_interno_mg_m3"),
            F.round(value() / limit, 2).alias("veces_sobre_limite"),
        )
    )


def plant_peak(mart: DataFrame) -> DataFrame:
    """What was going on at each plant's highest measurement ever."""
    cols = ["planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "fecha_medicion", "concentracion_mg_m3",
            "operador_panel", "tecnico_higiene", "hora_inicio", "hora_termino"]
    order = [-value(), F.col("anio"), F.col("semana_nro"), F.col("punto_nro")]
    return best_of(mart.where(is_measured()), ["planta_canon"], order, cols)


def last_session(mart: DataFrame) -> DataFrame:
    """Every measurement of the latest week over all plants, with its band."""
    return in_latest_week(mart.where(is_measured())).select(
        "planta_canon", "punto_nro", "nombre_punto", "anio", "semana_nro", "concentracion_mg_m3",
        band_of(value()).alias("etiqueta_semaforo"), "operador_panel", "tecnico_higiene",
    )


# --- registry ----------------------------------------------------------------


@dataclass(frozen=True)
class Question:
    """A question over one mart: its answer, order, chunk key, labels and personal fields."""

    id: str
    mart: str
    answer: Callable[..., DataFrame]
    key: tuple[str, ...]
    scope: str
    order: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()
    min_rows: int = 1
    max_rows: int = 50

    @property
    def template(self):
        return TEMPLATES[self.id]

    @property
    def dimensions(self) -> Mapping[str, str]:
        return {"planta": "column:planta_canon", "ambito": self.scope, "clasificacion": ""}

    def run(self, marts: Mapping[str, DataFrame], ordered: bool = True, **params) -> DataFrame:
        rows = self.answer(marts[self.mart], **params)
        if not ordered or not self.order:
            return rows
        return rows.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in self.order])

    def chunks(self, rows: DataFrame, run_id: str, created: Column, salt: str) -> DataFrame:
        missing = [c for c in (*self.key, "planta_canon") if c not in rows.columns]
        if missing:
            raise ValueError(f"{self.id} does not output {missing}, which its chunks need")
        return build_chunks(
            rows, self.id, self.mart, self.key, self.template, self.dimensions, self.pii, run_id, created, salt
        )


_POINT_WEEK = ("punto_nro", *WEEK)
_ORDER_POINT = ("orden_nro", "punto_nro", *WEEK)
_NEWEST = ("-anio", "-semana_nro", "orden_nro", "punto_nro")

QUESTIONS = {
    q.id: q
    for q in (
        Question("P1", "ranking_semanal", highest_point, ("planta_canon", *_POINT_WEEK), SCOPE_INSPECTION),
        Question("P2", "ranking_semanal", lowest_point, ("planta_canon", *_POINT_WEEK), SCOPE_INSPECTION),
        Question("P3", "promedios_planta", plant_average, ("planta_canon",), SCOPE_INSPECTION, ("planta_canon",)),
        Question("P4", "promedios_planta", all_plants_average, ("planta_canon",), SCOPE_INSPECTION, ("planta_canon",)),
        Question("P5", "promedios_planta", highest_plant, ("planta_canon",), SCOPE_INSPECTION),
        Question("P6", "promedios_planta", lowest_plant, ("planta_canon",), SCOPE_INSPECTION),
        Question("P7", "causa_raiz", why_high, (*_POINT_WEEK, "tipo_causa", "ot_relacionada", "condicion_codigo"),
                 "column:ambito", ("punto_nro", "-es_causa_principal", "-peso_causa", "ot_relacionada", "condicion_codigo")),
        Question("P8", "causa_raiz", why_not_maintained, ("ot_relacionada", *_POINT_WEEK), "column:ambito",
                 ("-anio", "-semana_nro", "ot_relacionada", "punto_nro")),
        Question("P9", "detalle_medicion", when_measured, _POINT_WEEK, SCOPE_INSPECTION, ("punto_nro", *WEEK)),
        Question("P10", "detalle_medicion", who_measured, _POINT_WEEK, SCOPE_INSPECTION, ("punto_nro", *WEEK),
                 ("operador_panel", "tecnico_higiene")),
        Question("P11", "detalle_medicion", why_not_measured, _POINT_WEEK, SCOPE_INSPECTION,
                 ("planta_canon", *_POINT_WEEK)),
        Question("P12", "cobertura_semanal", machines_measured, _POINT_WEEK, SCOPE_INSPECTION,
                 ("planta_canon", "maquina_gen_nombre", "punto_nro")),
        Question("P13", "ventanas_temporales", high_window, ("planta_canon", "anio", "semana_inicio"), SCOPE_INSPECTION),
        Question("P14", "ventanas_temporales", high_span, ("punto_nro", "anio"), SCOPE_INSPECTION, ("punto_nro", "anio")),
        Question("P15", "ventanas_temporales", low_span, ("punto_nro", "anio"), SCOPE_INSPECTION, ("punto_nro", "anio")),
        Question("P16", "ventanas_temporales", low_window, ("planta_canon", "anio", "semana_inicio"), SCOPE_INSPECTION),
        Question("P17", "tendencias", rising_plant, ("planta_canon", "punto_nro"), SCOPE_INSPECTION,
                 ("-promedio_punto", "punto_nro")),
        Question("P18", "ejecucion_ot", last_maintenance, ("orden_nro", *WEEK), SCOPE_MAINTENANCE,
                 pii=("responsable_nombre",)),
        Question("P19", "ejecucion_ot", who_maintained, _ORDER_POINT, SCOPE_MAINTENANCE, _NEWEST, ("responsable_nombre",)),
        Question("P20", "ejecucion_ot", staff, _ORDER_POINT, SCOPE_MAINTENANCE),
        Question("P21", "ejecucion_ot", last_maintenance_date, ("orden_nro", *WEEK), SCOPE_MAINTENANCE),
        Question("P22", "ejecucion_ot", planned_versus_real, _ORDER_POINT, SCOPE_MAINTENANCE, _NEWEST),
        Question("P23", "no_ejecucion_ot", rescheduled, _ORDER_POINT, SCOPE_MAINTENANCE),
        Question("P24", "no_ejecucion_ot", not_maintained_on_time, _ORDER_POINT, SCOPE_MAINTENANCE,
                 ("-anio", "-semana_nro", "planta_canon", "equipo_denom", "orden_nro", "punto_nro")),
        Question("P25", "ot_en_curso", orders_in_progress, _ORDER_POINT, SCOPE_MAINTENANCE,
                 ("inicio_programado", "orden_nro", "punto_nro")),
        Question("P26", "ot_en_curso", work_of_orders, _ORDER_POINT, SCOPE_MAINTENANCE, ("orden_nro", "punto_nro")),
    )
}

EARLIER_QUESTIONS = {
    "B1": ("ranking_semanal", over_limit_last_session),
    "B3": ("detalle_medicion", plant_peak),
    "B4": ("detalle_medicion", last_session),
}
