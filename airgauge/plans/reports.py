"""Governed reports and banded KPIs over the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.functions.bands import internal_limit, kpi_severity, limit_state
from airgauge.functions.columns import exact_avg, to_numeric
from airgauge.operators.governance import governed
from airgauge.plans.frames import MEASURED
from airgauge.plans.questions import in_latest_week, value

# Slopes within this many mg/m3 per week of zero count as stable.
STABLE_SLOPE = 0.005

# Names of the reports, their marts and the governed column of each.
REPORTS = {
    "concentracion_anual": ("cobertura_semanal", {"planta": "planta"}),
    "ot_no_ejecutadas": ("no_ejecucion_ot", {"planta": "planta_canon"}),
    "tendencias_planta": ("tendencias", {"planta": "planta_canon"}),
}


def distinct_weeks(week: Column) -> Column:
    """Distinct week numbers of a group, exactly: one bit per week in a single long."""
    return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), week)))


def annual_concentration(mart: DataFrame, anio: int | None = None) -> DataFrame:
    """Per plant and year: weeks, points, average, extremes and share over the limit."""
    rows = mart.where(F.col("estado") == MEASURED)
    if anio is not None:
        rows = rows.where(F.col("anio") == anio)
    limit = internal_limit()
    over = F.count(F.when(value() >= limit, 1))
    total = F.count(F.lit(1))
    return rows.groupBy(F.col("planta_canon").alias("planta"), "anio").agg(
        distinct_weeks(F.col("semana_nro")).cast("bigint").alias("semanas_medidas"),
        F.countDistinct("punto_nro").alias("puntos_medidos"),
        to_numeric(exact_avg(value())).alias("concentracion_promedio_mg_m3"),
        to_numeric(F.max(value())).alias("concentracion_max_mg_m3"),
        to_numeric(F.min(value())).alias("concentracion_min_mg_m3"),
        over.alias("registros_sobre_limite"),
        total.alias("total_registros"),
        F.round(over * 100.0 / total, 2).alias("pct_sobre_limite"),
        F.lit(limit).alias("limite_interno_mg_m3"),
    )


def unexecuted_orders(mart: DataFrame, anio: int | None = None, semana: int | None = None) -> DataFrame:
    """Orders not done, once each (the mart repeats an order per covered point)."""
    rows = mart.where(F.col("cumpl_prog") == 0)
    if anio is not None:
        rows = rows.where(F.col("anio") == anio)
    if semana is not None:
        rows = rows.where(F.col("semana_nro") == semana)
    return rows.select(
        "orden_nro", "ot_texto_breve", "equipo_denom", "ubicacion_tecnica", "tipo_equipo",
        F.col("familia_equipo").alias("familia"),
        "planta_canon", "anio", "semana_nro", "inicio_programado", "motivo_no_ejecucion", "fecha_reprogramacion",
    ).distinct()


def trend_label(slope: Column, stable: float = STABLE_SLOPE) -> Column:
    return (
        F.when(slope > stable, F.lit("creciente"))
        .when(slope < -stable, F.lit("decreciente"))
        .when(slope.isNotNull(), F.lit("estable"))
    )


def plant_trends(mart: DataFrame, anio: int | None = None) -> DataFrame:
    """Per plant and year: slope over weekly averages, fit, label, points and average.

    Weekly sums are kept, so the yearly average needs no second pass over the mart;
    points are counted from (plant, year, point) groups.
    """
    rows = mart.where(F.col("estado") == MEASURED)
    if anio is not None:
        rows = rows.where(F.col("anio") == anio)
    weekly = rows.groupBy("planta_canon", "anio", "semana_nro").agg(
        F.sum(value().cast("decimal(18,6)")).alias("suma"), F.count(value()).alias("n")
    )
    trend = (
        weekly.withColumn("prom", F.col("suma").cast("double") / F.col("n"))
        .groupBy("planta_canon", "anio")
        .agg(
            F.regr_slope("prom", "semana_nro").alias("pendiente"),
            F.regr_r2("prom", "semana_nro").alias("r2"),
            to_numeric(F.sum("suma").cast("double") / F.sum("n")).alias("promedio_planta_mg_m3"),
            F.count(F.lit(1)).alias("semanas"),
        )
    )
    points = rows.groupBy("planta_canon", "anio").agg(F.countDistinct("punto_nro").alias("n_puntos"))
    slope = F.round(F.when(F.col("semanas") >= 2, F.col("pendiente")), 6)
    return trend.join(points, ["planta_canon", "anio"]).select(
        "planta_canon",
        "anio",
        slope.alias("pendiente_mg_m3_por_semana"),
        F.round(F.when(F.col("semanas") >= 2, F.col("r2")), 6).alias("r2"),
        trend_label(slope).alias("tendencia"),
        "n_puntos",
        "promedio_planta_mg_m3",
    )


def report(
    name: str, marts: Mapping[str, DataFrame], grants: DataFrame, user_id: str, **params
) -> DataFrame:
    """A report as one user sees it. The rows are filtered before anything is aggregated."""
    mart_name, dims = REPORTS[name]
    build = {
        "concentracion_anual": annual_concentration,
        "ot_no_ejecutadas": unexecuted_orders,
        "tendencias_planta": plant_trends,
    }[name]
    visible = governed(marts[mart_name], grants, user_id, {d: "planta_canon" for d in dims}, tuple(dims))
    order = {
        "concentracion_anual": [F.asc("planta"), F.asc("anio")],
        "ot_no_ejecutadas": [F.asc("planta_canon"), F.desc("anio"), F.desc("semana_nro"), F.asc("orden_nro")],
        "tendencias_planta": [F.desc("pendiente_mg_m3_por_semana"), F.asc("planta_canon"), F.asc("anio")],
    }[name]
    return build(visible, **params).orderBy(*order)


# --- KPIs --------------------------------------------------------------------


def kpi_max_last_session(mart: DataFrame) -> DataFrame:
    """Concentration of every point in the latest session, with limit state and severity."""
    return in_latest_week(mart.where(F.col("estado") == MEASURED)).select(
        F.col("planta_canon").alias("planta"),
        F.col("nombre_punto").alias("punto_evaluacion"),
        "punto_nro",
        value().alias("valor_actual"),
        limit_state(value()).alias("estado_limite"),
        F.lit(internal_limit()).alias("limite_interno_mg_m3"),
        "anio",
        F.col("semana_nro").alias("semana"),
        kpi_severity(value(), "concentracion-maxima-ultima-jornada").alias("nivel"),
    )


def kpi_percent_over_limit(mart: DataFrame) -> DataFrame:
    return annual_concentration(mart).select(
        "planta",
        "anio",
        F.col("pct_sobre_limite").alias("valor_actual"),
        "registros_sobre_limite",
        "total_registros",
        "limite_interno_mg_m3",
        kpi_severity(F.col("pct_sobre_limite"), "pct-sobre-limite-anual").alias("nivel"),
    )


def kpi_critical_points(mart: DataFrame) -> DataFrame:
    """Points over the limit in the latest session, per plant; plants with none show 0."""
    rows = in_latest_week(mart.where(F.col("estado") == MEASURED))
    over = F.count(F.when(value() >= internal_limit(), 1))
    return rows.groupBy(F.col("planta_canon").alias("planta")).agg(
        over.alias("valor_actual"),
        F.count(F.lit(1)).alias("puntos_totales"),
        kpi_severity(over.cast("double"), "puntos-criticos-ultima-jornada").alias("nivel"),
    )


KPIS = {
    "concentracion_maxima_ultima_jornada": kpi_max_last_session,
    "pct_sobre_limite_anual": kpi_percent_over_limit,
    "puntos_criticos_ultima_jornada": kpi_critical_points,
}


def kpi(name: str, mart: DataFrame, grants: DataFrame, user_id: str) -> DataFrame:
    """A KPI as one user sees it: the coverage rows of other plants are gone before its session is found."""
    return KPIS[name](governed(mart, grants, user_id, {"planta": "planta_canon"}, ("planta",)))
