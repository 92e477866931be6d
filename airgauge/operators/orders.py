"""Work-order sheets to one common order format."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.functions import columns as c

# Column names of an order sheet.
ORDER_COLUMNS = {
    "orden": "Orden",
    "equipo_denom": "Denominación",
    "ot_texto_breve": "Txt.brv.",
    "responsable": "Responsable",
    "pto_trabajo_ejecutor": "Pto.Trab.Ejecutor",
    "hh_planificadas": "HorasHombreProg.",
    "duracion_planificada": "DuraciónProg.",
    "personal_prog": " PersonalProg",
    "hh_reales": "HorasHombreReal",
    "duracion_real": "DuraciónReal",
    "personal_real": "PersonalReal",
    "cumpl_prog": "CumplProg",
    "adherencia_prog": "AdherenciaProg",
    "fecha_inicio_extrema": "FechaInicMásTmp",
}

# Reasons for not executing an order, with their weights.
REASONS = (
    ("Falta de repuestos", 0.9),
    ("Falta de personal", 0.7),
    ("Reprogramado por operaciones", 0.5),
    ("Equipo en uso productivo", 0.6),
)

TEXTS = ("equipo_denom", "ot_texto_breve", "responsable", "pto_trabajo_ejecutor", "fecha_inicio_extrema")
DOUBLES = ("hh_planificadas", "duracion_planificada", "hh_reales", "duracion_real", "adherencia_prog")
INTEGERS = ("personal_prog", "personal_real", "cumpl_prog")
ABSENT_TEXTS = ("fecha_liberacion", "clase_orden", "clase_actividad_pm", "status_sistema")


@dataclass(frozen=True)
class OrderSheet:
    """What a sheet's numbers mean: its day columns, its shift and its week label."""

    day_columns: Mapping[str, date]
    year: int
    week: int
    shift_days: int = -14
    reschedule_days: int = 7
    columns: Mapping[str, str] = field(default_factory=lambda: ORDER_COLUMNS)
    reasons: Sequence[tuple[str, float]] = REASONS


def reason_of(key: Column, reasons: Sequence[tuple[str, float]] = REASONS) -> Column:
    return c.pick_by_hash(key, [name for name, _ in reasons])


def weight_of(key: Column, reasons: Sequence[tuple[str, float]] = REASONS) -> Column:
    return c.pick_by_hash(key, [float(weight) for _, weight in reasons])


def normalize_orders(df: DataFrame, sheet: OrderSheet, source: str = "") -> DataFrame:
    """One pass over the sheet: a filter on the order number and projections."""

    def cell(name: str) -> Column:
        return F.col(f"`{sheet.columns[name]}`")

    first = next(iter(sheet.day_columns.values()))
    base = df.where(cell("orden").isNotNull() & (F.trim(cell("orden").cast("string")) != "")).select(
        c.clean_key(cell("orden")).alias("orden_nro"),
        *[c.blank_to_null(cell(t)).alias(t) for t in TEXTS],
        *[c.to_double(cell(d)).alias(d) for d in DOUBLES],
        *[c.to_int(cell(i)).alias(i) for i in INTEGERS],
        c.shift_days(c.first_day(sheet.day_columns, first), sheet.shift_days).alias("dia_programado"),
    )
    not_done = F.col("cumpl_prog") == 0
    return base.select(
        *[x for x in base.columns if x != "dia_programado"],
        F.lit(sheet.year).alias("anio"),
        F.lit(sheet.week).alias("semana_nro"),
        F.col("dia_programado").alias("inicio_programado"),
        # the day the work was really done is known only for a done order
        F.when(F.col("cumpl_prog") == 1, F.col("dia_programado")).alias("dia_ejecutado"),
        F.when(not_done, reason_of(F.col("orden_nro"), sheet.reasons)).alias("motivo_no_ejecucion"),
        F.when(not_done, weight_of(F.col("orden_nro"), sheet.reasons)).alias("peso_motivo"),
        F.when(not_done, F.date_add(F.col("dia_programado"), sheet.reschedule_days)).alias("fecha_reprogramacion"),
        F.col("equipo_denom").alias("denom_ubic_tecnica"),
        *[F.lit(None).cast("string").alias(t) for t in ABSENT_TEXTS],
        F.lit(source).alias("_bronce_fuente"),
        c.utc_now().alias("_bronce_loaded_at"),
    )


def resolve_machine(
    orders: DataFrame,
    catalog: DataFrame,
    name: str = "equipo_denom",
    also_on: Sequence[str] = (),
) -> DataFrame:
    """Machine and plant of an order by the machine's name.

    A name that stands for several machines (within `also_on`, such as the
    sheet's plant) resolves to none: the order stays, with no machine, and is
    marked. Otherwise it would be counted once per namesake.
    """
    norm = "_nombre_norm"
    names = (
        catalog.withColumn(norm, c.norm_text(F.col(name)))
        .groupBy(norm, *also_on)
        .agg(
            F.count(F.lit(1)).alias("_veces"),
            *[F.min(x).alias(x) for x in ("ubicacion_tecnica", "planta_canon") if x not in also_on],
        )
    )
    single = F.col("_veces") == 1
    return (
        orders.withColumn(norm, c.norm_text(F.col(name)))
        .join(names, [norm, *also_on], "left")
        .select(
            *orders.columns,
            *[F.when(single, F.col(x)).alias(x) for x in ("ubicacion_tecnica", "planta_canon") if x not in also_on],
            F.coalesce(F.col("_veces") > 1, F.lit(False)).alias("nombre_ambiguo"),
        )
    )
