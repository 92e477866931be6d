"""ISO week calendar and the full grid of points and weeks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.functions.columns import iso_week, iso_year, measured_state, unmeasured_reason
from airgauge.session import grown


def monday(c: Column) -> Column:
    return F.trunc(c.cast("date"), "week")


def _week_columns() -> list[Column]:
    start, end = F.col("fecha_inicio_semana"), F.date_add(F.col("fecha_inicio_semana"), 6)
    return [
        iso_year(start).alias("anio"),
        iso_week(start).alias("semana_nro"),
        start.alias("fecha_inicio_semana"),
        end.alias("fecha_fin_semana"),
        # quarter and month are those of the Sunday that ends the week
        F.quarter(end).alias("trimestre"),
        F.month(end).alias("mes"),
    ]


def _mondays(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(monday(first), monday(last), F.expr("interval 7 days")))


def iso_calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per ISO week from the week of `first` to the week of `last`."""
    return (
        spark.range(1)
        .select(_mondays(F.lit(first), F.lit(last)).alias("fecha_inicio_semana"))
        .select(*_week_columns())
    )


def with_weeks_of(calendar: DataFrame, days: DataFrame) -> DataFrame:
    """`calendar`, and the weeks it lacks of the days in the only column of `days`; NULL days have none."""
    met = days.select(monday(F.col(days.columns[0])).alias("fecha_inicio_semana")).where(F.col("fecha_inicio_semana").isNotNull())
    return calendar.select("fecha_inicio_semana").unionByName(met).distinct().select(*_week_columns())


def day_of_week(year: Column, week: Column) -> Column:
    """The Monday of an ISO week; NULL where there is no such number."""
    real = year.between(1, 9999) & week.between(1, 53)
    return F.when(real, F.date_add(monday(F.make_date(year, F.lit(1), F.lit(4))), (week.cast("int") - 1) * 7))


def week_grid(points: DataFrame, first: date, last: date) -> DataFrame:
    """Every point with every week. Each point row expands in place: no join, no shuffle."""
    return points.select("*", _mondays(F.lit(first), F.lit(last)).alias("fecha_inicio_semana")).select(
        *points.columns, *_week_columns()
    )


def densify(fact: DataFrame, points: DataFrame, first: date, last: date, value: str = "concentracion_mg_m3") -> DataFrame:
    """Measured facts plus a `no_medido` row for every missing (point, week).

    `points` holds one row per point; `fact` one row per (point, year, week), so
    the join keys are unique on both sides and cannot be skewed. Facts of other
    points or weeks stay, with NULL in what only the grid knows.
    """
    keys = ["punto_nro", "anio", "semana_nro"]
    grid = week_grid(points, first, last)
    extra = [c for c in fact.columns if c not in grid.columns and c not in ("estado", "motivo_no_medicion")]
    return grid.join(fact.select(*keys, *extra), keys, "full").select(
        *grid.columns,
        *extra,
        measured_state(F.col(value)).alias("estado"),
        unmeasured_reason(F.col(value)).alias("motivo_no_medicion"),
    )


def missing_cells(fact: DataFrame, points: DataFrame, first: date, last: date, known: DataFrame | None = None) -> DataFrame:
    """The `no_medido` rows a load adds to its facts: cells of the grid that neither it nor the store has.

    `known` holds the (point, year, week) that are stored, of the weeks from `first` to `last` at least. Such
    a cell keeps what it is: a stored reading is not taken back because a later batch does not bring it again,
    and a stored `no_medido` is closed by the version that its reading makes when it arrives.
    Columns that only facts have are NULL.
    """
    keys = ["punto_nro", "anio", "semana_nro"]
    spark = points.sparkSession
    # points are few bytes, which Spark would gather in few tasks, but each has all weeks
    each = points.select("punto_nro").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "punto_nro").distinct()
    grid = week_grid(each, first, last).join(grown(fact.select(*keys)), keys, "left_anti")
    if known is not None:
        grid = grid.join(grown(known.select(*keys)), keys, "left_anti")
    # what else is known of a point is not shuffled with its weeks, but added to those that are left
    grid = grid.withColumnRenamed("punto_nro", "_p")
    return _as_facts(points.join(grown(grid), F.col("punto_nro").eqNullSafe(F.col("_p"))), fact)


def withdrawn_cells(fact: DataFrame, points: DataFrame, blank: DataFrame, known: DataFrame) -> DataFrame:
    """The `no_medido` rows of stored cells that a load names but leaves blank: a corrected sheet takes a reading back.

    `blank` and `known` hold (point, year, week): cells that the load's sheets have without a value, and stored cells.
    A cell that `fact` has a reading for all the same is none of them. Of cells that are `no_medido` already the row
    has the content they have, so it makes no version.
    """
    keys = ["punto_nro", "anio", "semana_nro"]
    cells = blank.select(*keys).distinct().join(grown(fact.select(*keys)), keys, "left_anti").join(grown(known.select(*keys)), keys, "left_semi")
    dated = cells.withColumn("fecha_inicio_semana", day_of_week(F.col("anio"), F.col("semana_nro")))
    return _as_facts(points.join(grown(dated.select(*keys, *_week_columns()[2:])), "punto_nro"), fact)


def _as_facts(cells: DataFrame, fact: DataFrame) -> DataFrame:
    """Cells without a reading in the columns of `fact`."""
    filled = {"estado": measured_state(F.lit(None)), "motivo_no_medicion": unmeasured_reason(F.lit(None))}
    kinds = {f.name: f.dataType for f in fact.schema.fields}
    own = {c: F.col(c) if c in cells.columns else filled.get(c, F.lit(None)) for c in fact.columns}
    return cells.select(*[x.cast(kinds[c]).alias(c) for c, x in own.items()])
