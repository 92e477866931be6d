"""Wide measurement sheets to long rows, and joins on normalised text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airgauge.functions.columns import blank_to_null, norm_text, to_date, to_double, to_int

# Row labels of a measurement sheet.
WEEK_LABELS = ("Semanas", "Semana")
IGNORED_LABEL = "Lugar Monitoreo"
DATE_PREFIX = "Fecha"
HOUR_PREFIX = "Hora"
START_LABEL = "Hora inicio"
END_LABEL = "Hora termino"
OPERATOR_MARK = "Operador"
TECHNICIAN_MARKS = ("Tecnico", "Técnico")
WEEK_COLUMN = re.compile(r"^column\d+$")

LABEL = "etiqueta"
POSITION = "_col_posicion"
CELL = "valor"


def exclude(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def week_columns(df: DataFrame) -> list[str]:
    """Week columns found by name, so a sheet that grew needs no new code."""
    return [c for c in df.columns if WEEK_COLUMN.match(c)]


def unpivot_wide(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """One row per (ids, column) with its text; empty cells are dropped."""
    cols = list(values) if values is not None else [c for c in df.columns if c not in ids]
    texts = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return texts.unpivot(list(ids), cols, POSITION, CELL).where(F.col(CELL).isNotNull())


def union_sheets(sheets: Sequence[DataFrame]) -> DataFrame:
    """Sheets stacked by column name; sheets with fewer weeks get empty cells."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sheets)


def _label() -> Column:
    return F.trim(F.col(LABEL))


def _is_operator() -> Column:
    return _label().contains(OPERATOR_MARK)


def _is_technician() -> Column:
    return reduce(lambda a, b: a | b, [_label().contains(m) for m in TECHNICIAN_MARKS])


def is_header_row() -> Column:
    """Rows that describe a column rather than hold measurements."""
    return (
        _label().isin(*WEEK_LABELS, IGNORED_LABEL, "")
        | _is_operator()
        | _is_technician()
        | _label().startswith(HOUR_PREFIX)
        | _label().startswith(DATE_PREFIX)
    )


def header_rows(long: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Week number of each column, from the week rows."""
    week = to_int(F.col(CELL))
    return long.where(_label().isin(*WEEK_LABELS) & week.isNotNull()).select(
        *ids, POSITION, week.alias("semana_nro")
    )


def _when_label(condition: Column) -> Column:
    return F.max(F.when(condition, F.col(CELL)))


def _metadata_aggregates() -> list[Column]:
    return [
        _when_label(_label().startswith(DATE_PREFIX)).alias("fecha_str"),
        _when_label(_is_operator()).alias("operador_alias"),
        _when_label(_is_technician()).alias("tecnico_alias"),
        _when_label(_label() == START_LABEL).alias("hora_inicio"),
        _when_label(_label() == END_LABEL).alias("hora_termino"),
    ]


def pivot_metadata(long: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Date, people and hours of each column, one row per (ids, column)."""
    return long.where(is_header_row()).groupBy(*ids, POSITION).agg(*_metadata_aggregates())


def value_rows(long: DataFrame, ids: Sequence[str] = (), low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Measurement cells: numeric, low <= value < high, label not a header."""
    value = to_double(F.col(CELL))
    return long.where(~is_header_row() & (value >= low) & (value < high)).select(
        *ids,
        POSITION,
        _label().alias("punto_evaluacion"),
        value.alias("concentracion_mg_m3"),
    )


def position_number(position: Column) -> Column:
    return F.regexp_extract(position, r"(\d+)$", 1).cast("int")


def year_from_position(position: Column, first_year: int = 2025, weeks_in_first_year: int = 52) -> Column:
    """Year of a week column by its place; a mistyped date cannot move it."""
    return F.when(position_number(position) <= weeks_in_first_year, F.lit(first_year)).otherwise(
        F.lit(first_year + 1)
    )


def header_years(header: DataFrame, ids: Sequence[str] = (), first_year: Column | int = 2025) -> DataFrame:
    """Header rows (ids, position, semana_nro) with `anio`, for any number of years.

    Column 1 is in `first_year`, and a sheet whose first columns are missing starts as many years later as
    they fill; given as a Column, it is the year of the first column that is there. Where the week number falls by more than half a year from one column to the next, a new year
    begins; smaller steps back are slips of the pen. The pass over the columns of a sheet is a window over its
    header, which is as long as the sheet is wide.
    """
    place = position_number(F.col(POSITION))
    along = Window.partitionBy(*ids).orderBy(place)
    first = first_year if isinstance(first_year, Column) else F.lit(first_year) + F.floor((F.min(place).over(along) - 1) / 52)
    fell = F.lag("semana_nro").over(along) - F.col("semana_nro") > 26
    marked = header.withColumn("_nuevo", F.when(fell, 1).otherwise(0))
    year = (first + F.sum("_nuevo").over(along)).cast("int")
    return marked.withColumn("anio", year).drop("_nuevo")


def _columns_header(long: DataFrame, ids: Sequence[str], year: Column | None, first_year: Column | int) -> DataFrame:
    """One row per (ids, column) that names a week: its week, year, date, people and hours."""
    is_week = _label().isin(*WEEK_LABELS)
    header = (
        long.where(is_header_row())
        .groupBy(*ids, POSITION)
        .agg(F.max(F.when(is_week, to_int(F.col(CELL)))).alias("semana_nro"), *_metadata_aggregates())
        .where(F.col("semana_nro").isNotNull())
    )
    return header_years(header, ids, first_year) if year is None else header.withColumn("anio", year)


def melt_sheet(
    sheet: DataFrame,
    ids: Sequence[str] = ("planta",),
    year: Column | None = None,
    low: float = 0.0,
    high: float = 100.0,
    first_year: Column | int = 2025,
) -> DataFrame:
    """Whole sheets, already stacked and tagged by `ids`, to long measurements.

    All sheets melt in one plan. Header rows are reduced to one row per column
    first, so the join side is (sheets x weeks) rows however many points there are.
    The year of a column is `year` if given; else it follows from the order of the weeks.
    """
    long = unpivot_wide(sheet, [*ids, LABEL], week_columns(sheet))
    header = _columns_header(long, ids, year, first_year)
    return value_rows(long, ids, low, high).join(header, [*ids, POSITION]).select(
        *ids,
        "punto_evaluacion",
        "anio",
        "semana_nro",
        "concentracion_mg_m3",
        to_date(F.col("fecha_str")).alias("fecha_medicion"),
        blank_to_null(F.col("operador_alias")).alias("operador_alias"),
        blank_to_null(F.col("tecnico_alias")).alias("tecnico_alias"),
        "hora_inicio",
        "hora_termino",
        POSITION,
    )


def unfilled_cells(
    sheet: DataFrame,
    ids: Sequence[str] = ("planta",),
    year: Column | None = None,
    low: float = 0.0,
    high: float = 100.0,
    first_year: Column | int = 2025,
) -> DataFrame:
    """Cells that sheets name, by a point's row and a column's week, without a value that counts: blank, no number, out of range.

    What `melt_sheet` leaves out of the same rows and columns: (ids, punto_evaluacion, anio, semana_nro).
    """
    weeks = week_columns(sheet)
    whole = sheet.select(*ids, LABEL, *[F.coalesce(F.col(w).cast("string"), F.lit("")).alias(w) for w in weeks])
    long = unpivot_wide(whole, [*ids, LABEL], weeks)
    value = to_double(F.col(CELL))
    counts = F.coalesce((value >= low) & (value < high), F.lit(False))
    cells = long.where(~is_header_row() & ~counts).select(*ids, POSITION, _label().alias("punto_evaluacion"))
    header = _columns_header(long, ids, year, first_year).select(*ids, POSITION, "anio", "semana_nro")
    return cells.join(header, [*ids, POSITION]).select(*ids, "punto_evaluacion", "anio", "semana_nro")


def join_normalized(
    left: DataFrame,
    right: DataFrame,
    left_col: str,
    right_col: str,
    how: str = "left",
    also_on: Sequence[str] = (),
) -> DataFrame:
    """Join on text that differs only in case and blanks. Drops the right text column.

    No broadcast hint: Catalyst compares the side's size with its own threshold,
    and AQE splits a hot label when the join has to shuffle.
    """
    key = "_texto_norm"
    l = left.withColumn(key, norm_text(F.col(left_col)))
    r = right.withColumn(key, norm_text(F.col(right_col))).drop(right_col)
    return l.join(r, [key, *also_on], how).drop(key)

