"""Traffic-light bands of a concentration and severity levels of a KPI."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    level: int
    low: float
    high: float | None
    colour: str
    label: str
    over_limit: bool


# The bands of respirable dust in mg/m3, half-open, last one open-ended.
DUST_BANDS = (
    Band(1, 0.00, 0.25, "azul", "bajo", False),
    Band(2, 0.25, 0.50, "verde", "controlado", False),
    Band(3, 0.50, 2.50, "amarillo", "alerta", False),
    Band(4, 2.50, 5.00, "rojo", "peligroso", True),
    Band(5, 5.00, None, "negro", "critico", True),
)

# Lower bounds at which each KPI turns warning and critical.
KPI_CUTS = {
    "concentracion-maxima-ultima-jornada": (2.0, 3.0),
    "pct-sobre-limite-anual": (5.0, 15.0),
    "puntos-criticos-ultima-jornada": (1.0, 3.0),
}


def internal_limit(bands: Sequence[Band] = DUST_BANDS) -> float:
    """The lowest bound of the bands that count as over the limit."""
    return min(b.low for b in bands if b.over_limit)


def band_of(value: Column, attribute: str = "label", bands: Sequence[Band] = DUST_BANDS) -> Column:
    """Attribute of the band a value falls in; NULL outside every band.

    The bands are a fixed handful, so this is a projection and needs no range join.
    """
    out = None
    for b in bands:
        inside = value >= b.low if b.high is None else (value >= b.low) & (value < b.high)
        picked = F.lit(getattr(b, attribute))
        out = F.when(inside, picked) if out is None else out.when(inside, picked)
    return out


def limit_state(value: Column, limit: float | None = None) -> Column:
    bound = internal_limit() if limit is None else limit
    return F.when(value >= bound, F.lit("sobre_limite")).when(value < bound, F.lit("bajo_limite"))


def kpi_severity(value: Column, kpi: str) -> Column:
    """ok, warning or critico. Each lower bound is the cut, so no value falls in a gap."""
    warning, critical = KPI_CUTS[kpi]
    return (
        F.when(value >= critical, F.lit("critico"))
        .when(value >= warning, F.lit("warning"))
        .when(value.isNotNull(), F.lit("ok"))
    )
