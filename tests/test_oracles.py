"""Registered queries against their SQL on a second engine. AIRGAUGE_ALL=1 runs every one."""

import os

import pytest
from oracle import difference, duck

import __spark_entry__ as entry
from airgauge import registry

SOME = (
    "mart_promedios_planta", "mart_detalle_medicion", "mart_causa_raiz", "mart_ejecucion_ot", "mart_ot_en_curso",
    "question_p02_lowest_point", "question_p04_all_plants_average", "question_p07_why_high", "question_p11_why_not_measured",
    "question_p13_high_window", "question_p17_rising_plant", "question_p18_last_maintenance",
    "question_b1_over_limit_last_session", "report_concentracion_anual", "report_tendencias_planta", "dust_bands",
    "sheet_to_measurements", "orders_from_csv", "machines_by_name_and_plant", "hub_entidad_semana",
    "link_relacion_ot_maqctrl", "satellite_detalle_ot_ejecucion", "versions_closed", "snapshot_orders",
    "report_by_user", "points_by_level", "chunks_p08_why_not_maintained", "chunks_p10_who_measured", "chunks_upserted",
    "texts_protected", "nearest_vectors", "weekly_stream",
)
NAMES = sorted(registry.runnable()) if os.environ.get("AIRGAUGE_ALL") else SOME


def test_every_query_has_its_sql():
    assert registry.runnable().keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, sf, con, name):
    assert difference(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) is None
