"""Queries over history that grows: row sets, buckets, points in time, refused readings, deep hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge import standin as st
from airgauge.functions import columns as c
from airgauge.operators import bucketed as b
from airgauge.operators import history as h
from airgauge.operators import multi_active as ma
from airgauge.operators import reshape as rs
from airgauge.operators.asof import as_of_join
from airgauge.operators.hierarchy import resolve_paths
from airgauge.plans import vault
from airgauge.plans.catalog import SATELLITE
from airgauge.session import shared_dir
from airgauge.sources import landing as ld
from airgauge.streaming import incremental as inc

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-08 00:00:00"
OPERATION = ["estado", "hh"]


def _moment(text: str):
    return F.lit(text).cast("timestamp")


# --- several rows per key ---------------------------------------------------------


def _snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    t = st.Tables(spark, d)
    first = ma.snapshot_rows(st.operations(t, 1), None, ["orden_nro"], _moment(FIRST_LOAD))
    return ma.snapshot_rows(st.operations(t, 2), first, ["orden_nro"], _moment(SECOND_LOAD))


def snapshot_multi(spark: SparkSession, d: str) -> DataFrame:
    """Orders with several operations: a snapshot that keeps every row of a key."""
    return _snapshot_rows(spark, d).select("orden_nro", *OPERATION, ma.COPIES, h.SNAP_FROM, h.SNAP_TO)


def snapshot_multi_current(spark: SparkSession, d: str) -> DataFrame:
    return ma.snapshot_rows_current(_snapshot_rows(spark, d)).select("orden_nro", *OPERATION, ma.COPIES)


def _sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = st.Tables(spark, d)
    first = ma.new_set_rows(st.operations(t, 1), ["orden_nro"], OPERATION, None, _moment(FIRST_LOAD), "operaciones")
    second = ma.new_set_rows(st.operations(t, 2), ["orden_nro"], OPERATION, first, _moment(SECOND_LOAD), "operaciones")
    return first, second


SET_OUT = (h.KEY, h.CONTENT, *OPERATION, ma.COPIES, h.SEQ)


def satellite_multi(spark: SparkSession, d: str) -> DataFrame:
    """Versions of whole row sets, with the load that brought each."""
    first, second = _sets(spark, d)
    return first.withColumn("carga", F.lit(1)).unionByName(second.withColumn("carga", F.lit(2))).select(*SET_OUT, "carga")


def satellite_multi_current(spark: SparkSession, d: str) -> DataFrame:
    first, second = _sets(spark, d)
    return ma.current_set(first.unionByName(second)).select(*SET_OUT)


def number_texts(spark: SparkSession, d: str) -> DataFrame:
    """Numbers as the text that keys and contents are hashed from, far beyond six decimals and either end."""
    v = F.col("value")
    numbers = {"valor": v, "tercio": v / 3, "enorme": v * 1e290, "diminuto": v * -1e-290, "millonesimo": v / 1e7}
    return st.Tables(spark, d).events.select("event_id", *[c.number_text(x).alias(n) for n, x in numbers.items()])


# --- buckets -------------------------------------------------------------------------


def _cell_batches(t: st.Tables) -> list[DataFrame]:
    """Readings before the cut, those after it, and those again."""
    rows = st.cells(t).select("punto_nro", "anio", "semana_nro", "fecha_medicion", "concentracion_mg_m3")
    late = F.col("fecha_medicion") >= F.lit(st.CUT)
    return [rows.where(~late), rows.where(late), rows.where(late)]


def bucket_loads(spark: SparkSession, d: str) -> DataFrame:
    """Three loads of a table with a bucket for every 13 weeks: rows brought, rows added and whether the bucket was read."""
    folder = shared_dir(spark, "cubos")
    table, report = f"{folder}/celdas", f"{folder}/cargas"
    cut = b.buckets_for(st.POINT_WEEK)
    for n, batch in enumerate(_cell_batches(st.Tables(spark, d)), 1):
        rows = batch.select(c.record_key(batch, st.POINT_WEEK).alias(h.KEY), "*").withColumn(b.BUCKET, cut.of())
        kept = f"{folder}/lote={n}"
        rows.write.parquet(kept)
        rows = spark.read.schema(rows.schema).parquet(kept)
        load = b.append_unknown(rows, table)
        added = b.stored_rows(spark, table).groupBy(b.BUCKET).agg(F.count(F.lit(1)).alias("filas_tabla"))
        part = rows.groupBy(b.BUCKET).agg(F.count(F.lit(1)).alias("filas_lote")).join(added, b.BUCKET)
        part = part.select(F.lit(n).alias("carga"), b.BUCKET, "filas_lote", "filas_tabla", F.col(b.BUCKET).isin(load.read).alias("leido"))
        part.write.mode("append").parquet(report)  # as the table is now; the next load changes it
    return spark.read.parquet(report)


def satellite_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Versions of measurements in a table with buckets of weeks, after two loads and a repeated one."""
    table = f"{shared_dir(spark, 'cubos')}/detalle_medicion"
    spec = SATELLITE["detalle_medicion"]
    for batch, when in ((1, FIRST_LOAD), (2, SECOND_LOAD), (2, SECOND_LOAD)):
        vault.append_versions(spec, st.history_sources(spark, d, batch)[spec.source], table, _moment(when))
    load = F.when(F.col(h.FROM) == _moment(FIRST_LOAD), 1).otherwise(2)
    return b.stored_rows(spark, table).select(h.KEY, h.CONTENT, *spec.attributes, h.SEQ, load.alias("carga"))


# --- points in time --------------------------------------------------------------------


def pit_measurement(spark: SparkSession, d: str) -> DataFrame:
    """Every reading with the condition of its point that was known on its own day."""
    t = st.Tables(spark, d)
    facts = st.cells(t).select(*st.POINT_WEEK, "fecha_medicion", "concentracion_mg_m3")
    return as_of_join(facts, st.condition_versions(t), ["punto_nro"], "fecha_medicion", "desde", ["condicion", "medida"], ["event_id"])


def pit_order(spark: SparkSession, d: str) -> DataFrame:
    """Every order with the last reading at its machine's point when it was planned."""
    t = st.Tables(spark, d)
    lines = st.order_lines(t).select("o_orderkey", F.col("maquina_nro").alias("punto_nro"))
    facts = t.orders.join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("orden_nro"), "punto_nro", F.col("o_orderdate").cast("date").alias("inicio_programado")
    )
    readings = st.cells(t).select("punto_nro", F.col("fecha_medicion").alias("fecha_lectura"), F.col("concentracion_mg_m3").alias("ultima_lectura"))
    return as_of_join(facts, readings, ["punto_nro"], "inicio_programado", "fecha_lectura", ["fecha_lectura", "ultima_lectura"])


# --- refused readings --------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> str:
    """Events in four parts, each a micro-batch: even ids before the middle of the time, after it, then odd ones."""
    folder = shared_dir(spark, "rechazos")
    events = st.Tables(spark, d).events
    middle = events.agg((F.min("ts").cast("timestamp").cast("double") + F.max("ts").cast("timestamp").cast("double")) / 2).first()[0]
    late = F.unix_seconds(F.col("ts").cast("timestamp")) >= int(middle)
    even = F.col("event_id") % 2 == 0
    for part in (even & ~late, even & late, ~even & ~late, ~even & late):
        events.where(part).write.mode("append").parquet(f"{folder}/llegada")
        stream = inc.read_files(spark, f"{folder}/llegada", events.schema)
        inc.stream_counted(stream, "ts", "value", ["event_type"], f"{folder}/salida", f"{folder}/control").awaitTermination()
    return f"{folder}/salida"


def weekly_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Readings taken and refused by each micro-batch: together, all that came in."""
    return spark.read.parquet(f"{_event_stream(spark, d)}/conteo").select("lote", "event_type", "aceptadas", "rechazadas")


def weekly_counted(spark: SparkSession, d: str) -> DataFrame:
    """The weeks of the readings that were taken."""
    return inc.counted_windows(spark, _event_stream(spark, d), ["event_type"])


# --- sheets, hierarchy, reference tables -------------------------------------------------------


def year_positions(spark: SparkSession, d: str) -> DataFrame:
    """Year of every week column of sheets of 156 columns, by the order of their week numbers."""
    ids = [*st.SHEET_IDS, "primer_anio"]
    wide = st.week_header(st.Tables(spark, d))
    header = rs.header_rows(rs.unpivot_wide(wide, [*ids, rs.LABEL]), ids)
    years = rs.header_years(header, ids, F.col("primer_anio"))
    return rs.exclude(years.withColumn("posicion", rs.position_number(F.col(rs.POSITION))), ["primer_anio", rs.POSITION])


def component_paths(spark: SparkSession, d: str) -> DataFrame:
    """Root and depth of every component of a deep tree, and the components that run in a circle."""
    return resolve_paths(st.component_tree(st.Tables(spark, d)), "componente_codigo", "componente_padre_codigo")


def reference_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The machine catalogue as a file, loaded as a reference table with its declared types."""
    folder = shared_dir(spark, "referencia")
    machines = st.machines(st.Tables(spark, d)).withColumns({"orden_sap_ejemplo": F.lit(None).cast("string"), "fuente": F.lit("catálogo, \"v1\"")})
    names = [x.split()[0] for x in ld.REFERENCE_SCHEMAS["equipos_ventilacion_catalogo"].split(", ")]
    machines.select(*names).write.option("header", True).csv(folder)
    return rs.exclude(ld.load_reference(spark, "equipos_ventilacion_catalogo", folder), ["orden_sap_ejemplo"])


QUERIES = {
    fn.__name__: fn
    for fn in (
        snapshot_multi, snapshot_multi_current, satellite_multi, satellite_multi_current, number_texts, bucket_loads,
        satellite_bucketed, pit_measurement, pit_order, weekly_rejects, weekly_counted, year_positions, component_paths,
        reference_loaded,
    )
}
