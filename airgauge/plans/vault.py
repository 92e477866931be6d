"""Loading the history tables and reading the marts' frames back from them."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.functions.columns import digest_bytes, record_key
from airgauge.operators import bucketed as b
from airgauge.operators import history as h
from airgauge.operators import multi_active as ma
from airgauge.operators.calendar import day_of_week, iso_calendar, missing_cells, withdrawn_cells
from airgauge.plans.catalog import HUB, HUBS, LINK, LINKS, ROW_SETS, SATELLITE, SATELLITES
from airgauge.plans.frames import Frames
from airgauge.session import grown, kept
from airgauge.sources.landing import read_if_present

Sources = Mapping[str, DataFrame]

AT_ONCE = 4  # tables that load at the same time


def hub_rows(name: str, sources: Sources, stored: DataFrame | None, now: Column) -> DataFrame:
    spec = HUB[name]
    return h.new_hub_rows([sources[s] for s in spec.sources], spec.key, stored, now, "+".join(spec.sources))


def link_rows(name: str, sources: Sources, stored: DataFrame | None, now: Column) -> DataFrame:
    spec = LINK[name]
    return h.new_link_rows(sources[spec.source], spec.key, spec.members, stored, now, spec.source, spec.not_null, many=bool(spec.buckets))


def _satellite_source(spec: h.Satellite, sources: Sources) -> DataFrame:
    src = sources[spec.source]
    return src.where(spec.where) if spec.where else src


def satellite_rows(name: str, sources: Sources, stored: DataFrame | None, now: Column) -> DataFrame:
    spec = SATELLITE.get(name) or next(x for x in ROW_SETS if x.name == name)
    new = ma.new_set_rows if spec.several else h.new_satellite_rows
    return new(_satellite_source(spec, sources), spec.key, spec.attributes, stored, now, spec.source)


def append_keys(spec: h.Hub | h.Link, rows: DataFrame, path: str) -> b.Load:
    """Hub or link rows of a batch to a table in buckets. Digests are made from what they are of where they are needed."""
    cut = b.buckets_for(spec.key, spec.buckets)  # a batch's buckets are looked up before it is compared
    digests = {h.KEY: spec.key, **getattr(spec, "members", {})}

    def whole(df: DataFrame) -> DataFrame:
        made = df.withColumns({name: record_key(df, cols) for name, cols in digests.items()})
        return made.select(*rows.columns, b.BUCKET)

    batch = kept(rows.drop(*digests), spec.name)
    batch = batch.withColumn(h.KEY, record_key(batch, spec.key)).withColumn(b.BUCKET, cut.of())
    return b.append_unknown(batch, path, whole=whole, by=spec.key if h.whole_numbers(batch, spec.key) else ())


def append_versions(spec: h.Satellite, src: DataFrame, path: str, now: Column) -> list[str]:
    """Changed versions of a batch to a table in buckets; the buckets that were read."""
    cut = b.buckets_for(spec.key, spec.buckets)
    batch = kept(h.key_rows(src, spec.key, spec.attributes, cut.by), spec.name)
    batch = batch.withColumn(h.KEY, F.md5(h.KEY_TEXT)).withColumn(b.BUCKET, cut.of()).drop(h.KEY, *cut.by)
    touched = b.buckets_of(batch)
    stored = b.current_contents(src.sparkSession, path, touched)
    changed = h.changed_versions(batch, spec.attributes, stored, [b.BUCKET])
    b.append_rows(changed, path, lambda df: h.as_versions(df, spec.attributes, now, spec.source, [b.BUCKET]))
    return touched


def load_history(spark: SparkSession, root: str, sources: Sources, now: Column, only: Collection[str] | None = None) -> None:
    """Append what each table does not hold yet. Running it again with the same data adds nothing.

    Tables whose source is absent are skipped, so a batch may bring only some sources. Of a table that grows
    with the facts only the buckets are read that the batch can meet; reference tables are read whole.
    `only` names the tables to load; the default is all.
    """
    wanted = []
    for specs, rows in ((HUBS, hub_rows), (LINKS, link_rows), ((*SATELLITES, *ROW_SETS), satellite_rows)):
        for spec in specs:
            needed = spec.sources if hasattr(spec, "sources") else (spec.source,)
            if (only is None or spec.name in only) and all(s in sources for s in needed):
                wanted.append((spec, rows))

    def load(spec: h.Hub | h.Link | h.Satellite, rows: Callable[..., DataFrame]) -> None:
        path = f"{root}/{spec.name}"
        if not spec.buckets:
            rows(spec.name, sources, read_if_present(spark, path), now).write.mode("append").parquet(path)
        elif isinstance(spec, h.Satellite):
            append_versions(spec, _satellite_source(spec, sources), path, now)
        else:
            append_keys(spec, rows(spec.name, sources, None, now), path)

    # the tables have nothing to do with each other: a few at a time keep the cluster busy between small ones
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(load, *w) for w in wanted]:
            done.result()


def known_cells(spark: SparkSession, root: str, first: date, last: date) -> DataFrame | None:
    """Point, year and week of the stored measurement cells, read from the buckets of these weeks alone."""
    spec = LINK["relacion_medicion"]
    weeks = iso_calendar(spark, first, last).select(b.buckets_for(spec.key, spec.buckets).of().alias(b.BUCKET))
    stored = b.stored_rows(spark, f"{root}/{spec.name}", b.buckets_of(weeks))
    return None if stored is None else stored.select(*spec.key)


def _week_span(cells: DataFrame) -> tuple[date | None, date | None]:
    day = day_of_week(F.col("anio"), F.col("semana_nro"))
    return tuple(cells.agg(F.min(day), F.max(day)).first())


def with_withdrawn_cells(measurements: DataFrame, points: DataFrame, blank: DataFrame, root: str) -> DataFrame:
    """Measurements with a `no_medido` row for every stored cell that the batch's sheets leave blank (`blank`)."""
    first, last = _week_span(blank)
    known = None if first is None else known_cells(measurements.sparkSession, root, first, last)
    if known is None:
        return measurements
    # few beside the measurements, and every table is loaded from them
    return measurements.unionByName(kept(withdrawn_cells(measurements, points, blank, known), "retiradas"))


def with_missing_cells(measurements: DataFrame, points: DataFrame, root: str) -> DataFrame:
    """Measurements with a `no_medido` row for every cell of their weeks that is neither among them nor stored."""
    first, last = _week_span(measurements)
    if first is None:
        return measurements
    known = known_cells(measurements.sparkSession, root, first, last)
    return measurements.unionByName(missing_cells(measurements, points, first, last, known))


def frames_from_history(spark: SparkSession, root: str) -> Frames:
    """Current state of every subject, keyed by natural key again."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}")

    def keyed(name: str, *cols: str) -> DataFrame:
        # digests meet as bytes, and with them goes only what is asked for
        return table(name).select(digest_bytes(F.col(h.KEY)).alias(h.KEY), *cols)

    def current(name: str) -> DataFrame:
        spec = SATELLITE[name]
        rows = h.current_version(keyed(name, h.SEQ, *spec.attributes)).select(h.KEY, *spec.attributes)
        return grown(rows) if spec.buckets else rows

    def described(keys: DataFrame, name: str) -> DataFrame:
        return keys.join(current(name), h.KEY, "left")

    def hub(name: str) -> DataFrame:
        return keyed(name, *HUB[name].key)

    def link(name: str, *extra: str) -> DataFrame:
        return table(name).select(*dict.fromkeys([*LINK[name].key, *extra]))

    def point() -> DataFrame:
        out = hub("entidad_punto_medicion")
        for name in ("detalle_punto_medicion", "vigencia_punto_planta", "vigencia_punto_maqgen", "vigencia_punto_componente"):
            out = described(out, name)
        return out.drop(h.KEY)

    def order() -> DataFrame:
        # orders on a machine; an order moved to another machine or week counts where it is now
        out = described(hub("entidad_orden_trabajo"), "vigencia_ot_maqctrl").where(F.col("ubicacion_tecnica").isNotNull())
        for name in ("detalle_ot_descr", "detalle_ot_programacion", "detalle_ot_ejecucion", "detalle_ot_no_ejecucion"):
            out = described(out, name)
        return out.drop(h.KEY)

    def responsible() -> DataFrame:
        out = described(hub("entidad_orden_trabajo"), "vigencia_ot_responsable").where(F.col("dni").isNotNull())
        return out.drop(h.KEY)

    def of_link(name: str, satellite: str) -> DataFrame:
        return described(keyed(name, *LINK[name].key), satellite).drop(h.KEY)

    def of_hub(name: str, satellite: str) -> DataFrame:
        return described(hub(name), satellite).drop(h.KEY)

    def component() -> DataFrame:
        out = described(described(hub("entidad_componente_estructural"), "detalle_componente"), "detalle_componente_estado")
        return out.withColumnRenamed("estado_actual", "estado_componente").drop(h.KEY, "severidad")

    def machine() -> DataFrame:
        out = described(hub("entidad_maquina_control_polvo"), "detalle_maquina_control_polvo")
        return described(out, "vigencia_maqctrl_planta").drop(h.KEY)

    person = HUB["entidad_persona"].key
    return Frames(
        {
            "medicion": lambda: of_link("relacion_medicion", "detalle_medicion"),
            "punto": point,
            "planta": lambda: of_hub("entidad_planta", "detalle_planta"),
            "maquina_gen": lambda: of_hub("entidad_maquina_generadora", "detalle_maquina_generadora"),
            "semana": lambda: of_hub("entidad_semana", "detalle_semana"),
            "medicion_persona": lambda: link("relacion_medicion_persona", *person),
            "persona": lambda: of_hub("entidad_persona", "detalle_persona"),
            "orden": order,
            "orden_responsable": responsible,
            "maquina_control": machine,
            "cobertura": lambda: link("relacion_punto_maqctrl"),
            "componente": component,
            "condicion_observada": lambda: of_link("relacion_condicion_observada", "detalle_condicion_estado"),
            "condicion_tipo": lambda: of_hub("entidad_condicion_tipo", "detalle_condicion_tipo"),
            "condicion_problema": lambda: link("relacion_condicion_problema"),
            "problema_raiz": lambda: of_hub("entidad_problema_raiz", "detalle_problema_raiz"),
        }
    )
