"""Queries over stored answers: governed retrieval, its recall, published chunks, what was not measured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge import registry
from airgauge import standin as st
from airgauge.functions import columns as c
from airgauge.operators import governed_index as gi
from airgauge.operators import history as h
from airgauge.plans import questions as q
from airgauge.plans import vault
from airgauge.plans.marts import build_marts, stored_marts
from airgauge.plans.publish import publish_chunks, read_chunks
from airgauge.session import grown, shared_dir

FIRST_LOAD, SECOND_LOAD = registry.FIRST_LOAD, registry.SECOND_LOAD
NEAREST = 10
# What every rule asks of its retrieval.
THRESHOLD, RECALL_MIN = 0.80, 0.70


def _chunk_vectors(t: st.Tables) -> DataFrame:
    """Vectors as chunks of a plant and a scope."""
    plant = t.nation.select((F.col("n_nationkey") % 25).cast("int").alias("_n"), F.col("n_name").alias("planta"))
    scope = F.when(F.col("vec_id") % 2 == 0, "fiscalizacion").otherwise("mantencion")
    return t.embeddings.join(plant, F.col("label") % 25 == F.col("_n"), "left").select("vec_id", "embedding", "label", "planta", scope.alias("ambito"))


def _asking(vectors: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by 20, asked by the person of its number."""
    return vectors.where(F.col("vec_id") % 20 == 0).select(
        F.col("vec_id").alias("query_id"), F.format_string("Customer#%09d", "vec_id").alias("user_id"), F.col("embedding").alias("query_vector"), "label"
    )


def nearest_governed_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest chunks that the asking person may see, by plant and scope."""
    t = st.Tables(spark, d)
    vectors = _chunk_vectors(t)
    mine = registry._expanded(spark, d)
    plants = mine.where("dimension = 'planta'").select("user_id", F.col("value").alias("_p"))
    scopes = mine.where("dimension = 'ambito'").select("user_id", F.col("value").alias("_a"))
    allowed = plants.join(scopes, "user_id").select("user_id", F.concat_ws("|", "_p", "_a").alias(gi.LABEL))
    index = gi.build_index(vectors, ["planta", "ambito"], "vec_id", "embedding")
    hits = gi.nearest_governed(index, _asking(vectors).drop("label"), allowed, NEAREST)
    return hits.select("query_id", "user_id", "vec_id", F.round("score", 6).alias("score"), "lugar")


def recall_gate(spark: SparkSession, d: str) -> DataFrame:
    """Per rule: hits found in the lists of a query's own label, against all hits of at least the rule's score."""
    t = st.Tables(spark, d)
    vectors = t.embeddings
    index = gi.build_index(vectors, ["label"], "vec_id", "embedding")
    ids = [*q.QUESTIONS]
    asking = _asking(vectors).withColumn("user_id", F.col("query_id").cast("string"))
    rule = F.element_at(F.array(*[F.lit(i) for i in ids]), ((F.col("query_id") / 20).cast("int") % len(ids) + 1)).alias("regla_id")
    every = asking.select("user_id").distinct().join(F.broadcast(index.lists.agg(F.collect_set(gi.LABEL).alias("_l")))).select("user_id", F.explode("_l").alias(gi.LABEL))
    own = asking.select("user_id", F.col("label").cast("string").alias(gi.LABEL))
    exact, indexed = (gi.nearest_governed(index, asking.drop("label"), labels, NEAREST).select(rule, "query_id", "vec_id", "score") for labels in (every, own))
    rules = spark.createDataFrame([(i, THRESHOLD, RECALL_MIN) for i in ids], "regla_id string, threshold double, recall_min double")
    return gi.recall_gate(indexed, exact, rules)


# --- stored answers ---------------------------------------------------------------------

# what the mart of measurement details is read back from
DETAIL_TABLES = (
    "entidad_punto_medicion", "entidad_semana", "entidad_persona", "relacion_medicion", "relacion_medicion_persona", "detalle_medicion",
    "detalle_punto_medicion", "detalle_persona", "detalle_semana", "vigencia_punto_planta", "vigencia_punto_maqgen", "vigencia_punto_componente",
)


def _point_rows(t: st.Tables) -> DataFrame:
    full = c.concat_code(F.col("maquina_gen_codigo"), F.col("componente_codigo")).alias("componente_codigo_full")
    return st.points(t).select("*", F.col("planta_canon").alias("planta"), full)


def not_measured_from_store(spark: SparkSession, d: str) -> DataFrame:
    """What was not measured, asked of a stored mart after two loads.

    The first load lacks the readings of every third point and all after the cut; its empty cells are closed
    when the second one brings the readings.
    """
    root = shared_dir(spark, "tienda")
    t = st.Tables(spark, d)
    early = (F.col("punto_nro") % 3 != 0) & (F.col("fecha_medicion") < F.lit(st.CUT))
    sources = st.history_sources(spark, d)
    # both loads bring them, and they are made once
    every = {n: vault.kept(sources[n], n) for n in ("mediciones", "mediciones_personas")}
    for load, when in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        rows = every["mediciones"].where(early) if load == 1 else every["mediciones"]
        brought = {n: sources[n] for n in ("personas", "semanas", "ordenes")} | {"mediciones_personas": every["mediciones_personas"]}
        brought["mediciones"] = vault.kept(vault.with_missing_cells(rows, _point_rows(t), root), "mediciones")
        vault.load_history(spark, root, brought, F.lit(when).cast("timestamp"), DETAIL_TABLES)
    build_marts(vault.frames_from_history(spark, root), f"{root}/marts", ["detalle_medicion"])
    return q.QUESTIONS["P11"].run(stored_marts(spark, f"{root}/marts"), ordered=False)


def readings_withdrawn(spark: SparkSession, d: str) -> DataFrame:
    """Cells after three loads: all readings, sheets that leave a seventh of the cells blank, and half of those filled again."""
    root = shared_dir(spark, "retiradas")
    t = st.Tables(spark, d)
    rows = vault.kept(st.history_sources(spark, d)["mediciones"], "mediciones")
    blank, again = (F.col("punto_nro") + F.col("semana_nro")) % 7 == 0, F.col("punto_nro") % 2 == 0
    states = ((F.lit(False), FIRST_LOAD), (blank, SECOND_LOAD), (blank & ~again, "2024-01-15 00:00:00"))
    for empty, when in states:
        brought = vault.with_withdrawn_cells(rows.where(~empty), _point_rows(t), rows.where(empty).select(*st.POINT_WEEK), root)
        vault.load_history(spark, root, {"mediciones": brought}, F.lit(when).cast("timestamp"), ("relacion_medicion", "detalle_medicion"))
    cells = spark.read.parquet(f"{root}/relacion_medicion").select(h.KEY, *st.POINT_WEEK)
    shown = ["concentracion_mg_m3", "estado", "motivo_no_medicion", h.SEQ]
    now = h.current_version(spark.read.parquet(f"{root}/detalle_medicion").select(c.digest_bytes(F.col(h.KEY)).alias(h.KEY), *shown))
    return cells.withColumn(h.KEY, c.digest_bytes(F.col(h.KEY))).join(grown(now), h.KEY).select(*st.POINT_WEEK, *shown)


def chunks_published(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of all rules from stored marts, published twice, encrypted, and read back."""
    root, key = shared_dir(spark, "publicados"), F.lit("0123456789abcdef0123456789abcdef")
    frames = registry.kept_frames(spark, d)
    build_marts(frames, f"{root}/marts")
    marts = stored_marts(spark, f"{root}/marts")
    dense = {"detalle_medicion": vault.kept(registry.dense_detail(spark, d, frames), "densa")}
    others = [i for i in q.QUESTIONS if i != "P11"]
    for run, when in (("corrida-1", FIRST_LOAD), ("corrida-2", SECOND_LOAD)):
        moment = F.lit(when).cast("timestamp")
        publish_chunks(marts, f"{root}/chunks", key, run, moment, registry.SALT, others)
        publish_chunks(dense, f"{root}/chunks", key, run, moment, registry.SALT, ["P11"])
    return read_chunks(spark, f"{root}/chunks", key).select("regla_id", "chunk_id", "chunk_clave", "corrida_id", "texto")


QUERIES = {fn.__name__: fn for fn in (nearest_governed_chunks, recall_gate, not_measured_from_store, readings_withdrawn, chunks_published)}
