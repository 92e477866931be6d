"""Nearest vectors among those a user may see, by inverted lists per label and centroid; exact.

A list holds the vectors of one governance label that are nearest to one centroid, and the widest angle
between them and it. Grants choose the labels, so the lists a user may not see are neither read nor scored.
Among the others no vector of a list can be nearer to a query than its centroid's angle less the list's width:
the lists nearest by that bound are scored first, and of the rest only those whose bound reaches the k-th
score found. What is left out can hold no hit, so the result is that of scoring everything permitted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgauge.operators.vectors import QUERY_BLOCK, QUERY_STEP, VECTOR_BLOCK, _best, _matrix, _unit
from airgauge.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTS = 32  # centroids
SAMPLED = 4096  # vectors, at most, that the centroids are fitted on; every vector is indexed
ROUNDS = 6
LABEL, LIST = "etiqueta", "lista"
SLACK = 1e-9  # for rounding, in bounds and scores


@dataclass(frozen=True)
class Index:
    """`rows`: label, list, id, unit vector; `lists`: label, list, n, width; `centroids`: unit vectors."""

    rows: DataFrame
    lists: DataFrame
    centroids: np.ndarray


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means on a bounded sample, started from evenly spaced rows."""
    unit = _unit(sample)
    centroids = unit[np.linspace(0, len(unit) - 1, min(lists, len(unit))).astype(int)]
    for _ in range(rounds):
        nearest = (unit @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, unit)
        moved = np.linalg.norm(sums, axis=1) > 0
        centroids[moved] = _unit(sums[moved])
    return centroids


def usable(vector: str):
    """A vector that has a direction: not NULL, not empty, finite, not zero."""
    c = F.col(vector).cast("array<double>")
    norm = F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    return (F.size(c) > 0) & norm.isNotNull() & ~F.isnan(norm) & (norm < float("inf")) & (norm > 0)


def build_index(vectors: DataFrame, labels: Sequence[str], id: str, vector: str, lists: int = LISTS) -> Index:
    """All usable vectors in inverted lists, stored. A label is the text of the columns `labels`; NULL is its own."""
    spark = vectors.sparkSession
    label = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in labels]).alias(LABEL)
    ready = vectors.where(usable(vector)).select(label, F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sample = ready.select("id", "v").orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(SAMPLED).toArrow()
    width = 0 if not sample.num_rows else len(sample.column("v")[0])
    centroids = fit_centroids(_matrix(sample.column("v")), lists) if width else np.zeros((0, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("v")))
            scores = unit @ centroids.T
            nearest = scores.argmax(axis=1)
            angle = np.arccos(np.clip(scores[np.arange(len(unit)), nearest], -1.0, 1.0))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(unit) + 1) * unit.shape[1], pa.int32()), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(LABEL), batch.column("id"), flat, pa.array(nearest.astype(np.int32)), pa.array(angle)], names=[LABEL, "id", "v", LIST, "angulo"])

    schema = T.StructType([ready.schema[LABEL], ready.schema["id"], ready.schema["v"], T.StructField(LIST, T.IntegerType()), T.StructField("angulo", T.DoubleType())])
    path = shared_dir(spark, "indice")
    ready.mapInArrow(assign, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    table = rows.groupBy(LABEL, LIST).agg(F.count(F.lit(1)).alias("n"), F.max("angulo").alias("ancho"))
    return Index(rows, _kept(table, "listas"), centroids)


def _angles(queries: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Queries as unit vectors with their angle to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("v")))
            angles = np.arccos(np.clip(unit @ centroids.T, -1.0, 1.0))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in (unit, angles)]
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("user_id"), *lists], names=["q", "user_id", "v", "angulos"])

    arrays = T.ArrayType(T.DoubleType())
    return queries.mapInArrow(run, T.StructType([queries.schema["q"], queries.schema["user_id"], T.StructField("v", arrays), T.StructField("angulos", arrays)]))


def _scored(asked: DataFrame, queries: DataFrame, index: Index, k: int, query_blocks: int) -> DataFrame:
    """The k best of each asked (query, list), in blocks of queries and of a list's vectors: q, id, score."""
    blocks = F.expr(f"cast((n + {VECTOR_BLOCK - 1}) div {VECTOR_BLOCK} as int)")
    wanted = asked.select(LABEL, LIST, "n").distinct()
    right = index.rows.join(wanted, [LABEL, LIST]).select(
        LABEL, LIST, F.pmod(F.xxhash64(F.col("id").cast("string")), blocks).cast("int").alias("trozo"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("parte"), "id", "v",
    )
    left = asked.join(queries.select("q", "v"), "q").select(
        LABEL, LIST, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("trozo"),
        F.pmod(F.xxhash64(F.col("q").cast("string")), F.lit(query_blocks)).cast("int").alias("parte"), "q", "v",
    )
    schema = T.StructType([queries.schema["q"], index.rows.schema["id"], T.StructField("score", T.DoubleType())])

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["q", "id", "score"]
        asked_by, ids = a.column("q").combine_chunks(), b.column("id").combine_chunks()
        if not a.num_rows or not b.num_rows:
            return pa.Table.from_arrays([asked_by.slice(0, 0), ids.slice(0, 0), pa.array([], pa.float64())], names=names)
        q, v, places = _matrix(a.column("v")), _matrix(b.column("v")).T, np.arange(len(ids))
        parts = []
        for i in range(0, len(q), QUERY_STEP):
            score, place = _best(q[i : i + QUERY_STEP] @ v, places, k)
            rows = np.repeat(np.arange(i, i + len(score)), score.shape[1])
            parts.append(pa.Table.from_arrays([asked_by.take(pa.array(rows)), ids.take(pa.array(place.ravel())), pa.array(score.ravel())], names=names))
        return pa.concat_tables(parts)

    keys = [LABEL, LIST, "trozo", "parte"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, schema)


def _first(hits: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("q").orderBy(F.round("score", 9).desc(), F.col("id").asc())
    return hits.withColumn("lugar", F.row_number().over(place)).where(F.col("lugar") <= k)


def nearest_governed(
    index: Index, queries: DataFrame, allowed: DataFrame, k: int, query_id: str = "query_id", query_vector: str = "query_vector", vector_id: str = "vec_id"
) -> DataFrame:
    """The k nearest permitted vectors of each query: query, user, vector, score, lugar.

    queries: query_id, user_id, query_vector; allowed: user_id and `etiqueta`. Scores count to 9 decimals, ties
    go to the smaller id. A user without grants, or a vector without direction, gets nothing: it fails closed.
    """
    ready = queries.where(usable(query_vector)).select(F.col(query_id).alias("q"), "user_id", F.col(query_vector).cast("array<double>").alias("v"))
    if not len(index.centroids):
        empty = ready.select("q", "user_id").limit(0)
        return empty.select(F.col("q").alias(query_id), "user_id", F.lit(None).cast(index.rows.schema["id"].dataType).alias(vector_id), F.lit(0.0).alias("score"), F.lit(0).alias("lugar"))
    asking = _kept(_angles(ready, index.centroids), "consultas")
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    bound = F.greatest(F.get("angulos", F.col(LIST)) - F.col("ancho"), F.lit(0.0))
    # as many rows a query as there are lists its user may see, however many vectors they hold
    seen = asking.select("q", "user_id", "angulos").join(allowed.select("user_id", LABEL).distinct(), "user_id").join(index.lists, LABEL)
    seen = _kept(seen.select("q", LABEL, LIST, "n", bound.alias("cota")), "permitidas")
    nearer = Window.partitionBy("q").orderBy("cota", LABEL, LIST)
    before = F.coalesce(F.sum("n").over(nearer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = _kept(seen.withColumn("antes", before), "ordenadas")
    seeds = _kept(_first(_scored(ranked.where(F.col("antes") < k), asking, index, k, blocks), k).drop("lugar"), "primeras")
    floor = seeds.groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("piso"))
    rest = ranked.where(F.col("antes") >= k).join(floor, "q", "left")
    rest = rest.where(F.col("piso").isNull() | (F.cos("cota") >= F.col("piso") - SLACK)).drop("piso")
    hits = _first(seeds.unionByName(_scored(rest, asking, index, k, blocks)), k)
    return hits.join(asking.select("q", "user_id"), "q").select(F.col("q").alias(query_id), "user_id", F.col("id").alias(vector_id), "score", "lugar")


def recall_gate(indexed: DataFrame, exact: DataFrame, rules: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Per rule: how much of what it should find the index finds, and whether that is enough.

    indexed, exact: regla_id, query_id, vec_id, score; rules: regla_id, threshold, recall_min. What counts are
    exact hits with a score of at least the rule's threshold. `margen` bounds the estimate's error (Hoeffding, one
    side); the verdict is `cumple` or `no_cumple` where recall and margin are on one side of the minimum, else
    `indeciso`; a rule with nothing to find is `sin_datos`.
    """
    keys = ["regla_id", "query_id", "vec_id"]
    wanted = exact.join(rules.select("regla_id", "threshold"), "regla_id").where(F.col("score") >= F.col("threshold")).select(*keys)
    found = indexed.select(*keys).distinct().withColumn("_hit", F.lit(1))
    counted = wanted.join(found, keys, "left").groupBy("regla_id").agg(F.count(F.lit(1)).alias("relevantes"), F.count("_hit").alias("encontrados"))
    rows = rules.join(counted, "regla_id", "left").na.fill(0, ["relevantes", "encontrados"])
    n = F.col("relevantes")
    recall, margin = F.col("encontrados") / F.nullif(n, F.lit(0)), F.sqrt(-F.log(F.lit(1 - confidence)) / (F.nullif(n, F.lit(0)) * 2))
    verdict = F.when(n == 0, "sin_datos").when(recall - margin >= F.col("recall_min"), "cumple").when(recall + margin < F.col("recall_min"), "no_cumple").otherwise("indeciso")
    return rows.select("regla_id", "threshold", "recall_min", "relevantes", "encontrados", F.round(recall, 6).alias("recall"), F.round(margin, 6).alias("margen"), verdict.alias("veredicto"))
