"""Exact nearest vectors by cosine, with governance filters applied first."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The task functions below travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of queries and of vectors one task multiplies at a time, and the queries
# scored per step: together they bound a task's memory whatever the tables hold.
QUERY_BLOCK = 1024
VECTOR_BLOCK = 16384
QUERY_STEP = 128


def check_vectors(vectors: DataFrame, column: str, size: int) -> DataFrame:
    """Rows a collection of `size`-dimensional cosine vectors refuses: wrong size, NULL, or length 0."""
    norm = F.aggregate(
        F.col(column), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    bad_size = F.coalesce(F.size(column) != size, F.lit(True))
    return vectors.select(
        "*",
        F.when(F.col(column).isNull(), F.lit("nulo"))
        .when(bad_size, F.lit("dimension"))
        .when(norm == 0.0, F.lit("norma_cero"))
        .alias("rechazo"),
    ).where(F.col("rechazo").isNotNull())


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    length[length == 0.0] = np.nan
    return rows / length


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the k best columns: score down, id up among equals, NaN last."""
    by_id = np.argsort(ids, axis=-1, kind="stable")
    by_id = np.broadcast_to(by_id, scores.shape)
    ordered = np.take_along_axis(scores, by_id, axis=1)
    top = np.argsort(-ordered, axis=1, kind="stable")[:, :k]
    place = np.take_along_axis(by_id, top, axis=1)
    chosen = np.take_along_axis(np.broadcast_to(ids, scores.shape), place, axis=1)
    return np.take_along_axis(ordered, top, axis=1), chosen


def _score(q: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k of `vectors` for every row of `q`, a step of queries at a time."""
    v = _unit(vectors).T
    parts = [_best(q[i : i + QUERY_STEP] @ v, ids, k) for i in range(0, len(q), QUERY_STEP)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _emit(query_ids: pa.Array, scores: np.ndarray, ids: np.ndarray, id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    whole = ~np.isnan(scores)
    rows = np.nonzero(whole)[0]
    return pa.RecordBatch.from_arrays(
        [query_ids.take(pa.array(rows)), pa.array(ids[whole].tolist(), id_type), pa.array(scores[whole])], names=names
    )


def topk_cosine(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    vector_id: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
    few_queries: bool = False,
) -> DataFrame:
    """The k nearest vectors of every query: (query, vector, score, lugar). No score floor.

    Both sides are cut into blocks that meet pairwise. With `few_queries` the
    caller vouches for at most `query_block` of them: they travel to the tasks and
    the vectors stay where they are, so only k rows per query and task are
    shuffled; more queries than that are an error. Both ways are exact. Ids are
    unique, as in any vector collection. NULL and empty vectors are near nothing.
    """
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(vector_id, vectors.schema[vector_id].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    q = queries.select(F.col(query_id).alias("id"), F.col(query_vector).cast("array<double>").alias("v")).where(F.size("v") > 0)
    v = vectors.select(F.col(vector_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.size("v") > 0)
    if few_queries:
        few = q.limit(query_block + 1).toArrow()
        if few.num_rows > query_block:
            raise ValueError(f"more than {query_block} queries")
        winners = _scan_with_few_queries(few, v, k, schema)
    else:
        winners = _block_pairs(q, v, k, schema, query_block, vector_block)
    place = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(vector_id).asc())
    # Spark cuts to the first k of a query on each task before the shuffle, and again after it
    return winners.withColumn("lugar", F.row_number().over(place)).where(F.col("lugar") <= k)


def _scan_with_few_queries(few: pa.Table, v: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    if few.num_rows == 0:
        return v.sparkSession.createDataFrame([], schema)
    query_ids = few.column("id").combine_chunks()
    q = _unit(_matrix(few.column("v")))
    names = schema.fieldNames()

    def scan(batches):
        scores = ids = id_type = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            id_type = batch.column(0).type
            s, i = _score(q, _matrix(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False), k)
            if scores is None:
                scores, ids = s, i
            else:
                scores, ids = _best(np.hstack([scores, s]), np.hstack([ids, i]), k)
        if scores is not None:
            yield _emit(query_ids, scores, ids, id_type, names)

    return v.mapInArrow(scan, schema)


def _block_pairs(q: DataFrame, v: DataFrame, k: int, schema: T.StructType, query_block: int, vector_block: int) -> DataFrame:
    """Both sides cut into blocks; every pair of blocks meets in one task.

    Rows go to blocks by the hash of their id, so blocks are even. A row is
    copied once per block of the other side, and only k rows per query leave a
    block pair.
    """
    nq, nv = max(1, -(-q.count() // query_block)), max(1, -(-v.count() // vector_block))

    def dealt(df: DataFrame, mine: str, n: int, other: str, copies: int) -> DataFrame:
        return df.select(
            F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(n)).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other),
            "id",
            "v",
        ).select("bq", "bv", "id", "v")

    names = schema.fieldNames()
    left, right = dealt(q, "bq", nq, "bv", nv), dealt(v, "bv", nv, "bq", nq)

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        query_ids, vector_ids = a.column("id").combine_chunks(), b.column("id")
        if a.num_rows == 0 or b.num_rows == 0:
            none = [pa.array([], query_ids.type), pa.array([], vector_ids.type), pa.array([], pa.float64())]
            return pa.Table.from_arrays(none, names=names)
        s, i = _score(_unit(_matrix(a.column("v"))), _matrix(b.column("v")), vector_ids.to_numpy(), k)
        return pa.Table.from_batches([_emit(query_ids, s, i, vector_ids.type, names)])

    return left.groupBy("bq", "bv").cogroup(right.groupBy("bq", "bv")).applyInArrow(pair, schema)


def min_score(hits: DataFrame, floor: float) -> DataFrame:
    return hits.where(F.col("score") >= floor)


def recall_at_k(hits: DataFrame, relevant: DataFrame, query_id: str = "query_id", vector_id: str = "vec_id") -> DataFrame:
    """Share of each query's relevant vectors found among its hits; 0 when none is found."""
    wanted = relevant.select(query_id, vector_id).distinct()
    found = hits.select(query_id, vector_id).distinct().withColumn("_hit", F.lit(1))
    joined = wanted.join(found, [query_id, vector_id], "left")
    return joined.groupBy(query_id).agg(
        F.count(F.lit(1)).alias("relevantes"),
        F.count("_hit").alias("encontrados"),
        F.round(F.count("_hit") / F.count(F.lit(1)), 6).alias("recall"),
    )
