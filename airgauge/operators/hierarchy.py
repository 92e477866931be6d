"""Hierarchies of any depth: every element's root, depth and path, and what runs in circles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgauge.session import shared_dir


def resolve_paths(children: DataFrame, child: str, parent: str) -> DataFrame:
    """One row for each element: `child`, `raiz`, `profundidad` (0 for a root) and `en_ciclo`.

    `children` has one row per element; a parent that is no element itself is a root beyond the table. Each
    round doubles the distance to the known ancestor (pointer jumping), so a chain of n elements takes log2 n
    rounds of one equi-join. An ancestor that very many elements share is the unique side of that join, whose
    other side AQE splits. Elements on a circle, or below one, never reach a root: they have `en_ciclo`, no
    `raiz` and no `profundidad`.
    """
    spark = children.sparkSession
    c, p = F.col(f"`{child}`"), F.col(f"`{parent}`")

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # _up: known ancestor, _n: steps to it, _whole: it is a root
    start = children.where(c.isNotNull()).select(
        c.alias("_e"), F.coalesce(p, c).alias("_up"), F.when(p.isNull(), 0).otherwise(1).cast("bigint").alias("_n"), p.isNull().alias("_whole")
    )
    rows = kept(start, "jerarquia")
    total = rows.count()
    reach = 1
    while True:
        going = rows.where("not _whole")
        left = going.count()
        if not left or reach > total:
            break
        above = rows.select(F.col("_e").alias("_up"), F.col("_up").alias("_far"), F.col("_n").alias("_more"), F.col("_whole").alias("_done"))
        jumped = going.join(above, "_up", "left").select(
            "_e", F.coalesce("_far", "_up").alias("_up"), (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_n"),
            F.coalesce("_done", F.lit(True)).alias("_whole"),
        )
        rows = kept(rows.where("_whole").unionByName(jumped), "jerarquia")
        reach *= 2
    whole = F.col("_whole")
    return rows.select(
        F.col("_e").alias(child), F.when(whole, F.col("_up")).alias("raiz"), F.when(whole, F.col("_n")).alias("profundidad"), (~whole).alias("en_ciclo")
    )
