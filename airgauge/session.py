"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Partition counts are left to AQE: it starts from the cluster's own
# spark.sql.shuffle.partitions, merges small partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no call-site capture per Column call: building a plan takes half the round trips
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SHARED_DIR_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "airgauge", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names for shared work.

    Without one, the warehouse serves if all tasks run in the driver's own process; on a cluster
    that is an error, as no folder is then known to be shared.
    """
    base = spark.conf.get(SHARED_DIR_KEY, None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{SHARED_DIR_KEY} must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/airgauge/{name}-{uuid.uuid4().hex}"


def grown(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the facts: sorted and merged, never sent whole to the driver and all tasks.

    A stored table's size is that of its compressed columns, which may be a hundredth of its rows'; by it, Spark
    would broadcast millions of rows. A table that does not grow with the facts needs no such word.
    """
    return df.hint("merge")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Rows that are used more than once, written to the shared folder and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
