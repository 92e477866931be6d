"""Incremental loads and weekly windows on file streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from airgauge.functions.columns import record_key
from airgauge.operators.history import KEY, current_version
from airgauge.plans.vault import load_history
from airgauge.sources.landing import is_folder, read_if_present

EXACT = "decimal(30,6)"  # sums of readings do not depend on the order they come in


def read_files(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet", only: str | None = None,
               files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if only:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(directory)


def read_table(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """A stored table as a stream, be it a folder of part files or one file."""
    if is_folder(spark, path):
        return read_files(spark, path, schema, **options)
    folder, _, name = path.rpartition("/")
    return read_files(spark, folder, schema, only=name, **options)


def stream_landing(
    landed: DataFrame,
    root: str,
    checkpoint: str,
    sources: Callable[[DataFrame], Mapping[str, DataFrame]],
) -> StreamingQuery:
    """New landing files to the history tables, then stop.

    Each micro-batch is turned into history sources and loaded as a batch job
    would. A batch replayed after a failure adds nothing twice, because every
    table takes only keys, or contents, it does not hold.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            load_history(kept.sparkSession, root, sources(kept), F.current_timestamp())
        finally:
            kept.unpersist()

    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def no_milder(new: DataFrame, stored: DataFrame | None, key: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """`new` with the worse of its own and the stored current value of `column` for each key.

    What a key ends with is then the worst of all batches, however the input is cut into them.
    """
    if stored is None:
        return new
    rank = F.array(*[F.lit(x) for x in order])
    now = current_version(stored).select(KEY, F.col(column).alias("_before"))
    both = new.withColumn(KEY, record_key(new, key)).join(now, KEY, "left")
    worse = F.array_position(rank, F.col("_before")) > F.array_position(rank, F.col(column))
    return both.withColumn(column, F.when(worse, F.col("_before")).otherwise(F.col(column))).select(*new.columns)


def weekly_readings(readings: DataFrame, time: str, value: str, keys: list[str], late: str = "7 days") -> DataFrame:
    """Count, sum and extremes of readings per key and calendar week (Monday to Sunday).

    Windows start on Mondays: the epoch was a Thursday, hence the shift of four days. A reading
    more than `late` behind the newest one may find its window closed, and is then left out.
    """
    exact = F.col(value).cast("decimal(18,6)")
    return (
        readings.withWatermark(time, late)
        .groupBy(F.window(time, "7 days", "7 days", "4 days"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(exact).cast("double").alias("suma"),
            F.min(value).alias("minimo"),
            F.max(value).alias("maximo"),
        )
        .select(F.col("window.start").cast("date").alias("fecha_inicio_semana"), *keys, "n", "suma", "minimo", "maximo")
    )


def stream_weekly(weekly: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Changed windows of every micro-batch, each batch in its own folder, so a replay overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/lote={batch_id}")

    return (
        weekly.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


WEEK_START = "fecha_inicio_semana"
REASON = "motivo_rechazo"


def _judged(batch: DataFrame, time: str, value: str, newest: datetime | None, late: str) -> DataFrame:
    """A batch with each reading's week, and why it is refused (NULL: it is not)."""
    week = F.date_trunc("week", F.col(time).cast("timestamp_ntz"))
    closed = F.lit(False) if newest is None else week + F.expr("interval 7 days") <= F.lit(newest) - F.expr(f"interval {late}")
    fits = F.col(value).try_cast(EXACT)
    reason = F.when(F.col(time).isNull(), "sin_hora").when(closed, "tardia").when(F.col(value).isNotNull() & fits.isNull(), "fuera_de_rango")
    return batch.withColumns({WEEK_START: week.cast("date"), "_exacto": fits, REASON: reason})


def stream_counted(
    readings: DataFrame, time: str, value: str, keys: list[str], out: str, checkpoint: str, late: str = "7 days"
) -> StreamingQuery:
    """Weekly count, sum and extremes of a stream, in which no reading vanishes.

    Each micro-batch leaves three folders of its own number, which a replay overwrites: `parciales`, what its
    readings add to each week; `rechazos`, the readings it refuses, whole and with the reason; `conteo`, both
    numbers by key and the newest time so far. A reading is late when its week ended `late` or more before the
    newest time of earlier batches. Partial results are merged when they are read, so a batch costs what it holds.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_if_present(spark, f"{out}/conteo")
        newest = earlier.where(F.col("lote") < batch_id).agg(F.max("mas_nueva")).first()[0] if earlier is not None else None
        kept = batch.persist()
        try:
            rows = _judged(kept, time, value, newest, late)
            taken = rows.where(F.col(REASON).isNull())
            partial = taken.groupBy(WEEK_START, *keys).agg(
                F.count(F.lit(1)).alias("n"), F.sum("_exacto").alias("suma"), F.min(value).alias("minimo"), F.max(value).alias("maximo")
            )
            refused = rows.where(F.col(REASON).isNotNull()).drop("_exacto")
            late_ones = F.col(REASON).isNotNull()
            counts = rows.groupBy(*keys).agg(
                F.count_if(~late_ones).alias("aceptadas"), F.count_if(late_ones).alias("rechazadas"), F.max(F.col(time).cast("timestamp_ntz")).alias("mas_nueva")
            )
            for name, part in (("parciales", partial), ("rechazos", refused), ("conteo", counts)):
                part.write.mode("overwrite").parquet(f"{out}/{name}/lote={batch_id}")
        finally:
            kept.unpersist()

    return readings.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counted_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The weeks of all batches that `stream_counted` has seen, merged."""
    merged = spark.read.parquet(f"{out}/parciales").groupBy(WEEK_START, *keys)
    sums = merged.agg(F.sum("n").alias("n"), F.sum("suma").cast("double").alias("suma"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"))
    return sums.select(WEEK_START, *keys, "n", "suma", "minimo", "maximo")


def latest_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last state of each window that `stream_weekly` wrote."""
    rows = spark.read.parquet(out)
    by = ["fecha_inicio_semana", *keys]
    rest = [x for x in rows.columns if x not in (*by, "lote")]
    return (
        rows.groupBy(*by)
        .agg(F.max(F.struct("lote", F.struct(*rest).alias("r"))).alias("_u"))
        .select(*by, *[F.col(f"_u.r.{x}").alias(x) for x in rest])
    )
