"""History tables cut into buckets, so that a load reads only what its batch can meet.

A bucket is a folder of the table (`cubo=...`): a run of weeks where the key holds one, else a share of the key's hash.
A load names its batch's buckets, and the scan of the stored table is pruned to those folders and to the few
columns that decide what is new. For append-only tables a Bloom filter of the stored keys says first which
keys of the batch can be stored at all; only the buckets of those are read, and only there an exact
anti-join decides. Filters are bitmaps made and merged by built-in aggregates.

A filter's rows are written before the rows whose keys they hold, so after a lost job it may know keys that
are not stored. That costs a read and is never wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgauge.functions.columns import digest_bytes, digest_text, record_key
from airgauge.operators.history import CONTENT, KEY, SEQ
from airgauge.session import grown, kept
from airgauge.sources.landing import path_exists

BUCKET = "cubo"
# Layout of stored filters.
SEGMENT_BITS = 32_768  # bits of one bitmap of the built-in functions
SEGMENTS = 16  # bitmaps of a bucket's filter; a key has all its bits in one
PROBES = 4


@dataclass(frozen=True)
class Buckets:
    """How keys fall into buckets: by year and run of weeks, or by the key's hash into `n` (at most 4096)."""

    by: tuple[str, ...] = ()  # year and week
    weeks: int = 13
    n: int = 16

    def of(self, key: str = KEY) -> Column:
        if self.by:
            year, week = (F.col(c) for c in self.by)
            run = F.floor((week - 1) / self.weeks)
            return F.concat(F.coalesce(year.cast("string"), F.lit("")), F.lit("-"), F.coalesce(run.cast("string"), F.lit("")))
        return (F.conv(F.substring(key, 1, 3), 16, 10).cast("int") % self.n).cast("string")


def buckets_for(key: Sequence[str], n: int = 16) -> Buckets:
    """By weeks if the key has one, so that a load of a few weeks meets one or two buckets; else by hash."""
    week = ("anio", "semana_nro")
    return Buckets(by=week) if set(week) <= set(key) else Buckets(n=n)


def filters_path(table: str) -> str:
    folder, _, name = table.rstrip("/").rpartition("/")
    return f"{folder}/filtros/{name}"


def stored_rows(spark: SparkSession, table: str, buckets: Sequence[str] | None = None) -> DataFrame | None:
    """The stored rows, of some buckets if given; None before the first load. `cubo` is text."""
    if not path_exists(spark, table):
        return None
    rows = spark.read.parquet(table)
    rows = rows.withColumn(BUCKET, F.col(BUCKET).cast("string"))
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))


def buckets_of(batch: DataFrame) -> list[str]:
    """The buckets of a batch: names of folders, as few as the table has."""
    return sorted(r[0] for r in batch.select(BUCKET).distinct().collect())


NO_BUCKET = "ninguno"  # the folder that holds a table's columns while it has no row


def append_rows(rows: DataFrame, table: str, whole: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Rows with `cubo` to their folders; AQE gathers a bucket's rows and splits a large one.

    `whole` makes the table's rows of them after that: columns that follow from others need not be shuffled.
    """
    spark = rows.sparkSession
    placed = rows.hint("rebalance", BUCKET)
    out = placed if whole is None else whole(placed)
    if not path_exists(spark, table):
        spark.createDataFrame([], out.drop(BUCKET).schema).write.parquet(f"{table}/{BUCKET}={NO_BUCKET}")
    # half of a row's bytes are digits of digests, which only a codec with an entropy stage makes smaller
    out.write.mode("append").option("compression", "zstd").partitionBy(BUCKET).parquet(table)


# --- Bloom filters ------------------------------------------------------------------


def _places(key: str) -> list[Column]:
    """Segment and bit places of a key, from its MD5: 4 digits for the segment, 4 for each place."""
    digits = F.md5(F.concat(F.lit("filtro"), F.col(key)))
    part = lambda i: F.conv(F.substring(digits, 4 * i + 1, 4), 16, 10).cast("int")
    bits = [(part(i + 1) % SEGMENT_BITS).cast("bigint") for i in range(PROBES)]
    return [(part(0) % SEGMENTS).alias("segmento"), F.array(*bits).alias("_bits")]


def filter_rows(keys: DataFrame, key: str = KEY) -> DataFrame:
    """One bitmap for each bucket and segment of `keys` (`cubo` and the key)."""
    places = keys.select(BUCKET, *_places(key)).select(BUCKET, "segmento", F.explode("_bits").alias("_bit"))
    return places.groupBy(BUCKET, "segmento").agg(F.bitmap_construct_agg("_bit").alias("mapa"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


FEW_BUCKETS = 128  # whose filters, of 64 KB each at most, go to all tasks


def maybe_stored(keys: DataFrame, filters: DataFrame, key: str = KEY, few: bool = False) -> DataFrame:
    """`keys` with `_quizas`: whether the filters leave it open that a key is stored. Never false for one that is.

    `few`: the filters are of FEW_BUCKETS at most, so they are sent to the keys, which stay in place.
    """
    merged = filters.groupBy(BUCKET, "segmento").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    merged = F.broadcast(merged) if few else merged
    placed = keys.select("*", *_places(key)).join(merged, [BUCKET, "segmento"], "left")
    hit = F.forall("_bits", lambda b: _is_set(F.col("mapa"), b))
    return placed.withColumn("_quizas", F.coalesce(hit, F.lit(False))).drop("segmento", "_bits", "mapa")


@dataclass(frozen=True)
class Load:
    """What a load met: buckets of its batch, those it read for it, and rows."""

    touched: list[str]
    read: list[str]


def _sums(rows: DataFrame, key: str) -> dict[str, tuple]:
    """Number of keys and sums of their digests for each bucket, which tell sets of keys apart: a row per bucket to the driver."""
    half = lambda at: F.sum(F.conv(F.substring(F.md5(F.col(key)), at, 15), 16, 10).cast("decimal(20,0)"))
    return {r[0]: tuple(r)[1:] for r in rows.groupBy(BUCKET).agg(F.count(F.lit(1)), half(1), half(17)).collect()}


def append_unknown(batch: DataFrame, table: str, key: str = KEY, whole: Callable[[DataFrame], DataFrame] | None = None, by: Sequence[str] = ()) -> Load:
    """Append the rows of `batch` (with `cubo`, one row a key) whose key is not stored.

    `batch` is read several times and should be a stored or cheap frame. A rerun after a lost job adds only
    what is missing. With `whole`, keys are MD5 digests, which meet as bytes, and `whole` makes the table's rows
    (the key too) from the other columns of `batch`. `by` names columns of both that tell keys apart as the key does.
    """
    spark = batch.sparkSession
    touched = buckets_of(batch)
    known = stored_rows(spark, filters_path(table), touched)
    keys = batch.select(BUCKET, key)
    read = [] if known is None else buckets_of(maybe_stored(keys, known, key, len(touched) <= FEW_BUCKETS).where("_quizas"))
    fresh = batch
    if read and (stored := stored_rows(spark, table, read)) is not None:
        # a bucket that holds just the batch's keys has nothing to add, and one that holds none is not compared
        held, brought = (_sums(rows, key) for rows in (stored, keys.where(F.col(BUCKET).isin(read))))
        mixed = [x for x in read if held.get(x) != brought.get(x)]
        untouched = batch.where(~F.col(BUCKET).isin(read))
        batch, stored = batch.where(F.col(BUCKET).isin(mixed)), stored.where(F.col(BUCKET).isin(mixed))
        if by:
            met = grown(stored.select(*[F.col(c).alias(f"_{c}") for c in by]))
            fresh = batch.drop(key).join(met, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]), "left_anti")
            fresh = fresh.withColumn(key, record_key(fresh, by))
        elif whole is None:
            fresh = batch.join(grown(stored.select(BUCKET, key)), [BUCKET, key], "left_anti")
        else:
            met = batch.withColumn(key, digest_bytes(F.col(key))).join(grown(stored.select(BUCKET, digest_bytes(F.col(key)).alias(key))), [BUCKET, key], "left_anti")
            fresh = met.withColumn(key, digest_text(F.col(key)))
        fresh = fresh.unionByName(untouched)
        fresh = kept(fresh, "nuevas")  # its filter and its rows are written from it
    if touched:
        append_rows(filter_rows(fresh, key), filters_path(table))
    append_rows(fresh if whole is None else fresh.drop(key), table, whole)
    return Load(touched, read)


def current_contents(spark: SparkSession, table: str, buckets: Sequence[str]) -> DataFrame | None:
    """Key, content hash and number of the stored versions in some buckets: a narrow scan of a few folders."""
    stored = stored_rows(spark, table, buckets)
    return None if stored is None else stored.select(KEY, CONTENT, SEQ)
