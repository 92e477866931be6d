"""Point in time: each fact with the version of its key that was valid at the fact's own moment.

Facts and versions are sorted together by key and moment with a range partitioning, and the last version is
carried forward. A range may end within a key, so a key that owns a third of all facts spreads over many
tasks; what such a cut separates is settled by a table of one row per partition. There is no product of facts
and versions, and no key's rows are gathered.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airgauge.functions.columns import record_key
from airgauge.session import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _sorted_together(facts: DataFrame, versions: DataFrame, key: Sequence[str], at: Column, since: Column, tie: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Rows _k, _t, _kind (0 version, 1 fact), fact, version: each key's rows in order of time, versions first."""
    known = versions
    for k in key:
        known = known.where(F.col(k).isNotNull())
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    version = F.struct(*[F.col(f"`{c}`") for c in take])
    # facts that are alike in key and moment may be cut apart; their order among themselves means nothing
    left = facts.select(
        record_key(facts, key).alias("_k"), at.alias("_t"), F.lit(1).alias("_kind"),
        *[F.lit(None).cast(versions.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(tie)],
        F.xxhash64(fact).alias("_salt"), fact.alias("fact"),
    )
    right = known.select(
        record_key(known, key).alias("_k"), since.alias("_t"), F.lit(0).alias("_kind"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tie)],
        F.lit(0).cast("bigint").alias("_salt"), version.alias("version"),
    )
    order = ["_k", "_t", "_kind", *[f"_o{i}" for i in range(len(tie))], "_salt"]
    both = left.unionByName(right, allowMissingColumns=True)
    return both.repartitionByRange(*order).sortWithinPartitions(*order).select("_k", "_kind", "fact", "version")


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts with the last version before them, and one row that says how the partition ends.

    `_open` marks facts of the partition's first key that come before any version of it here.
    """
    part = TaskContext.get().partitionId()
    first, key, held, last = None, None, False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, kinds, versions = batch.column("_k"), batch.column("_kind").to_numpy(), batch.column("version")
        n = batch.num_rows
        if first is None:
            first, last = keys[0].as_py(), pa.nulls(1, versions.type)
        same = np.empty(n, bool)
        same[0] = keys[0].as_py() == key
        same[1:] = pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(same, -1, at))  # -1: the key of the last batch goes on
        newest = np.maximum.accumulate(np.where(kinds == 0, at, -1))
        inside = (newest >= start) & (newest >= 0)
        before = ~inside & (start < 0) & held
        place = np.where(inside, newest + 1, 0)
        begins = start < 0 if key == first else np.zeros(n, bool)
        if key is None:
            begins = start == 0
        waiting = begins & ~inside & ~before
        facts = np.flatnonzero(kinds == 1)
        pool = pa.concat_arrays([last, versions])
        chosen = pa.array(place[facts], mask=~(inside | before)[facts])
        picked = pa.array(facts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(facts), part), pa.int32()), keys.take(picked), pa.array(waiting[facts]), batch.column("fact").take(picked), pool.take(chosen), pa.nulls(len(facts), pa.string())],
            names=list(NAMES),
        )
        key = keys[n - 1].as_py()
        if inside[-1]:
            held, last = True, versions.slice(int(newest[-1]), 1)
        elif start[-1] >= 0:
            held, last = False, pa.nulls(1, versions.type)
    if first is not None:
        kind = batch.schema.field("fact").type
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([key], pa.string()), pa.array([held]), pa.nulls(1, kind), last, pa.array([first], pa.string())], names=list(NAMES)
        )


NAMES = ("_part", "_k", "_open", "fact", "version", "_first")


def as_of_join(
    facts: DataFrame, versions: DataFrame, key: Sequence[str], at: str, since: str, take: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """`facts` with the columns `take` of the latest version whose `since` is not after the fact's `at`.

    Of versions with one `since` the greatest by `tie` counts. A fact without such a version, with a NULL
    moment or a NULL in its key has NULLs. Facts stay as they are, repeated ones too. `take` must not clash
    with the facts' columns.
    """
    moment = lambda c: F.col(c).cast("timestamp")
    placed = _sorted_together(facts, versions, key, moment(at), moment(since), tie, take)
    schema = T.StructType(
        [
            T.StructField("_part", T.IntegerType()),
            T.StructField("_k", T.StringType()),
            T.StructField("_open", T.BooleanType()),
            T.StructField("fact", placed.schema["fact"].dataType),
            T.StructField("version", placed.schema["version"].dataType),
            T.StructField("_first", T.StringType()),
        ]
    )
    spark, path = facts.sparkSession, shared_dir(facts.sparkSession, "momento")
    placed.mapInArrow(_carried, schema).write.parquet(path)
    done = spark.read.schema(schema).parquet(path)
    # one row per partition: what each one's first key brings along from those before it
    ends = done.where("_first is not null")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    known = F.when(F.col("_open"), F.struct("_k", "version"))
    carry = ends.select("_part", F.col("_first").alias("_k"), F.last(known, ignorenulls=True).over(before).alias("_c"))
    carry = carry.where(F.col("_c._k") == F.col("_k")).select("_part", "_k", F.col("_c.version").alias("_v"))
    rows = done.where("_first is null")
    settled = rows.where(~F.col("_open")).select("fact", "version")
    late = rows.where("_open").drop("version").join(carry, ["_part", "_k"], "left").select("fact", F.col("_v").alias("version"))
    out = settled.unionByName(late)
    return out.select(*[F.col("fact").getField(c).alias(c) for c in facts.columns], *[F.col("version").getField(c).alias(c) for c in take])
