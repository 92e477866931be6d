"""What the operators share: tables, stored intermediate results, worker caches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from airgauge.session import shared_dir

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words, everywhere in this subpackage: runs of what is not one of six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read back: nothing before it runs again."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_in_worker(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker process, for all tasks that it runs."""
    kept = sys.__dict__.setdefault("_airgauge_llm", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def release() -> None:
    """Gives memory that a Python worker has freed back to the system: workers stay, and share the executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str, most_chars: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of a batch as texts, NULL as empty, about `most_chars` in each run.

    Yields (first row, texts). Rows are whole: a text longer than the bound is a run of its own.
    """
    values = batch.column(column)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(values), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + most_chars, side="right")))
        yield start, [x or "" for x in values.slice(start, stop - start).to_pylist()]
        start = stop
    release()
