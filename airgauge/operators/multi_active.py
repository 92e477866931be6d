"""History of keys that hold several rows at once: snapshots and satellites of row sets.

A row within a key is told by its content; rows that are alike in all columns are one row with a number of
copies. Nothing is ranked within a key and no key's rows are gathered: what a key holds is compared row by row
(snapshot) or by a digest that does not depend on order and adds up in partial aggregates (satellite). A key
that owns a third of all rows therefore spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.functions.columns import content_hash, record_key
from airgauge.operators.history import CONTENT, FROM, KEY, SEQ, SNAP_COLUMNS, SNAP_FROM, SNAP_ID, SNAP_TO, SOURCE

COPIES = "copias"
SET = "_huella_conjunto"


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


# --- snapshots ------------------------------------------------------------------


def snapshot_rows(src: DataFrame, stored: DataFrame | None, key: Sequence[str], now: Column, check_cols: Sequence[str] | None = None) -> DataFrame:
    """Whole new state of a snapshot in which a key may hold several rows.

    A row of a key that `src` brings is closed when `src` no longer has it among the key's rows, and one that
    it has anew is opened; the key's other rows stay as they are. A key missing from `src` stays open. Rows
    with the same check columns (default: all but the key) are one row with `copias`; of their other columns the
    greatest values stand. A changed number of copies is a change. NULL is a key like any other.
    """
    attributes = [c for c in src.columns if c not in key]
    checked = list(check_cols) if check_cols is not None else attributes
    identity = content_hash(src, [*key, *checked])
    packed = F.struct(*_cols(attributes)) if attributes else F.struct(F.lit(0).alias("_"))
    fresh = (
        src.groupBy(F.struct(*_cols(key)).alias("_k"), identity.alias("_h"))
        .agg(F.count(F.lit(1)).cast("int").alias("_c"), F.max(packed).alias("_a"))
    )
    if stored is None:
        state = fresh.select("_k", "_h", "_c", "_a", now.cast("timestamp").alias(SNAP_FROM), F.lit(None).cast("timestamp").alias(SNAP_TO))
        return _identified(state, key, attributes)
    held = stored.select(
        F.struct(*_cols(key)).alias("_ko"), content_hash(stored, [*key, *checked]).alias("_ho"), F.col(COPIES).alias("_co"),
        packed.alias("_ao"), F.col(SNAP_FROM).alias("_f"), F.col(SNAP_TO).alias("_t"),
    )
    brought = fresh.select(F.col("_k").alias("_kb")).distinct().withColumn("_brought", F.lit(True))
    open_rows = held.where(F.col("_t").isNull()).join(brought, F.col("_ko").eqNullSafe(F.col("_kb")), "left")
    same = F.col("_k").eqNullSafe(F.col("_ko")) & (F.col("_h") == F.col("_ho")) & (F.col("_c") == F.col("_co"))
    both = fresh.join(open_rows, same, "full")
    old = F.col("_ko").isNotNull()
    state = both.select(
        F.when(old, F.col("_ko")).otherwise(F.col("_k")).alias("_k"), F.coalesce("_ho", "_h").alias("_h"), F.coalesce("_co", "_c").alias("_c"),
        F.when(old, F.col("_ao")).otherwise(F.col("_a")).alias("_a"),
        F.when(old, F.col("_f")).otherwise(now.cast("timestamp")).alias(SNAP_FROM),
        F.when(old & F.col("_k").isNull() & F.col("_brought"), now.cast("timestamp")).alias(SNAP_TO),
    )
    past = held.where(F.col("_t").isNotNull()).select(F.col("_ko").alias("_k"), F.col("_ho").alias("_h"), F.col("_co").alias("_c"), F.col("_ao").alias("_a"), F.col("_f").alias(SNAP_FROM), F.col("_t").alias(SNAP_TO))
    return _identified(state.unionByName(past), key, attributes)


def _identified(state: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    since = F.date_format(SNAP_FROM, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return state.select(
        *[F.col("_k").getField(k).alias(k) for k in key],
        *[F.col("_a").getField(a).alias(a) for a in attributes],
        F.col("_c").alias(COPIES),
        SNAP_FROM,
        SNAP_TO,
        F.md5(F.concat_ws("-", F.col("_h"), F.col("_c").cast("string"), since)).alias(SNAP_ID),
    )


def snapshot_rows_current(stored: DataFrame) -> DataFrame:
    """The open rows, with their copies."""
    return stored.where(F.col(SNAP_TO).isNull()).drop(*SNAP_COLUMNS)


def each_copy(rows: DataFrame) -> DataFrame:
    """The rows as they came in: one that stands for copies is there as many times again."""
    again = rows.withColumn("_vez", F.explode(F.sequence(F.lit(1), F.col(COPIES))))
    return again.drop("_vez", COPIES)


# --- satellites ------------------------------------------------------------------


def _half(first: int) -> Column:
    return F.sum(F.conv(F.substring(CONTENT, first, 15), 16, 10).cast("decimal(20,0)")).cast("string")


def set_digests(rows: DataFrame) -> DataFrame:
    """KEY and a digest of all content hashes of each key: sums, so partial aggregates do the work."""
    sums = F.concat_ws("-", F.count(F.lit(1)).cast("string"), _half(1), _half(17))
    return rows.groupBy(KEY).agg(F.md5(sums).alias(SET))


def hash_row_sets(src: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Rows with key hash, copies, and a content hash over attributes and copies."""
    rows = src.groupBy(*_cols([*key, *attributes])).agg(F.count(F.lit(1)).cast("int").alias(COPIES))
    return rows.select(
        record_key(rows, key).alias(KEY), content_hash(rows, [*attributes, COPIES]).alias(CONTENT), *_cols(attributes), COPIES
    )


def new_set_rows(
    src: DataFrame, key: Sequence[str], attributes: Sequence[str], stored: DataFrame | None, now: Column, source: str
) -> DataFrame:
    """Versions to append: the whole row set of each key that is new, or differs from its own latest set."""
    rows = hash_row_sets(src, key, attributes)
    sets = set_digests(rows)
    if stored is None:
        changed = sets.withColumn(SEQ, F.lit(1))
    else:
        latest = stored.groupBy(KEY).agg(F.max(F.struct(F.col(SEQ).alias("n"), F.col(SET).alias("s"))).alias("_v"))
        changed = (
            sets.join(latest, KEY, "left")
            .where(F.col("_v").isNull() | (F.col("_v.s") != F.col(SET)))
            .withColumn(SEQ, F.coalesce(F.col("_v.n"), F.lit(0)) + 1)
            .drop("_v")
        )
    # a key's set is one row here, so AQE may split the rows of a hot key
    return rows.join(changed, KEY).select(
        KEY, CONTENT, *_cols(attributes), COPIES, SET, now.alias(FROM), F.col(SEQ).cast("int").alias(SEQ), F.lit(source).alias(SOURCE)
    )


def current_set(stored: DataFrame) -> DataFrame:
    """The rows of each key's latest set."""
    latest = stored.groupBy(KEY).agg(F.max(SEQ).alias(SEQ))
    return stored.join(latest, [KEY, SEQ])


def set_as_of(stored: DataFrame, moment: Column) -> DataFrame:
    """The rows of each key's set that was valid at `moment`."""
    return current_set(stored.where(F.col(FROM) <= moment))
