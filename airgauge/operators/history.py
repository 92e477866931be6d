"""Append-only history: hubs, links, satellites and snapshots.

Every operator returns the rows to append, or a view over stored rows; nothing
is rewritten in place. A satellite's versions of one key are numbered 1, 2, 3...
on load. That number does the work a window over the key would do: the next
version is an equi-join on (key, number + 1), so a key that owns a third of all
versions still spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airgauge.functions.columns import content_hash, digest_bytes, digest_text, key_text, record_key
from airgauge.session import grown

KEY = "huella_registro"
CONTENT = "_huella_contenido"
FROM = "valid_from"
TO = "valid_to"
SEQ = "version_seq"
LOADED = "_silver_loaded_at"
SOURCE = "_silver_fuente"


@dataclass(frozen=True)
class Hub:
    name: str
    key: tuple[str, ...]
    sources: tuple[str, ...]
    # buckets of a table that grows with the facts; 0: a reference table, read as a whole
    buckets: int = 0


@dataclass(frozen=True)
class Link:
    name: str
    key: tuple[str, ...]
    # hash column of each member -> its key columns
    members: Mapping[str, tuple[str, ...]]
    source: str
    not_null: tuple[str, ...] = ()
    buckets: int = 0


@dataclass(frozen=True)
class Satellite:
    name: str
    key: tuple[str, ...]
    attributes: tuple[str, ...]
    source: str
    where: str | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    buckets: int = 0
    # a key may have several rows at once, and all of them are its content
    several: bool = False


def _not_stored(rows: DataFrame, key: Sequence[str], stored: DataFrame | None) -> DataFrame:
    """The rows whose key hash is not stored; they are compared by nothing else, so other hashes are made of what is left.

    The digests are never NULL, and Spark has to see it: for its filter it would make a plan of two loads twice.
    """
    if stored is None:
        return rows
    digest = lambda hashed: F.coalesce(digest_bytes(hashed), F.lit(b"")).alias(KEY)
    met = stored.select(digest(F.col(KEY)))
    if KEY not in rows.columns:
        rows = rows.select("*", digest(record_key(rows, key)))
    return rows.join(grown(met), KEY, "left_anti").drop(KEY)


def _by_digest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows without copies, placed by their key's digest: they are compared by it where they lie."""
    return rows.withColumn(KEY, F.coalesce(digest_bytes(record_key(rows, key)), F.lit(b""))).repartition(KEY).distinct()


def new_hub_rows(
    sources: Sequence[DataFrame], key: Sequence[str], stored: DataFrame | None, now: Column, source: str
) -> DataFrame:
    """Business keys seen in any source and not stored yet, one row each."""
    keys = None
    for s in sources:
        picked = s.select(*key)
        keys = picked if keys is None else keys.unionByName(picked)
    rows = _not_stored(keys.distinct(), key, stored)
    return rows.select(record_key(rows, key).alias(KEY), *key, now.alias(LOADED), F.lit(source).alias(SOURCE))


def new_link_rows(
    src: DataFrame,
    key: Sequence[str],
    members: Mapping[str, Sequence[str]],
    stored: DataFrame | None,
    now: Column,
    source: str,
    not_null: Sequence[str] = (),
    many: bool = False,
) -> DataFrame:
    """Composite keys not stored yet, with the hash key of each member.

    `many`: most rows of `src` are a key of their own, so they are shuffled once, by what is compared, and copies are
    looked for after that.
    """
    kept = src
    for c in not_null:
        kept = kept.where(F.col(c).isNotNull())
    wanted = list(dict.fromkeys([*key, *[c for cols in members.values() for c in cols]]))
    found = kept.select(*wanted)
    rows = _not_stored(_by_digest(found, key) if many and stored is not None else found.distinct(), key, stored)
    return rows.select(
        record_key(rows, key).alias(KEY),
        *[record_key(rows, cols).alias(name) for name, cols in members.items()],
        *wanted,
        now.alias(LOADED),
        F.lit(source).alias(SOURCE),
    )


def resolve_roles(
    fact: DataFrame,
    aliases: DataFrame,
    keys: Sequence[str],
    roles: Mapping[str, str],
    person: Sequence[str] = ("dni", "tipo_dni", "dni_pais_emisor"),
    alias: str = "alias_fuente",
) -> DataFrame:
    """A row (keys, role, person) for every role column whose alias is known.

    The role columns are stacked first, so the alias map is joined once for all.
    Rows are unique if the facts are; a link load takes distinct keys anyway.
    """
    norm = "_alias_norm"
    # exploded and not unpivoted: Spark does not see that two plans above the same unpivot are one
    each = F.array(*[F.struct(F.lit(role).alias("rol"), F.lower(F.trim(F.col(c))).alias(norm)) for role, c in roles.items()])
    stacked = fact.select(*keys, F.explode(each).alias("_x")).select(*keys, "_x.rol", f"_x.{norm}").where(F.col(norm).isNotNull())
    known = aliases.select(F.lower(F.trim(F.col(alias))).alias(norm), *person).distinct()
    return stacked.join(known, norm).drop(norm)


def resolve_hierarchy(children: DataFrame, child: str, parent: str, attributes: DataFrame | None = None) -> DataFrame:
    """Two levels: every element with its parent and the parent's parent, if any (`hierarchy` goes to any depth)."""
    up = children.select(F.col(child).alias(parent), F.col(parent).alias("abuelo_codigo")).where(
        F.col("abuelo_codigo").isNotNull()
    )
    out = children.join(up, parent, "left")
    if attributes is not None:
        out = out.join(attributes, child, "left")
    return out


KEY_TEXT = "_clave"


def whole_numbers(df: DataFrame, cols: Sequence[str]) -> bool:
    """Whether all these columns are whole numbers, so that rows agree in them where their texts agree."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(kinds[x], T.IntegralType) for x in cols)


def key_rows(src: DataFrame, key: Sequence[str], attributes: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Source rows with the text of their key, one row per key; `keep` are columns of the key to carry along.

    A task keeps one row of a key before the shuffle. When one batch holds different contents for a key, the one
    with the greatest content hash is kept, so a rerun of the batch decides alike. Where all of them count, see
    `multi_active`. Whole numbers are told apart by their texts as by themselves, so keys of these are grouped as
    they come and rows that lie by them stay where they are.
    """
    rows = src.select(*key, *attributes)
    best = F.max(F.struct(digest_bytes(content_hash(rows, attributes)).alias("_h"), F.struct(*attributes).alias("_a"))).alias("_r")
    if whole_numbers(rows, key):
        grouped = rows.groupBy(*key).agg(best)
        grouped = grouped.withColumn(KEY_TEXT, key_text(grouped, key))
    else:
        grouped = rows.withColumn(KEY_TEXT, key_text(rows, key)).groupBy(KEY_TEXT, *keep).agg(best)
    return grouped.select(KEY_TEXT, *[F.col(f"_r._a.{a}").alias(a) for a in attributes], *keep)


def hash_rows(src: DataFrame, key: Sequence[str], attributes: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """`key_rows` with key and content hashes in place of the key's text."""
    rows = key_rows(src, key, attributes, keep)
    return rows.select(F.md5(KEY_TEXT).alias(KEY), content_hash(rows, attributes).alias(CONTENT), *attributes, *keep)


def current_version(stored: DataFrame) -> DataFrame:
    """Latest version of each key: a partial aggregate, no sort of a key's versions in one task."""
    rest = [c for c in stored.columns if c not in (KEY, SEQ)]
    return (
        stored.groupBy(KEY)
        .agg(F.max(F.struct(F.col(SEQ), *[F.col(c) for c in rest])).alias("_v"))
        .select(KEY, *[F.col(f"_v.{c}").alias(c) for c in stored.columns if c != KEY])
    )


def as_of(stored: DataFrame, moment: Column) -> DataFrame:
    """Version of each key that was valid at `moment`."""
    return current_version(stored.where(F.col(FROM) <= moment))


def with_valid_to(stored: DataFrame) -> DataFrame:
    """Stored versions with `valid_to` closed by the next version's start."""
    following = stored.select(KEY, (F.col(SEQ) - 1).alias(SEQ), F.col(FROM).alias(TO))
    return stored.join(following, [KEY, SEQ], "left")


def new_satellite_rows(
    src: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    stored: DataFrame | None,
    now: Column,
    source: str,
) -> DataFrame:
    """Versions to append: keys that are new, or whose content differs from their own latest version."""
    return as_versions(changed_versions(key_rows(src, key, attributes), attributes, stored), attributes, now, source)


def changed_versions(rows: DataFrame, attributes: Sequence[str], stored: DataFrame | None, keep: Sequence[str] = ()) -> DataFrame:
    """The `key_rows` to append as versions, with their number. `stored` needs no more than key, content hash and number.

    Key hashes meet as bytes; a content hash follows from the attributes and is made where it is compared.
    """
    hashed = rows.select(digest_bytes(F.md5(KEY_TEXT)).alias(KEY), *attributes, *keep)
    if stored is None:
        return hashed.withColumn(SEQ, F.lit(1))
    # numbers and hashes as text would more than double what is shuffled here
    version = F.struct(F.col(SEQ).alias("n"), digest_bytes(F.col(CONTENT)).alias("c"))
    latest = stored.groupBy(digest_bytes(F.col(KEY)).alias(KEY)).agg(F.max(version).alias("_v"))
    return (
        hashed.join(grown(latest), KEY, "left")
        .where(F.col("_v").isNull() | (F.col("_v.c") != digest_bytes(content_hash(hashed, attributes))))
        .withColumn(SEQ, (F.coalesce(F.col("_v.n"), F.lit(0)) + 1).cast("int"))
        .drop("_v")
    )


def as_versions(changed: DataFrame, attributes: Sequence[str], now: Column, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """`changed_versions` in the columns of a stored satellite."""
    return changed.select(
        digest_text(F.col(KEY)).alias(KEY), content_hash(changed, attributes).alias(CONTENT), *attributes,
        now.alias(FROM), SEQ, F.lit(source).alias(SOURCE), *keep,
    )


# --- snapshots (type 2, check strategy) -------------------------------------

SNAP_ID = "scd_id"
SNAP_FROM = "snap_valid_from"
SNAP_TO = "snap_valid_to"
SNAP_COLUMNS = (SNAP_ID, SNAP_FROM, SNAP_TO)


def _cols(names: Sequence[str]) -> list[Column]:
    """Columns by exact name: sheet headers may hold dots and blanks."""
    return [F.col(f"`{n}`") for n in names]


def snapshot_check(
    src: DataFrame,
    stored: DataFrame | None,
    key: Sequence[str],
    now: Column,
    check_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Whole new state of a snapshot after seeing `src` at `now`.

    A key whose check columns changed gets its open version closed and a new one
    opened; a key missing from `src` stays open. Check columns default to every
    non-key column. One full outer join of the source with the open versions;
    closed versions pass through untouched.
    """
    attributes = [c for c in src.columns if c not in key]
    checked = list(check_cols) if check_cols is not None else attributes
    packed = F.struct(*_cols(attributes)) if attributes else F.struct(F.lit(0).alias("_"))
    hashed = src.withColumn("_h", content_hash(src, checked or key))
    # one row per key, chosen alike on every run
    fresh = hashed.groupBy(*_cols(key)).agg(F.max(F.struct(F.col("_h").alias("h"), packed.alias("a"))).alias("_n"))

    def row(values: Column, start: Column, end: Column) -> Column:
        return F.struct(
            *[values.getField(a).alias(a) for a in attributes],
            start.cast("timestamp").alias(SNAP_FROM),
            end.cast("timestamp").alias(SNAP_TO),
        )

    never = F.lit(None)
    new = row(F.col("_n.a"), now, never)
    if stored is None:
        result = fresh.select(*_cols(key), F.inline(F.array(new)))
    else:
        open_rows = stored.where(F.col(SNAP_TO).isNull())
        old = open_rows.select(
            *_cols(key),
            F.struct(
                content_hash(stored, checked or key).alias("h"), packed.alias("a"), F.col(SNAP_FROM).alias("f")
            ).alias("_o"),
        )
        kept = row(F.col("_o.a"), F.col("_o.f"), never)
        closed = row(F.col("_o.a"), F.col("_o.f"), now)
        versions = (
            F.when(F.col("_o").isNull(), F.array(new))
            .when(F.col("_n").isNull() | (F.col("_n.h") == F.col("_o.h")), F.array(kept))
            .otherwise(F.array(closed, new))
        )
        # keys meet null-safely: a row without a key is the same row at the next load
        both = [F.struct(*_cols(key)).alias("_k"), "_n"], [F.struct(*_cols(key)).alias("_ko"), "_o"]
        joined = fresh.select(*both[0]).join(old.select(*both[1]), F.col("_k").eqNullSafe(F.col("_ko")), "full")
        found = F.coalesce("_k", "_ko")
        result = joined.select(*[found.getField(k).alias(k) for k in key], F.inline(versions))
        past = stored.where(F.col(SNAP_TO).isNotNull()).select(*_cols(result.columns))
        result = result.unionByName(past)
    identified = result.withColumn("_desde", F.date_format(SNAP_FROM, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return identified.withColumn(SNAP_ID, record_key(identified, [*key, "_desde"])).drop("_desde")


def snapshot_current(stored: DataFrame) -> DataFrame:
    return stored.where(F.col(SNAP_TO).isNull()).drop(*SNAP_COLUMNS)
