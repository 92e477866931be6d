"""Answer rows to governed text chunks."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgauge.operators.governance import dimension_map
from airgauge.session import grown, kept

# The chunk contract.
NO_EXPIRY = -1
KEEP_POLICY = "preservar"
PII_STRATEGY = "tokens"
FORGET_STRATEGY = "etiquetas"
HASH_LENGTH = 16
CHUNK_COLUMNS = (
    "chunk_id",
    "regla_id",
    "corrida_id",
    "medallon_id",
    "fecha_creacion",
    "valido_hasta",
    "politica_vigencia",
    "dimensiones",
    "dimensiones_en_texto",
    "pii_estrategia",
    "pii_tokens",
    "estrategia_olvido",
    "hash_contenido",
    "texto",
    "datos_negocio",
)
MISSING = "None"  # how an empty field prints in a text
SAME = ("regla_id", "chunk_id", "hash_contenido")  # chunks that agree in these are one chunk


def chunk_key(cols: Sequence[str], separator: str = "_") -> Column:
    """Id of a chunk from its key columns; a missing part is shown, not skipped."""
    return F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in cols])


def fill(text: str) -> Column:
    """Text with {field} places as a concatenation of columns."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(F.coalesce(F.col(name).cast("string"), F.lit(MISSING)))
    return F.concat(*parts)


def render(pieces: str | Sequence) -> Column:
    """Template to a column. A piece is a text, or (field, text if set, text if not)."""
    if isinstance(pieces, str):
        return fill(pieces)
    out = []
    for piece in pieces:
        if isinstance(piece, str):
            out.append(fill(piece))
        else:
            field, yes, no = piece
            holds = F.coalesce(~F.col(field).cast("string").isin("", "false"), F.lit(False))
            out.append(F.when(holds, fill(yes)).otherwise(fill(no) if no else F.lit("")))
    return F.concat(*out)


def pii_token(c: Column, salt: str) -> Column:
    digest = F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
    return F.when(c.isNotNull(), F.concat(F.lit("PII_"), digest))


def tokenize_pii(df: DataFrame, cols: Sequence[str], salt: str) -> DataFrame:
    """Personal fields replaced by tokens, with the tokens in `pii_tokens`."""
    tokenized = df.withColumns({c: pii_token(F.col(c), salt) for c in cols})  # each token is made once
    pairs = [x for c in cols for x in (F.lit(c), F.col(c))]
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    known = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else empty
    return tokenized.withColumn("pii_tokens", known)


def pii_mapping(df: DataFrame, cols: Sequence[str], salt: str) -> DataFrame:
    """The separate table that leads from a token back to its value."""
    return (
        df.select(*cols)
        .unpivot([], list(cols), "campo", "valor")
        .where(F.col("valor").isNotNull())
        .select("campo", pii_token(F.col("valor"), salt).alias("token"), "valor")
        .distinct()
    )


def canonical_json(cols: Sequence[str]) -> Column:
    """JSON object with keys in sorted order; every value as text, missing ones left out."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(cols)]))


def chunk_hash(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, HASH_LENGTH)


def build_chunks(
    rows: DataFrame,
    rule_id: str,
    mart_id: str,
    key: Sequence[str],
    template: str | Sequence,
    dimensions: Mapping[str, str],
    pii: Sequence[str],
    run_id: str,
    created: Column,
    salt: str,
    expiry: int = NO_EXPIRY,
) -> DataFrame:
    """One chunk per answer row. A projection only: no shuffle is added."""
    data = rows.columns
    tokenized = tokenize_pii(rows, pii, salt)
    business = canonical_json(data)
    return tokenized.select(
        chunk_key(key).alias("chunk_id"),
        F.lit(rule_id).alias("regla_id"),
        F.lit(run_id).alias("corrida_id"),
        F.lit(mart_id).alias("medallon_id"),
        created.alias("fecha_creacion"),
        F.lit(expiry).cast("bigint").alias("valido_hasta"),
        F.lit(KEEP_POLICY).alias("politica_vigencia"),
        dimension_map(dimensions).alias("dimensiones"),
        F.array().cast("array<string>").alias("dimensiones_en_texto"),
        F.lit(PII_STRATEGY).alias("pii_estrategia"),
        F.col("pii_tokens"),
        F.lit(FORGET_STRATEGY).alias("estrategia_olvido"),
        chunk_hash(F.concat_ws("|", render(template), business)).alias("hash_contenido"),
        render(template).alias("texto"),
        business.alias("datos_negocio"),
    )


def valid_chunks(chunks: DataFrame, now_epoch: Column) -> DataFrame:
    """Chunks that have no expiry or expire later than `now_epoch` (seconds)."""
    return chunks.where((F.col("valido_hasta") == NO_EXPIRY) | (F.col("valido_hasta") > now_epoch))


def upsert_chunks(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """New chunks whose (rule, id, hash) is not stored: loading twice adds nothing.

    Of new chunks that agree in these the first by their JSON text stands, whatever order they come in.
    """
    same = list(SAME)
    whole = F.struct(*new.columns)
    first = new.groupBy(*same).agg(F.min_by(whole, F.to_json(whole)).alias("_c"))
    unique = first.select(*[F.col("_c").getField(c).alias(c) for c in new.columns])
    return unique if stored is None else unique.join(stored.select(*same), same, "left_anti")


FEW_KEYS = 100_000  # counted, so that they may go to all tasks


def _among(keys: DataFrame, n: int) -> tuple[DataFrame, Column]:
    """`n` keys as a side of a join, and what they are met by; a missing part meets a missing part."""
    side = keys.select(*[F.col(c).alias(f"_{c}") for c in SAME])
    return F.broadcast(side) if n <= FEW_KEYS else grown(side), reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SAME])


def missing_chunks(new: DataFrame, stored: DataFrame | None) -> DataFrame | None:
    """`upsert_chunks` of chunks that are cheap to make again and come out alike; None where there is nothing to add.

    Ids and hashes are compared first, and they alone are shuffled. Chunks of which none is stored and none comes
    twice then stay in the tasks that make them; else those to add are picked by their keys, and only copies are
    gathered with their texts.
    """
    met = new.groupBy(*SAME).agg(F.count(F.lit(1)).alias("_n")).withColumn("_fresh", F.lit(True))
    if stored is not None:
        known = stored.groupBy(*SAME).agg(F.lit(True).alias("_known"))
        met = met.drop("_fresh").join(grown(known), list(SAME), "left").withColumn("_fresh", F.col("_known").isNull()).drop("_known")
    fresh, copied = F.col("_fresh"), F.col("_fresh") & (F.col("_n") > 1)
    keys, to_add, repeated = met.agg(F.count(F.lit(1)), F.count_if(fresh), F.count_if(copied)).first()
    if not to_add:
        return None
    if to_add == keys and not repeated:
        return new
    met = kept(met.where(fresh), "claves")
    if to_add < keys:
        side, on = _among(met, to_add)
        new = new.join(side, on, "left_semi")
    if not repeated:
        return new
    side, on = _among(met.where(copied), repeated)
    once, copies = new.join(side, on, "left_anti"), new.join(side, on, "left_semi")
    return once.unionByName(upsert_chunks(copies, None))


def check_counts(chunks: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows per rule against (regla_id, minimo, maximo); a rule without rows counts 0."""
    counted = chunks.groupBy("regla_id").agg(F.count(F.lit(1)).alias("filas"))
    rows = F.coalesce(F.col("filas"), F.lit(0))
    return limits.join(counted, "regla_id", "left").select(
        "regla_id",
        rows.alias("filas"),
        "minimo",
        "maximo",
        ((rows >= F.col("minimo")) & (rows <= F.col("maximo"))).alias("cumple"),
    )


def protect(df: DataFrame, cols: Sequence[str], key: Column) -> DataFrame:
    """Columns encrypted with AES-GCM; the caller keeps the key."""
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c), key, F.lit("GCM"))) for c in cols})


def unprotect(df: DataFrame, cols: Sequence[str], key: Column) -> DataFrame:
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(F.col(c)), key, F.lit("GCM")).cast("string") for c in cols}
    )


def forget(chunks: DataFrame, label: str, values: DataFrame) -> DataFrame:
    """Chunks left after those carrying one of `values` (column `valor`) as their label are removed."""
    gone = values.select(F.col("valor").alias("_v")).distinct()
    return chunks.join(gone, chunks["dimensiones"][label] == gone["_v"], "left_anti")
