"""Row-level governance: who may see which rows.

Grants are a table (user_id, dimension, value), so one plan serves every user.
Every step is a semi or inner join: what is unknown gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classification levels, lowest first.
LEVELS = ("Público", "Interno", "Restringido", "Solo gerencias")


def expand_groups(grants: DataFrame, groups: DataFrame, domain: DataFrame) -> DataFrame:
    """Grants with group names replaced by their member values.

    `groups` is (dimension, grupo, valor) and `domain` (dimension, valor). A
    value that is neither a group nor in the domain is dropped.
    """
    g = groups.select("dimension", F.col("grupo").alias("value"), "valor")
    return (
        grants.join(g, ["dimension", "value"], "left")
        .select("user_id", "dimension", F.coalesce("valor", "value").alias("valor"))
        .distinct()
        .join(domain, ["dimension", "valor"], "left_semi")
        .withColumnRenamed("valor", "value")
    )


def level_rank(level: Column, levels: Sequence[str] = LEVELS) -> Column:
    """Place of a level in the order, NULL when unknown."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(levels):
        out = F.when(level == name, F.lit(i)).otherwise(out)
    return out


def ordinal_ok(user_level: Column, row_level: Column, levels: Sequence[str] = LEVELS) -> Column:
    """True when the user's level reaches the row's; false for any unknown level."""
    return F.coalesce(level_rank(user_level, levels) >= level_rank(row_level, levels), F.lit(False))


def governed(
    df: DataFrame,
    grants: DataFrame,
    user_id: str,
    dims: Mapping[str, str],
    required: Sequence[str] = (),
    levels: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows of `df` one user may see.

    `dims` maps a dimension to the column that carries it. A required dimension
    with no column gives no rows.
    """
    if any(d not in dims for d in required):
        return df.where(F.lit(False))
    mine = grants.where(F.col("user_id") == user_id)
    out = df
    for dimension, column in dims.items():
        allowed = mine.where(F.col("dimension") == dimension).select(F.col("value").alias("_permitido"))
        if levels and dimension in levels:
            order = levels[dimension]
            # every level up to the user's own, so the row test is again a semi join
            reached = allowed.select(F.explode(F.array(*[F.lit(x) for x in order])).alias("_nivel"), "_permitido").where(
                ordinal_ok(F.col("_permitido"), F.col("_nivel"), order)
            )
            out = out.join(reached, out[column] == reached["_nivel"], "left_semi")
        else:
            out = out.join(allowed, out[column] == allowed["_permitido"], "left_semi")
    return out


def governed_by_user(df: DataFrame, grants: DataFrame, dims: Mapping[str, str]) -> DataFrame:
    """Rows each user may see, with `user_id`, for all users in one plan.

    Call it on an aggregated report: the result is users x allowed rows.
    """
    dimensions = list(dims)
    first = grants.where(F.col("dimension") == dimensions[0]).select("user_id", F.col("value").alias("_v"))
    out = df.join(first, df[dims[dimensions[0]]] == first["_v"]).drop("_v")
    for d in dimensions[1:]:
        more = grants.where(F.col("dimension") == d).select(F.col("user_id").alias("_u"), F.col("value").alias("_v"))
        out = out.join(more, (out["user_id"] == more["_u"]) & (out[dims[d]] == more["_v"]), "left_semi")
    return out


def totals_by_user(df: DataFrame, grants: DataFrame, dims: Mapping[str, str], rows: str, sums: Mapping[str, str]) -> DataFrame:
    """Per user, the number of rows they may see as `rows`, and sums of columns (output name -> column).

    Rows are added up per combination of their labels before they meet the grants: the join is of label
    combinations and users, however many rows there are.
    """
    per_label = df.groupBy(*dims.values()).agg(F.count(F.lit(1)).alias("_filas"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    seen = governed_by_user(per_label, grants, dims)
    return seen.groupBy("user_id").agg(F.sum("_filas").alias(rows), *[F.sum(f"_{n}").alias(n) for n in sums])


def dimension_map(spec: Mapping[str, str]) -> Column:
    """Map of governance labels: 'column:x' takes column x, anything else is a constant."""
    parts = []
    for name, value in spec.items():
        parts.append(F.lit(name))
        if value.startswith("column:"):
            parts.append(F.col(value.split(":", 1)[1]).cast("string"))
        else:
            parts.append(F.lit(value))
    return F.create_map(*parts)


def labelled(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Rows whose label map carries all the given labels."""
    return df.where(reduce(lambda a, b: a & b, [F.col(column)[k] == v for k, v in labels.items()]))
