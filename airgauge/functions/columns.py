"""Cleaning, keys and dates as JVM-side Column expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats that stored keys and texts depend on.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
ZERO_KEY = "-1"
ISO_DAY_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'.000Z'"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
EQUIPMENT_FAMILIES = {"SVE": "renovacion_aire", "SCP": "abatidor_polvo"}

KEY_DECIMAL = "decimal(18,6)"


def norm_text(c: Column) -> Column:
    """Lower case, trimmed, inner blanks collapsed: the join form of a label."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def clean_key(c: Column) -> Column:
    """Business key: text, trimmed, upper case, zero key for a missing one."""
    return F.coalesce(F.nullif(F.upper(F.trim(c.cast("string"))), F.lit("")), F.lit(ZERO_KEY))


def to_double(c: Column) -> Column:
    """Number or NULL. The pattern keeps out forms only one engine accepts ('1d', 'NaN')."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def to_int(c: Column) -> Column:
    """Integer or NULL; '3.7' rounds to 4 and '1.0' is 1."""
    return F.round(to_double(c)).try_cast("int")


def to_date(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("date")


def _power(n: Column) -> Column:
    """2 ** n, exactly."""
    return F.pow(F.lit(2.0), n.cast("double"))


def number_text(c: Column, kind: str = "double") -> Column:
    """A double (or float) as text: one text for each number, the same in every engine.

    Engines print doubles differently, decimals alike. A number below 1e9 that six decimals hold is printed
    with these; every other one exactly, as a whole number times a power of two (`-4503599627370497p-85`).
    """
    six = c.try_cast(KEY_DECIMAL)
    size = F.abs(c.cast("double"))
    guess = F.floor(F.log2(size))  # one off, at most, near a power of two
    half = F.floor((52 - guess) / 2)
    scaled = size * _power(half) * _power(52 - guess - half)  # in two steps, as one could overflow
    up, down = scaled >= 2.0**53, scaled < 2.0**52
    whole = F.when(up, scaled / 2).when(down, scaled * 2).otherwise(scaled)
    power = guess - 52 + F.when(up, 1).when(down, -1).otherwise(0)
    exact = F.concat(F.when(c < 0, "-").otherwise(""), whole.cast("bigint").cast("string"), F.lit("p"), power.cast("string"))
    endless = F.isnan(c) | (size == float("inf"))
    return F.when((size < 1e9) & (six.cast(kind) == c), six.cast("string")).when(endless, c.cast("string")).when(c.isNotNull(), exact)


def _key_text(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = number_text(c, field.dataType.simpleString())
    return F.coalesce(c.cast("string"), F.lit(NULL_TOKEN))


def key_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """The text of the columns, joined by '-', NULL shown as a token."""
    fields = {f.name: f for f in df.schema.fields}
    return F.concat_ws("-", *[_key_text(fields[c]) for c in cols])


def key_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """MD5 over the text of the columns, joined by '-', NULL shown as a token."""
    return F.md5(key_text(df, cols))


def digest_bytes(c: Column) -> Column:
    """A digest as its 16 bytes, which order as its 32 digits do: the form in which digests are shuffled."""
    return F.unhex(c)


def digest_text(c: Column) -> Column:
    """The digits of `digest_bytes`."""
    return F.lower(F.hex(c))


# A record key and a content hash are the same function over different columns.
record_key = key_hash
content_hash = key_hash


def hash_bucket(c: Column, buckets: int) -> Column:
    """Stable bucket 0..n-1 of a text key, the same in every engine that has MD5."""
    head = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def pick_by_hash(key: Column, values: Sequence) -> Column:
    """Deterministic choice of one of `values` by the key's bucket."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), hash_bucket(key, len(values)) + 1)


def concat_code(*parts: Column) -> Column:
    """Composite code a_b; NULL when any part is NULL."""
    out = parts[0].cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit("_"), p.cast("string"))
    return out


def measured_state(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("no_medido")).otherwise(F.lit("medido"))


def unmeasured_reason(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("sin_registro"))


def iso_text(c: Column) -> Column:
    return F.date_format(c.cast("timestamp_ntz"), ISO_DAY_FORMAT)


def local_to_utc(c: Column, zone: str) -> Column:
    """Local wall-clock time in `zone` to UTC text with milliseconds."""
    # Reading the wall clock as NTZ keeps the session time zone out of the result.
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), c.cast("timestamp_ntz"))
    return F.date_format(utc, ISO_MILLIS_FORMAT)


def utc_now() -> Column:
    return F.date_format(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")),
        ISO_MILLIS_FORMAT,
    )


def shift_days(c: Column, days: int) -> Column:
    return F.date_add(c.cast("date"), days)


def _thursday(c: Column) -> Column:
    """Thursday of the date's week: its year is the ISO year, its day of year gives the week."""
    return F.date_add(F.trunc(c.cast("date"), "week"), 3)


def iso_year(c: Column) -> Column:
    return F.year(_thursday(c))


def iso_week(c: Column) -> Column:
    return (F.floor((F.dayofyear(_thursday(c)) - 1) / 7) + 1).cast("int")


def first_day(columns: dict[str, date], default: date) -> Column:
    """Date of the first marked day column, in the given order."""
    marks = [F.when(F.col(f"`{name}`").isNotNull(), F.lit(day)) for name, day in columns.items()]
    return F.coalesce(*marks, F.lit(default))


def equipment_type(code: Column) -> Column:
    """Type letters of the segment after the family segment: ...-SCP-HDP01-MEC gives HDP."""
    return F.nullif(F.regexp_extract(code, r"-(?:SVE|SCP)-([A-Z]+)", 1), F.lit(""))


def equipment_family(code: Column) -> Column:
    segment = F.regexp_extract(code, r"-(SVE|SCP)(?:-|$)", 1)
    out = F.lit(None).cast("string")
    for key, name in EQUIPMENT_FAMILIES.items():
        out = F.when(segment == key, F.lit(name)).otherwise(out)
    return out


def exact_avg(c: Column) -> Column:
    """Average over an exact decimal sum: independent of the order rows arrive in."""
    return F.sum(c.cast(KEY_DECIMAL)).cast("double") / F.count(c)


def to_numeric(c: Column) -> Column:
    """Double to plain NUMERIC, that is decimal(18,3).

    The scaled double is rounded, as the SQL cast does it: 4.0375 is stored just
    below the tie and becomes 4.037, where a cast by decimal digits would give 4.038.
    """
    return (F.round(c * 1000.0) / 1000.0).cast("decimal(18,3)")
