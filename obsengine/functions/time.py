"""Strict ISO-8601 timestamps with a mandatory offset, and UTC renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import variant

# Accepted text after every 'Z' became '+00:00' and a minutes-only time got
# ':00' seconds: date, 'T' or ' ', hours, minutes, seconds, optional fraction
# and a mandatory numeric offset.
ISO_WITH_OFFSET = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?[+-]\d\d(:?\d\d)?\z"
_MINUTES_ONLY = r"^(\d{4}-\d\d-\d\d[T ]\d\d:\d\d)([+-])"


def parse_offset_text(s: Column) -> Column:
    """Text → UTC wall-clock TIMESTAMP_NTZ, NULL unless the strict form holds.

    A single chain (replace 'Z' → pad minutes-only → keep the text only if
    it matches the strict form → cast), each step reading the previous one
    once, so the generated code stays linear in the number of fields.
    """
    t = F.regexp_replace(s, "Z", "+00:00")
    padded = F.regexp_replace(t, _MINUTES_ONLY, "$1:00$2")
    strict = F.nullif(F.regexp_extract(padded, ISO_WITH_OFFSET, 0), F.lit(""))
    return strict.try_cast("timestamp").cast("timestamp_ntz")


def strict_timestamp(v: Column, name: str) -> Column:
    """struct(value TIMESTAMP_NTZ, error STRING) from a VARIANT leaf.

    Absent / JSON null → (NULL, NULL); non-string, unparsable or offset-less
    text → (NULL, 'invalid <name>').  A non-string leaf needs no type test:
    its text form (a number, ``true``) never matches the strict form, and an
    object or array has no text form.
    """
    value = parse_offset_text(F.try_variant_get(v, "$", "string"))
    error = F.when(~variant.is_missing(v) & value.isNull(), F.lit(f"invalid {name}"))
    return F.struct(value.alias("value"), error.alias("error"))


def iso_utc(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00`` (fraction only when non-zero)."""
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("+00:00"),
    )


def hour_start(ts: Column) -> Column:
    """Start of the UTC hour, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")
