"""Schema-on-read helpers over ``VARIANT`` payload values.

Type tests use ``schema_of_variant`` on *leaf* values only (cheap); container
tests use ``try_variant_get`` casts, which return NULL on a type mismatch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER_TYPES = ["BIGINT", "INT", "SMALLINT", "TINYINT"]


def field(v: Column, *path: str) -> Column:
    """``v.path`` as VARIANT; SQL NULL when a parent is not an object or the key
    is absent, a variant null when the key holds JSON ``null``."""
    return F.try_variant_get(v, "$." + ".".join(path), "variant")


def json_type(v: Column) -> Column:
    """Type name of a leaf value: STRING, BIGINT, DECIMAL(p,s), DOUBLE,
    BOOLEAN, VOID (JSON null), OBJECT<...>, ARRAY<...>."""
    return F.schema_of_variant(v)


def is_missing(v: Column) -> Column:
    """Absent key or JSON null (both read as "no value")."""
    return v.isNull() | F.is_variant_null(v)


def as_array(v: Column) -> Column:
    """``ARRAY<VARIANT>`` when ``v`` is a JSON array, else NULL."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_object(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), F.lit(False))


def is_string(v: Column) -> Column:
    return F.coalesce(json_type(v) == F.lit("STRING"), F.lit(False))


def string_value(v: Column) -> Column:
    """The string held by ``v``; NULL for any non-string value."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def is_integer(t: Column) -> Column:
    return t.isin(*_INTEGER_TYPES)


def is_fractional(t: Column) -> Column:
    return t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")


def has_key(v: Column, key: str) -> Column:
    """True when the object ``v`` carries ``key``, even with a JSON null."""
    return F.coalesce(F.try_variant_get(v, f"$.{key}", "variant").isNotNull(), F.lit(False))


def _start(body: Column, n: int) -> Column:
    return F.hex(F.substring(body, 1, n))


def encoding(body: Column) -> Column:
    """The encoding of a JSON body: by its byte order mark, else by where the zero bytes of
    its first two characters (ASCII in JSON) stand; UTF-8 when neither tells."""
    head, n = _start(body, 4), F.length(body)
    zero = [F.substring(head, 2 * i + 1, 2) == "00" for i in range(4)]
    return (F.when(head.isin("0000FEFF", "FFFE0000"), F.lit("UTF-32"))
            .when(_start(body, 2).isin("FEFF", "FFFE"), F.lit("UTF-16"))
            .when((n >= 4) & zero[0], F.when(zero[1], F.lit("UTF-32BE")).otherwise(F.lit("UTF-16BE")))
            .when((n >= 4) & zero[1], F.when(zero[2] & zero[3], F.lit("UTF-32LE")).otherwise(F.lit("UTF-16LE")))
            .when((n == 2) & zero[0], F.lit("UTF-16BE")).when((n == 2) & zero[1], F.lit("UTF-16LE"))
            .otherwise(F.lit("UTF-8")))


def _units(body: Column, width: int, little: Column) -> Column:
    """The numbers that the bytes give in groups of ``width``."""
    def unit(i):
        pair = [F.hex(F.substring(body, i * width + 1 + k, F.lit(1))) for k in range(width)]
        digits = F.when(little, F.concat(*reversed(pair))).otherwise(F.concat(*pair))
        return F.conv(digits, 16, 10).cast("bigint")

    return F.transform(F.sequence(F.lit(0), (F.length(body) / width).cast("int") - 1), unit)


def _sound(body: Column, width: int, little: Column) -> Column:
    """Whether the bytes are whole code units that form characters."""
    units = _units(body, width, little)
    if width == 4:
        good = F.forall(units, lambda u: (u <= 0x10FFFF) & ~u.between(0xD800, 0xDFFF))
    else:
        # a high surrogate stands right before a low one, and only there
        after = F.concat(F.slice(units, F.lit(2), F.size(units)), F.array(F.lit(0).cast("bigint")))
        high = F.transform(units, lambda u: u.between(0xD800, 0xDBFF))
        low = F.transform(after, lambda u: u.between(0xDC00, 0xDFFF))
        good = ~F.element_at(units, 1).between(0xDC00, 0xDFFF) & F.forall(
            F.arrays_zip(high.alias("high"), low.alias("low")), lambda p: p["high"] == p["low"])
    return (F.length(body) % width == 0) & good


def body_text(body: Column) -> Column:
    """The text of a JSON body in UTF-8, UTF-16 or UTF-32, without a byte order mark; NULL
    when the bytes do not form characters of their encoding."""
    found = encoding(body)
    rest = F.when(_start(body, 3) == "EFBBBF", F.substring(body, 4, F.length(body))).otherwise(body)
    text = rest.cast("string")
    narrow = F.when(F.is_valid_utf8(text), text)
    head = _start(body, 2)
    little16 = (found == "UTF-16LE") | ((found == "UTF-16") & (head == "FFFE"))
    little32 = (found == "UTF-32LE") | ((found == "UTF-32") & (head == "FFFE"))
    # with the mark of its byte order in front, either order reads as plain UTF-16 or UTF-32
    mark16 = F.when(found == "UTF-16LE", F.unhex(F.lit("FFFE"))).when(found == "UTF-16BE", F.unhex(F.lit("FEFF")))
    mark32 = F.when(found == "UTF-32LE", F.unhex(F.lit("FFFE0000"))).when(found == "UTF-32BE", F.unhex(F.lit("0000FEFF")))
    none = F.unhex(F.lit(""))
    return (F.when(found == "UTF-8", narrow)
            .when(found.startswith("UTF-16"), F.when(_sound(body, 2, little16), F.decode(
                F.concat(F.coalesce(mark16, none), body), "UTF-16")))
            .otherwise(F.when(_sound(body, 4, little32), F.decode(
                F.concat(F.coalesce(mark32, none), body), "UTF-32"))))
