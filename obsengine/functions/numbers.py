"""Delay minutes: strict integral parsing with an error reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text, variant

_INT_TEXT = r"^(0|-?[1-9][0-9]*)\z"
_INT_MAX = 2147483647


def integral_minutes(v: Column) -> Column:
    """INT from a VARIANT leaf, NULL when not an exact 32-bit integer.

    Integers, integral decimals / doubles (``27.0``) and integer text with
    surrounding blanks (``" 27 "``) are accepted; ``27.5``, ``"27.0"``,
    ``"+27"``, ``"027"``, booleans and containers are not.
    """
    t = variant.json_type(v)
    num = F.try_variant_get(v, "$", "double")
    whole = num.isNotNull() & (num == F.floor(num)) & (F.abs(num) <= F.lit(_INT_MAX))
    s = text.strip(variant.string_value(v))
    return (
        F.when(variant.is_integer(t), F.try_variant_get(v, "$", "int"))
        .when(variant.is_fractional(t) & whole, num.cast("int"))
        .when((t == F.lit("STRING")) & s.rlike(_INT_TEXT), s.try_cast("int"))
    )


def delay_parts(v: Column) -> list[Column]:
    """Layered form of ``integral_minutes`` (one projection computes the
    parts, the next combines them; see ``delay_from_parts``)."""
    return [variant.json_type(v).alias("_dv_t"),
            F.try_variant_get(v, "$", "double").alias("_dv_d"),
            F.try_variant_get(v, "$", "int").alias("_dv_i"),
            F.try_variant_get(v, "$", "string").alias("_dv_s")]


def delay_from_parts() -> Column:
    t, num, s = F.col("_dv_t"), F.col("_dv_d"), text.strip(F.col("_dv_s"))
    whole = num.isNotNull() & (num == F.floor(num)) & (F.abs(num) <= F.lit(_INT_MAX))
    return (F.when(variant.is_integer(t), F.col("_dv_i"))
            .when(variant.is_fractional(t) & whole, num.cast("int"))
            .when((t == F.lit("STRING")) & s.rlike(_INT_TEXT), s.try_cast("int")))


def delay_result(v: Column, n: Column) -> Column:
    """struct(value, error) from the chosen delay leaf and its integer."""
    error = (F.when(variant.is_missing(v), F.lit(None))
             .when(n.isNull(), F.lit("invalid delay"))
             .when(n < 0, F.lit("negative delay")))
    return F.struct(F.when(n >= 0, n).alias("value"), error.cast("string").alias("error"))


def delay_minutes(arrival_delay: Column, departure_delay: Column) -> Column:
    """struct(value INT, error STRING): arrival delay when it holds a value,
    else departure delay; an *invalid* arrival value does not fall back."""
    v = F.when(variant.is_missing(arrival_delay), departure_delay).otherwise(arrival_delay)
    n = integral_minutes(v)
    error = (
        F.when(variant.is_missing(v), F.lit(None))
        .when(n.isNull(), F.lit("invalid delay"))
        .when(n < 0, F.lit("negative delay"))
    )
    value = F.when(n >= 0, n)
    return F.struct(value.alias("value"), error.cast("string").alias("error"))


def is_delayed(delay: Column, threshold: int = 15) -> Column:
    """Delayed means strictly more than ``threshold`` minutes; NULL stays NULL."""
    return delay > F.lit(threshold)
