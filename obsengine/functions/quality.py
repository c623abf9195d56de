"""Reason lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reasons(*items: Column) -> Column:
    """Join the non-null reasons with ``'; '`` in the given order; NULL if none."""
    return F.nullif(F.concat_ws("; ", *items), F.lit(""))


def missing(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.lit(f"missing {name}"))
