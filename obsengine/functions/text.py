"""Text normalisers for codes and display labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import variant

# Unicode-aware strip, like a full ``str.strip()`` (plain trim only drops U+0020).
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(s: Column) -> Column:
    return F.regexp_replace(s, _EDGE_SPACE, "")


def blank_to_null(s: Column) -> Column:
    return F.nullif(s, F.lit(""))


def code_text(s: Column, upper: bool = True) -> Column:
    """Strip, NULL when blank, then upper- (codes) or lower-case (status)."""
    t = blank_to_null(strip(s))
    return F.upper(t) if upper else F.lower(t)


def code(v: Column, upper: bool = True) -> Column:
    """Code from a VARIANT leaf: only strings count; anything else is NULL."""
    return code_text(variant.string_value(v), upper)


def label(v: Column) -> Column:
    """Display label from a VARIANT leaf: strings only, stripped, case kept."""
    return blank_to_null(strip(variant.string_value(v)))


_BETWEEN, _ESCAPE = "\x1f", "\x1b"
_NONE = f"{_ESCAPE}2"


def joined(texts: Sequence[Column]) -> Column:
    """Several texts as one, NULLs and any characters kept; ``parted`` gives them back."""
    escaped = [F.replace(F.replace(t, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}0")), F.lit(_BETWEEN), F.lit(f"{_ESCAPE}1"))
               for t in texts]
    return F.concat_ws(_BETWEEN, *[F.coalesce(t, F.lit(_NONE)) for t in escaped])


def parted(text: Column, n: int) -> list[Column]:
    """The ``n`` texts of ``joined``."""
    parts = [F.split_part(text, F.lit(_BETWEEN), F.lit(i + 1)) for i in range(n)]
    plain = [F.replace(F.replace(p, F.lit(f"{_ESCAPE}1"), F.lit(_BETWEEN)), F.lit(f"{_ESCAPE}0"), F.lit(_ESCAPE))
             for p in parts]
    return [F.when(p != F.lit(_NONE), x) for p, x in zip(parts, plain)]
