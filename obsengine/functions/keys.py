"""Deterministic keys (hex SHA-256)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import time


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def instance_key(flight: Column, departure: Column, scheduled: Column) -> Column:
    """Business key: sha256 of ``FLIGHT|DEP|iso8601-UTC``."""
    return F.sha2(F.concat_ws("|", F.upper(flight), F.upper(departure), time.iso_utc(scheduled)), 256)


def quarantine_key(payload_sha: Column, index: Column) -> Column:
    """``quarantine:<payload sha>:<element index>`` — a re-ingested bad payload
    collapses to one row and a bad row never replaces a good one."""
    return F.concat(F.lit("quarantine:"), payload_sha, F.lit(":"), index.cast("string"))


def pack_digest(c: Column) -> Column:
    """A 64-digit lower-case hex digest as its 32 bytes; any other text as 33 zero bytes and
    its own.  Nothing is lost, and digests keep their order."""
    raw = F.unhex(c)
    return F.when((F.length(c) == 64) & (F.lower(F.hex(raw)) == c), raw).otherwise(
        F.concat(F.lit(bytes(33)), c.cast("binary")))


def unpack_digest(b: Column) -> Column:
    """The text of ``pack_digest``."""
    return F.when(F.length(b) == 32, F.lower(F.hex(b))).otherwise(
        F.substring(b, 34, 2**31 - 1).cast("string"))


def surrogate_key(key: Column, ts: Column) -> Column:
    """Dimension surrogate key: sha256 of ``key|CAST(ts AS STRING)``."""
    return F.sha2(F.concat_ws("|", key, ts.cast("string")), 256)
