"""Payload parsing: landed JSON bodies → typed observations with quarantine.

One narrow stage, no shuffle: decode → explode with index → per-field column
expressions → reason list → routing.  Invalid bodies, bad envelopes and
non-object elements become quarantined rows with a reason, never dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, numbers, quality, text, time, variant
from ..schemas import OBSERVATION_COLUMNS

# Fixed reason texts of the observation contract.
NOT_JSON = "response body is not valid JSON"
NOT_ARRAY = "response data field is not an array"
NOT_OBJECT = "flight record is not an object"


def decode(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Add ``doc`` (VARIANT) and ``decode_error``.

    Bytes that are not UTF-8, or text that is not JSON, give a NULL
    document and ``NOT_JSON``; a document that is not an object or whose
    ``data`` is not an array (absent / null included) gives ``NOT_ARRAY``.
    """
    doc = F.try_parse_json(variant.body_text(F.col(body)))
    data = variant.as_array(variant.field(F.col("doc"), "data"))
    return (payloads.withColumn("doc", doc)
            .withColumn("decode_error",
                        F.when(F.col("doc").isNull(), F.lit(NOT_JSON))
                        .when(data.isNull(), F.lit(NOT_ARRAY))))


def explode_records(decoded: DataFrame) -> DataFrame:
    """One row per ``data`` element with its 0-based ``pos``; a body with a
    decode error yields exactly one row (pos 0, NULL record); ``[]`` yields
    none.  ``element_error`` flags non-object elements."""
    data = variant.as_array(variant.field(F.col("doc"), "data"))
    items = F.when(
        F.col("decode_error").isNotNull(),
        F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("variant").alias("record"))),
    ).otherwise(F.transform(data, lambda x, i: F.struct(i.alias("pos"), x.alias("record"))))
    rows = decoded.select("*", F.inline(items)).drop("doc")
    return rows.withColumn(
        "element_error",
        F.when(F.col("decode_error").isNull() & ~variant.is_object(F.col("record")), F.lit(NOT_OBJECT)))


def saw_field(records: DataFrame, name: str) -> DataFrame:
    """``saw``: true when any object element carries ``name`` (even null)."""
    return records.agg(F.coalesce(F.bool_or(variant.has_key(F.col("record"), name)),
                                  F.lit(False)).alias("saw"))


def saw_field_in(payloads: DataFrame, name: str, body: str = "body") -> bool:
    """Does any object element of any payload carry ``name``?  Only bodies
    whose text contains the key (or a ``\\u`` escape that could spell it)
    are parsed, so the check costs one scan, not a second full parse."""
    text_ = F.col(body).cast("string")
    candidates = payloads.where(text_.contains(f'"{name}"') | text_.contains("\\u"))
    recs = explode_records(decode(candidates, body))
    return bool(saw_field(recs, name).first()["saw"])


def _leaves(records: DataFrame, additive: Sequence[str]) -> DataFrame:
    """Step 1: pull every VARIANT leaf the contract reads into its own column
    (each leaf is then typed once, and generated code stays small)."""
    r = F.col("record")
    paths = {
        "_flight": ("flight", "iata"), "_status": ("flight_status",),
        "_airline": ("airline", "iata"), "_airline_name": ("airline", "name"),
        "_dep": ("departure", "iata"), "_dep_name": ("departure", "airport"),
        "_arr": ("arrival", "iata"), "_arr_name": ("arrival", "airport"),
        "_sd": ("departure", "scheduled"), "_ad": ("departure", "actual"),
        "_sa": ("arrival", "scheduled"), "_aa": ("arrival", "actual"),
        "_arr_delay": ("arrival", "delay"), "_dep_delay": ("departure", "delay"),
    }
    whole = F.col("decode_error").isNull() & F.col("element_error").isNull()
    return records.select(
        "object_path", "observed_at", "payload_sha256", "pos", "decode_error", "element_error",
        whole.alias("_whole"),
        *[variant.field(r, *p).alias(n) for n, p in paths.items()],
        *[variant.field(r, a).alias(f"_x_{a}") for a in additive],
        *[variant.has_key(r, a).alias(f"_saw_{a}") for a in additive],
    )


_CODES = {"_flight": True, "_status": False, "_airline": True, "_dep": True, "_arr": True}
_LABELS = ["_airline_name", "_dep_name", "_arr_name"]
_TIMES = {"_sd": "departure.scheduled", "_ad": "departure.actual",
          "_sa": "arrival.scheduled", "_aa": "arrival.actual"}


def _typed(leaves: DataFrame, additive: Sequence[str]) -> DataFrame:
    """Step 2: type each leaf in layers.  Every layer reads the previous
    layer's columns, so each value (string view, parsed time, chosen delay)
    is computed once instead of being re-expanded inside its own checks."""
    c = F.col
    strings = [*_CODES, *_LABELS, *[f"_x_{a}" for a in additive]]
    l1 = leaves.select(
        "*",
        *[variant.string_value(c(n)).alias(f"{n}_s") for n in strings],
        *[F.try_variant_get(c(n), "$", "string").alias(f"{n}_s") for n in _TIMES],
        *[variant.is_missing(c(n)).alias(f"{n}_m") for n in _TIMES],
        F.when(variant.is_missing(c("_arr_delay")), c("_dep_delay"))
        .otherwise(c("_arr_delay")).alias("_dv"),
    )
    l2 = l1.select(
        "*",
        *[time.parse_offset_text(c(f"{n}_s")).alias(f"{n}_v") for n in _TIMES],
        *numbers.delay_parts(c("_dv")),
    )
    l3 = l2.select(
        "*",
        *[F.when(~c(f"{n}_m") & c(f"{n}_v").isNull(), F.lit(f"invalid {name}")).alias(f"{n}_e")
          for n, name in _TIMES.items()],
        numbers.delay_from_parts().alias("_dn"),
    )
    return l3.select(
        "object_path", "observed_at", "payload_sha256", "pos", "decode_error", "element_error",
        "_whole",
        text.code_text(c("_flight_s")).alias("flight_iata"),
        text.code_text(c("_status_s"), upper=False).alias("flight_status"),
        text.code_text(c("_airline_s")).alias("airline_iata"),
        text.blank_to_null(text.strip(c("_airline_name_s"))).alias("airline_name"),
        text.code_text(c("_dep_s")).alias("departure_airport_iata"),
        text.blank_to_null(text.strip(c("_dep_name_s"))).alias("departure_airport_name"),
        text.code_text(c("_arr_s")).alias("arrival_airport_iata"),
        text.blank_to_null(text.strip(c("_arr_name_s"))).alias("arrival_airport_name"),
        *[F.struct(c(f"{n}_v").alias("value"), c(f"{n}_e").alias("error")).alias(n) for n in _TIMES],
        numbers.delay_result(c("_dv"), c("_dn")).alias("_dl"),
        *[text.code_text(c(f"_x_{a}_s"), upper=False).alias(a) for a in additive],
        *[c(f"_saw_{a}") for a in additive],
    )


def normalize(records: DataFrame, additive: Sequence[str] = ("aircraft_type",)) -> DataFrame:
    """Typed observation columns + quality routing for exploded records."""
    typed = _typed(_leaves(records, additive), additive)
    reason = F.coalesce(
        F.col("decode_error"), F.col("element_error"),
        quality.reasons(
            quality.missing(F.col("flight_iata"), "flight.iata"),
            quality.missing(F.col("departure_airport_iata"), "departure.iata"),
            quality.missing(F.col("_sd.value"), "departure.scheduled"),
            F.col("_sd.error"), F.col("_ad.error"), F.col("_sa.error"), F.col("_aa.error"),
            F.col("_dl.error")))
    bad = F.col("quality_reason").isNotNull()
    whole = F.col("_whole")

    def kept(c: Column) -> Column:
        """Fields parsed from a record survive quarantine; body-level rows are empty."""
        return F.when(whole, c)

    key = keys.instance_key(F.col("flight_iata"), F.col("departure_airport_iata"), F.col("_sd.value"))
    # The routed row is emitted through a one-element ``inline``: predicates
    # on its columns (``quality_status = ...``) then stay above the generator
    # instead of being pushed down and re-expanding every typing layer inside
    # the filter, so each record is typed exactly once.
    return typed.withColumn("quality_reason", reason).select(F.inline(F.array(F.struct(
        F.when(bad, keys.quarantine_key(F.col("payload_sha256"), F.col("pos")))
        .otherwise(key).alias("flight_instance_key"),
        *[kept(F.col(c)).alias(c) for c in ("flight_iata", "flight_status", "airline_iata",
                                            "airline_name", "departure_airport_iata",
                                            "departure_airport_name", "arrival_airport_iata",
                                            "arrival_airport_name")],
        kept(F.col("_sd.value")).alias("scheduled_departure_at"),
        kept(F.col("_ad.value")).alias("actual_departure_at"),
        kept(F.col("_sa.value")).alias("scheduled_arrival_at"),
        kept(F.col("_aa.value")).alias("actual_arrival_at"),
        kept(F.col("_dl.value")).alias("delay_minutes"),
        kept(numbers.is_delayed(F.col("_dl.value"))).alias("is_delayed"),
        F.col("observed_at"),
        F.col("object_path").alias("source_file"),
        F.col("payload_sha256"),
        F.when(bad, F.lit("quarantined")).otherwise(F.lit("valid")).alias("quality_status"),
        F.col("quality_reason"),
        *[kept(F.col(a)).alias(a) for a in additive],
        *[F.coalesce(kept(F.col(f"_saw_{a}")), F.lit(False)).alias(f"_saw_{a}") for a in additive],
        F.col("pos"),
    ))))


def parse(payloads: DataFrame, additive: Sequence[str] = ("aircraft_type",),
          keep_pos: bool = False) -> DataFrame:
    """Landed payloads ``(object_path, observed_at, payload_sha256, body)`` →
    observations (contract columns, additive fields, ``_saw_<field>`` flags)."""
    out = normalize(explode_records(decode(payloads)), additive)
    cols = [*OBSERVATION_COLUMNS, *additive, *[f"_saw_{a}" for a in additive]]
    return out.select(*cols, *(["pos"] if keep_pos else []))


def observations(parsed: DataFrame, additive: Sequence[str] = ("aircraft_type",)) -> DataFrame:
    """Drop the ``_saw_`` flags (after ``saw`` has been taken from them)."""
    return parsed.drop(*[f"_saw_{a}" for a in additive])


def saw_additive(parsed: DataFrame, name: str = "aircraft_type") -> DataFrame:
    """``saw`` over parsed rows (same answer as ``saw_field`` on records)."""
    return parsed.agg(F.coalesce(F.bool_or(f"_saw_{name}"), F.lit(False)).alias("saw"))
