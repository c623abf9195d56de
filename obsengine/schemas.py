"""Declared table schemas.

Timestamps are ``TIMESTAMP_NTZ`` values that hold UTC wall-clock time (the
session time zone is pinned to UTC wherever a text form is rendered), so
results compare directly with naive UTC timestamps in other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Append-only response log (one row per response, failures included).
MANIFEST = _schema(
    ("ingestion_id", S, False), ("source_name", S, False), ("endpoint", S, False),
    ("request_parameters", S, False), ("object_path", S, True), ("ingested_at", TS, False),
    ("http_status", I, False), ("payload_sha256", S, True), ("record_count", I, False),
    ("error_message", S, True),
)

# Typed observation / current-state row; ``aircraft_type`` is the additive field.
OBSERVATION_BASE = [
    ("flight_instance_key", S, False), ("flight_iata", S, True), ("flight_status", S, True),
    ("airline_iata", S, True), ("airline_name", S, True),
    ("departure_airport_iata", S, True), ("departure_airport_name", S, True),
    ("arrival_airport_iata", S, True), ("arrival_airport_name", S, True),
    ("scheduled_departure_at", TS, True), ("actual_departure_at", TS, True),
    ("scheduled_arrival_at", TS, True), ("actual_arrival_at", TS, True),
    ("delay_minutes", I, True), ("is_delayed", B, True),
    ("observed_at", TS, False), ("source_file", S, False), ("payload_sha256", S, False),
    ("quality_status", S, False), ("quality_reason", S, True),
]
OBSERVATION = _schema(*OBSERVATION_BASE)
OBSERVATION_EVOLVED = _schema(*OBSERVATION_BASE, ("aircraft_type", S, True))
OBSERVATION_COLUMNS = [f[0] for f in OBSERVATION_BASE]
ADDITIVE_FIELDS = [T.StructField("aircraft_type", S, True)]
LABEL_FIELDS = [T.StructField(n, S, True) for n in
                ("airline_name", "departure_airport_name", "arrival_airport_name")]
DIGESTS = ["flight_instance_key", "payload_sha256"]  # hex, half as long in bytes
LABEL_COLUMNS = ["airline_name", "departure_airport_name", "arrival_airport_name"]

# Newest-wins order within one business key (all non-null).
OBSERVATION_KEY = ["flight_instance_key"]
OBSERVATION_ORDER = ["observed_at", "payload_sha256", "source_file"]
FACT_ORDER = ["observed_at", "source_file"]

FACT = _schema(
    ("flight_instance_key", S, False), ("airline_iata", S, True),
    ("departure_airport_iata", S, True), ("arrival_airport_iata", S, True),
    ("scheduled_departure_at", TS, True), ("delay_minutes", I, True), ("is_delayed", B, True),
    ("observed_at", TS, False), ("source_file", S, False),
)
FACT_COLUMNS = [f.name for f in FACT.fields]


def dimension(key: str, label: str, table: str) -> T.StructType:
    return _schema((f"{table}_sk", S, False), (key, S, False), (label, S, True),
                   ("effective_from", TS, False), ("effective_to", TS, True),
                   ("is_current", B, False))


AIRLINE_DIM = dimension("airline_iata", "airline_name", "airline")
AIRPORT_DIM = dimension("airport_iata", "airport_name", "airport")


def rollup(key: str) -> T.StructType:
    return _schema((key, S, True), ("hour_start_at", TS, True), ("total_flights", L, False),
                   ("delayed_flights", L, True), ("delay_rate", D, True),
                   ("average_delay_minutes", D, True))


AIRLINE_HOUR = rollup("airline_iata")
AIRPORT_HOUR = rollup("airport_iata")
ROLLUP_MEASURES = ["total_flights", "delayed_flights", "delay_rate", "average_delay_minutes"]


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The initial state of any table: no rows, declared schema."""
    return spark.createDataFrame([], schema)
