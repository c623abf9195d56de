"""Landing: raw responses → append-only response log, and log → payloads.

All rules are column expressions over a *batch* of responses, so landing a
million responses is one narrow stage.  ``ingestion_id`` comes from the input
(deterministic), never from a per-row random id, so a retried task writes the
same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import variant
from ..schemas import MANIFEST
from .payload import NOT_ARRAY, NOT_JSON

# Request parameters never stored (compared lower-case).
SENSITIVE_PARAMETERS = ("access_key", "api_key", "token")


# -- column rules ------------------------------------------------------------

def payload_sha256(body: Column) -> Column:
    """Hex SHA-256 of the exact bytes; NULL body → NULL."""
    return F.sha2(body, 256)


def record_count(body: Column) -> Column:
    """struct(count INT, error STRING) of a response body.

    NULL body → (0, NULL); not JSON, or JSON that is not an object →
    (0, NOT_JSON); ``data`` absent / null → (0, NULL); array → (length, NULL);
    anything else → (0, NOT_ARRAY).
    """
    doc = F.try_parse_json(variant.body_text(body))
    data = variant.field(doc, "data")
    arr = variant.as_array(data)
    is_obj = variant.is_object(doc)
    count = F.when(body.isNotNull() & is_obj & arr.isNotNull(), F.size(arr)).otherwise(F.lit(0))
    error = (F.when(body.isNull(), F.lit(None))
             .when(doc.isNull() | ~is_obj, F.lit(NOT_JSON))
             .when(variant.is_missing(data), F.lit(None))
             .when(arr.isNull(), F.lit(NOT_ARRAY)))
    return F.struct(count.cast("int").alias("count"), error.cast("string").alias("error"))


def error_message(http_status: Column, *errors: Column) -> Column:
    """Errors joined with '; ' in order; none and a non-2xx status →
    ``HTTP <status>``; empty → NULL."""
    joined = F.concat_ws("; ", *errors)
    return F.when(joined != F.lit(""), joined).when(
        ~http_status.between(200, 299), F.concat(F.lit("HTTP "), http_status.cast("string")))


def normalize_endpoint(endpoint: Column) -> Column:
    return F.regexp_replace(endpoint, r"^/+|/+$", "")


def valid_endpoint(endpoint: Column) -> Column:
    """One relative path segment: non-empty, no inner '/', not '..'."""
    e = normalize_endpoint(endpoint)
    return (e != F.lit("")) & ~e.contains("/") & (e != F.lit(".."))


def _sensitive(k: Column) -> Column:
    return F.lower(k).isin(*SENSITIVE_PARAMETERS)


def redact_params(params: Column) -> Column:
    """Drop credential keys; compact JSON with sorted keys."""
    kept = F.map_filter(params, lambda k, v: ~_sensitive(k))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def has_credentials(params: Column) -> Column:
    """A credential-named request parameter (rejected by the client)."""
    return F.exists(F.map_keys(params), _sensitive)


def parse_params(items: Column) -> Column:
    """KEY=VALUE list → struct(params MAP, invalid ARRAY<STRING>).

    Split at the first '='; an item without '=' or with an empty key is
    reported in ``invalid`` (flagged, not raised); the last duplicate wins.
    """
    pairs = F.transform(items, lambda s, i: F.struct(
        i.alias("i"), F.split(s, "=", 2).alias("kv"), s.alias("s")))
    good = F.filter(pairs, lambda p: (F.size(p["kv"]) == 2) & (p["kv"][0] != F.lit("")))
    bad = F.transform(F.filter(pairs, lambda p: (F.size(p["kv"]) < 2) | (p["kv"][0] == F.lit(""))),
                      lambda p: p["s"])
    # last occurrence wins: keep an entry only when no later entry has its key
    last = F.filter(good, lambda p: ~F.exists(
        good, lambda q: (q["kv"][0] == p["kv"][0]) & (q["i"] > p["i"])))
    entries = F.transform(last, lambda p: F.struct(p["kv"][0].alias("key"), p["kv"][1].alias("value")))
    return F.struct(F.map_from_entries(entries).alias("params"), bad.alias("invalid"))


def object_key(source: str, endpoint: Column, ingested_at: Column, ingestion_id: Column) -> Column:
    """``bronze/source=S/endpoint=E/ingestion_date=yyyy-MM-dd/<id>.json`` (UTC date)."""
    return F.concat(F.lit(f"bronze/source={source}/endpoint="), normalize_endpoint(endpoint),
                    F.lit("/ingestion_date="), F.date_format(ingested_at, "yyyy-MM-dd"),
                    F.lit("/"), ingestion_id, F.lit(".json"))


# -- DataFrame operators -----------------------------------------------------

def land_responses(responses: DataFrame, source: str, bucket: str) -> DataFrame:
    """Responses ``(ingestion_id, http_status, body, transport_error,
    storage_error, endpoint, params, ingested_at)`` → response-log rows.

    A body that failed to store still gets a row with a NULL path; no body
    (network failure) → no object and a NULL checksum.  Requests with an
    invalid endpoint are excluded (see ``rejected_requests``).
    """
    r = responses.where(valid_endpoint(F.col("endpoint")))
    stored = F.col("body").isNotNull() & F.col("storage_error").isNull()
    path = F.concat(F.lit(f"s3a://{bucket}/"),
                    object_key(source, F.col("endpoint"), F.col("ingested_at"), F.col("ingestion_id")))
    rc = record_count(F.col("body"))
    return r.select(
        F.col("ingestion_id"), F.lit(source).alias("source_name"),
        normalize_endpoint(F.col("endpoint")).alias("endpoint"),
        redact_params(F.col("params")).alias("request_parameters"),
        F.when(stored, path).alias("object_path"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        F.col("http_status").cast("int").alias("http_status"),
        payload_sha256(F.col("body")).alias("payload_sha256"),
        rc["count"].alias("record_count"),
        error_message(F.col("http_status"), F.col("transport_error"), F.col("storage_error"),
                      rc["error"]).alias("error_message"),
    )


def rejected_requests(responses: DataFrame) -> DataFrame:
    """Requests the client refuses: invalid endpoint or credentials in params."""
    bad_endpoint = ~valid_endpoint(F.col("endpoint"))
    creds = has_credentials(F.col("params"))
    return responses.where(bad_endpoint | creds).select(
        "ingestion_id",
        F.concat_ws("; ", F.when(bad_endpoint, F.lit("endpoint must be a single relative path segment")),
                    F.when(creds, F.lit("credentials must not be passed as request parameters")))
        .alias("reason"))


def _missing(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Rows, once each, whose ``key`` the table below ``path`` does not hold yet.  The key
    lies in its landing date, so only the dates of the rows are read."""
    spark = rows.sparkSession
    rows = rows.dropDuplicates([key])
    try:
        held = spark.read.parquet(path)
    except AnalysisException:
        return rows
    dates = [r[0] for r in rows.select("ingestion_date").distinct().collect()]
    held = held.where(F.col("ingestion_date").isin(dates)).select(key)
    return rows.join(held, key, "left_anti")


def store_bodies(responses: DataFrame, source: str, bucket: str, path: str) -> None:
    """Append the exact bytes of every body that the log will name to the body
    store (``path, content``, partitioned by ``ingestion_date``), unless the store holds
    its object already.  Runs before ``append_log``: a log row never names a body
    that is not there."""
    r = responses.where(valid_endpoint(F.col("endpoint")) & F.col("body").isNotNull()
                        & F.col("storage_error").isNull())
    bodies = r.select(F.concat(F.lit(f"s3a://{bucket}/"), object_key(
                          source, F.col("endpoint"), F.col("ingested_at"), F.col("ingestion_id"))).alias("path"),
                      F.col("body").alias("content"), F.to_date("ingested_at").alias("ingestion_date"))
    _missing(bodies, path, "path").select("path", "content", "ingestion_date").write.mode("append").partitionBy(
        "ingestion_date").parquet(path)


def land(responses: DataFrame, source: str, bucket: str, store_path: str, log_path: str) -> None:
    """Bodies first, then their log rows.  A landing that broke off is landed again: what
    is there stays, what is missing is added (one writer at a time)."""
    store_bodies(responses, source, bucket, store_path)
    append_log(land_responses(responses, source, bucket), log_path, only_new=True)


def append_log(log: DataFrame, path: str, only_new: bool = False) -> None:
    """Append log rows to the partitioned log table (``ingestion_date``); with ``only_new``
    one row for each ``ingestion_id`` that it does not hold."""
    rows = (log.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST.fields])
            .withColumn("ingestion_date", F.to_date("ingested_at")))
    if only_new:
        rows = _missing(rows, path, "ingestion_id").select(*rows.columns)
    rows.write.mode("append").partitionBy("ingestion_date").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_payload_files(spark: SparkSession, glob: str) -> DataFrame:
    """Landed files ``(path, modificationTime, length, content)``, many at once."""
    return spark.read.format("binaryFile").load(glob)


def select_window(log: DataFrame, as_of: datetime, hours: int = 48) -> DataFrame:
    """Successful, stored responses ingested in the look-back window.

    ``as_of`` is a parameter (determinism); when the log carries the
    ``ingestion_date`` partition column, a derived date predicate prunes
    partitions before the timestamp test.
    """
    if hours < 1:
        raise ValueError("look-back hours must be positive")
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))
    w = log.where(F.col("http_status").between(200, 299) & F.col("object_path").isNotNull()
                  & (F.col("ingested_at") >= start))
    if "ingestion_date" in log.columns:
        w = w.where(F.col("ingestion_date") >= F.to_date(start))
        return w.select("object_path", "ingested_at", "payload_sha256", "ingestion_date")
    return w.select("object_path", "ingested_at", "payload_sha256")


def attach_payloads(window: DataFrame, payloads: DataFrame, path_col: str = "path",
                    content_col: str = "content") -> DataFrame:
    """Log window ⋈ payload store on the object path (executor-side read).

    An object that the store holds twice is read once.  A logged object that it does not
    hold fails the job: a window that is silently short would lose observations.  When both sides carry
    ``ingestion_date``, the store is read for the window's dates only."""
    keys = ["object_path"]
    cols = [F.col(path_col).alias("object_path"), F.col(content_col).alias("body"),
            F.lit(True).alias("_stored")]
    if "ingestion_date" in window.columns and "ingestion_date" in payloads.columns:
        keys.append("ingestion_date")
        cols.append(F.col("ingestion_date"))
    missing = F.raise_error(F.concat(F.lit("no stored body for "), F.col("object_path")))
    # grouped by the join's keys: no shuffle of its own
    return window.join(payloads.select(*cols).dropDuplicates(keys), keys, "left").select(
        "object_path", F.col("ingested_at").alias("observed_at"), "payload_sha256",
        F.when(F.col("_stored"), F.col("body")).otherwise(missing.cast("binary")).alias("body"))


def terminal_attempt(attempts: DataFrame, max_attempts: int = 3, key: str = "request_id") -> DataFrame:
    """One row per request: the first attempt (≤ max) with 0 < status < 500,
    else the last attempt; ``backoff_seconds`` = Σ 2^(n-1) over the attempts
    that were retried.  Hash aggregation with map-side combine (skew-safe)."""
    a = attempts.where(F.col("attempt") <= max_attempts)
    terminal = (F.col("http_status") > 0) & (F.col("http_status") < 500)
    agg = a.groupBy(key).agg(
        F.min(F.when(terminal, F.col("attempt"))).alias("_first_ok"),
        F.max("attempt").alias("_last"),
        F.max_by("http_status", "attempt").alias("_last_status"),
        F.min_by(F.when(terminal, F.col("http_status")),
                 F.when(terminal, F.col("attempt")).otherwise(F.lit(max_attempts + 1))).alias("_ok_status"),
    )
    n = F.coalesce(F.col("_first_ok"), F.col("_last"))
    return agg.select(
        key, n.alias("attempts"),
        F.when(F.col("_first_ok").isNotNull(), F.col("_ok_status")).otherwise(F.col("_last_status"))
        .alias("http_status"),
        (F.pow(F.lit(2), n - 1) - 1).cast("long").alias("backoff_seconds"),
    )
