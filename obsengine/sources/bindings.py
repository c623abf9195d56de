"""Bindings: observation-shaped data derived by Spark from the driver tables.

* ``flight_obs``   — lineitem ⋈ orders ⋈ customer ⋈ supplier as a log of flight
  observations; (l_orderkey, l_linenumber) repeats, so it is a real
  duplicate / late-correction log.
* ``payload_log``  — one JSON response body per 4 consecutive events (bounded
  body size whatever the skew), with seeded faults, as landed payloads.
* ``response_log`` — events as raw API responses (status, body, errors,
  request parameters) for the landing rules.
* ``attempt_log``  — events as request attempts (4 per request) for the
  retry rule.

Everything is a lazy DataFrame over the given tables, so work grows with them.
Joins are plain equi-joins: AQE turns a side into a broadcast only when its
runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
otherwise they stay shuffled sort-merge joins.  Only the supplier lookup, two numbers a
row, is broadcast by its row count (``LOOKUP_ROWS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import instance_key
from .tables import read

# Fixed values of the generated payloads (source name and endpoint of the
# object key layout, pagination block).
SOURCE = "flightapi"
ENDPOINT = "flights"
BUCKET = "landing"
EVENTS_PER_BODY = 4
LOOKUP_ROWS = 1 << 20  # of two numbers each: some 40 MB as a hash table


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def _lookup(pairs: DataFrame) -> DataFrame:
    """Two number columns, broadcast up to ``LOOKUP_ROWS`` rows (counted from the file footers),
    whatever the session's limit: the other side is a log, which is then not shuffled for it."""
    return F.broadcast(pairs) if pairs.count() <= LOOKUP_ROWS else pairs


def flight_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight observations with the observation schema (all rows valid)."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders ⋈ customer first (an orders-sized shuffle), then one lineitem
    # shuffle by order key; the supplier lookup is a broadcast, and
    # only above LOOKUP_ROWS rows the second and last lineitem-sized shuffle
    oc = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    j = (li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(_lookup(s), F.col("l_suppkey") == F.col("s_suppkey")))
    flight = F.concat(F.lit("FL"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    dep = F.concat(F.lit("P"), F.col("c_nationkey"))
    arr_no = F.col("l_partkey") % 25
    sched = F.col("o_orderdate") + _hours(F.col("o_orderkey") % 24)
    delay = F.col("l_quantity").cast("int")
    sha = F.sha2(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             "l_returnflag", "l_linestatus",
                             F.date_format("l_shipdate", "yyyy-MM-dd")), 256)
    return j.select(
        instance_key(flight, dep, sched).alias("flight_instance_key"),
        flight.alias("flight_iata"),
        F.when(F.col("l_linestatus") == "F", F.lit("landed")).otherwise(F.lit("scheduled"))
        .alias("flight_status"),
        F.concat(F.lit("A"), F.col("s_nationkey")).alias("airline_iata"),
        F.concat(F.lit("Airline "), F.col("s_nationkey"), F.lit(" "), F.col("l_returnflag"),
                 F.col("l_linestatus")).alias("airline_name"),
        dep.alias("departure_airport_iata"),
        F.concat(F.lit("Port "), F.col("c_nationkey"), F.lit(" "), F.col("l_linestatus"))
        .alias("departure_airport_name"),
        F.concat(F.lit("P"), arr_no).alias("arrival_airport_iata"),
        F.concat(F.lit("Port "), arr_no, F.lit(" "), F.col("l_returnflag")).alias("arrival_airport_name"),
        sched.alias("scheduled_departure_at"),
        (sched + _minutes(delay)).alias("actual_departure_at"),
        (sched + _hours(F.lit(3))).alias("scheduled_arrival_at"),
        (sched + _hours(F.lit(3)) + _minutes(delay)).alias("actual_arrival_at"),
        delay.alias("delay_minutes"),
        (delay > 15).alias("is_delayed"),
        F.col("l_shipdate").alias("observed_at"),
        F.concat(F.lit("lineitem/"), F.col("l_partkey"), F.lit("/"), F.col("l_suppkey")).alias("source_file"),
        sha.alias("payload_sha256"),
        F.lit("valid").alias("quality_status"),
        F.lit(None).cast("string").alias("quality_reason"),
    )


# ---------------------------------------------------------------------------
# payload_log: seeded JSON response bodies built from events.
#
# Fixed fault rules (checked in this order per event id i, body id b = i div 4):
#   i % 67 = 0  element is not an object       i % 103 = 0  numeric flight code
#   i % 83 = 0  naive departure.scheduled      i % 89 = 0   negative arrival delay
#   i % 79 = 0  padded text arrival delay      i % 73 = 0   both delays null
#   i % 71 = 0  fractional text arrival delay  i % 61 = 0   blank flight code
#   b % 97 = 5  body whose data is an object   b % 101 = 7  truncated body
# ---------------------------------------------------------------------------

def _q(s: Column) -> Column:
    return F.concat(F.lit('"'), s, F.lit('"'))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def event_fault(i: Column) -> Column:
    return (F.when(i % 67 == 0, "not_object").when(i % 103 == 0, "numeric_code")
            .when(i % 83 == 0, "naive_ts").when(i % 89 == 0, "negative")
            .when(i % 79 == 0, "text_delay").when(i % 73 == 0, "null_delay")
            .when(i % 71 == 0, "bad_arrival_delay").when(i % 61 == 0, "blank_flight")
            .otherwise("ok"))


def body_fault(b: Column) -> Column:
    return F.when(b % 97 == 5, "not_array").when(b % 101 == 7, "truncated").otherwise("ok")


def _record_json(i: Column, ts: Column, u: Column, etype: Column, k: Column, fault: Column) -> Column:
    flight = (F.when(fault == "numeric_code", i.cast("string"))
              .when(fault == "blank_flight", _q(F.lit("  ")))
              .otherwise(_q(F.concat(F.lit("ev"), i))))
    pad = F.when(i % 2 == 0, F.lit("\\t")).otherwise(F.lit(" "))
    sched_text = (F.when(fault == "naive_ts", _iso(ts))
                  .when(i % 3 == 0, F.concat(_iso(ts), F.lit("Z")))
                  .when(i % 3 == 1, F.concat(_iso(ts), F.lit("+00:00")))
                  .otherwise(F.concat(_iso(ts + F.make_dt_interval(F.lit(0), F.lit(5), F.lit(30), F.lit(0))),
                                      F.lit("+05:30"))))
    actual = F.when(i % 5 == 0, F.lit("null")).otherwise(
        _q(F.concat(_iso(ts + _minutes(k)), F.lit("Z"))))
    dep_delay = F.when(fault == "null_delay", F.lit("null")).otherwise(k.cast("string"))
    arr_delay = (F.when(fault == "negative", F.lit("-1"))
                 .when(fault == "text_delay", _q(F.concat(F.lit(" "), (k + 1).cast("string"), F.lit(" "))))
                 .when(fault == "null_delay", F.lit("null"))
                 .when(fault == "bad_arrival_delay", _q(F.concat(k.cast("string"), F.lit(".5"))))
                 .otherwise((k + 1).cast("string")))
    airline_name = F.when(i % 11 == 0, _q(F.lit(""))).otherwise(_q(F.concat(F.lit("Airline "), u % 7)))
    aircraft = (F.when(i % 13 == 0, F.concat(F.lit(',"aircraft_type":"A32'), k % 3, F.lit('N"')))
                .when(i % 13 == 1, F.lit(',"aircraft_type":null')).otherwise(F.lit("")))
    obj = F.concat(
        F.lit('{"flight_status":'), _q(F.concat(F.lit(" "), F.upper(etype), F.lit(" "))),
        F.lit(',"departure":{"airport":'), _q(F.concat(F.lit("Airport "), u % 9)),
        F.lit(',"iata":'), _q(F.concat(pad, F.lit("p"), u % 9, F.lit(" "))),
        F.lit(',"delay":'), dep_delay,
        F.lit(',"scheduled":'), _q(sched_text),
        F.lit(',"actual":'), actual,
        F.lit('},"arrival":{"airport":'), _q(F.concat(F.lit("Airport "), k % 9)),
        F.lit(',"iata":'), _q(F.concat(F.lit("p"), k % 9)),
        F.lit(',"delay":'), arr_delay,
        F.lit(',"scheduled":'), _q(F.concat(_iso(ts + _hours(F.lit(2))), F.lit("Z"))),
        F.lit('},"airline":{"name":'), airline_name,
        F.lit(',"iata":'), _q(F.concat(F.lit("a"), u % 7)),
        F.lit('},"flight":{"iata":'), flight,
        F.lit('}'), aircraft, F.lit('}'),
    )
    return F.when(fault == "not_object", F.concat(F.lit("["), i, F.lit("]"))).otherwise(obj)


def event_records(spark: SparkSession, sf_dir: str, by_body: bool = False) -> DataFrame:
    """One row per event: body id, position, fault class and record JSON text."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    raw = e.select(
        i.alias("event_id"), "ts", "user_id", "event_type", k.alias("k"),
        (i.cast("long") / EVENTS_PER_BODY).cast("long").alias("body_id"),
        (i % EVENTS_PER_BODY).cast("int").alias("pos"))
    # shuffled to their bodies before the text is made: it is many times as wide
    raw = raw.repartition("body_id") if by_body else raw
    return raw.withColumn("fault", event_fault(i)).withColumn(
        "record", _record_json(i, F.col("ts"), F.col("user_id"), F.col("event_type"), F.col("k"), F.col("fault")))


def object_path(ingested_at: Column, name: Column, source: str = SOURCE,
                endpoint: str = ENDPOINT) -> Column:
    return F.concat(F.lit(f"bronze/source={source}/endpoint={endpoint}/ingestion_date="),
                    F.date_format(ingested_at, "yyyy-MM-dd"), F.lit("/"), name, F.lit(".json"))


def payload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads ``(object_path, observed_at, payload_sha256, body)``.

    Bodies group 4 consecutive event ids (bounded group size, so no hot group
    is ever collected into one task); element order is restored with a sort of
    the ≤4 collected (pos, record) pairs.
    """
    r = event_records(spark, sf_dir, by_body=True)
    bodies = r.groupBy("body_id").agg(
        F.max("ts").alias("observed_at"),
        F.array_sort(F.collect_list(F.struct("pos", "record"))).alias("items"))
    data = F.concat_ws(",", F.transform("items", lambda x: x["record"]))
    b = F.col("body_id")
    full = F.concat(F.lit('{"pagination":{"offset":'), b * EVENTS_PER_BODY,
                    F.lit(',"count":'), F.size("items"), F.lit('},"data":['), data, F.lit("]}"))
    fault = body_fault(b)
    text = (F.when(fault == "not_array", F.concat(F.lit('{"data":{"offset":'), b * EVENTS_PER_BODY, F.lit("}}")))
            .when(fault == "truncated", F.expr("substring(_full, 1, length(_full) - 2)"))
            .otherwise(F.col("_full")))
    return (bodies.withColumn("_full", full)
            .select(object_path(F.col("observed_at"), F.concat(F.lit("b"), b)).alias("object_path"),
                    "observed_at", F.encode(text, "UTF-8").alias("body"))
            .withColumn("payload_sha256", F.sha2(F.col("body"), 256))
            .select("object_path", "observed_at", "payload_sha256", "body"))


# ---------------------------------------------------------------------------
# response_log: events as API responses (fixed rules by k = props.k, id i).
#   k % 10 = 0 → no response (status 0, no body, transport error)
#   error events → 500 with a non-JSON body (even k) or 429 with an error body
#   other 200 bodies by k % 7: 0 not JSON, 1 data null, 2 data absent,
#   3 data object, 4 JSON array, else an array of k % 4 objects
#   i % 17 = 3 → object storage failure; i % 37 = 0 → invalid endpoint 'a/b',
#   else i % 5 = 0 → endpoint '/flights/'; Access_Key when i % 3 = 0, token
#   when i % 7 = 1 (credentials: redacted, and refused by the client check)
# ---------------------------------------------------------------------------

def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw responses ``(ingestion_id, http_status, body, transport_error,
    storage_error, endpoint, params, ingested_at)``."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(k % 10 == 0, 0).when((F.col("event_type") == "error") & (k % 2 == 0), 500)
              .when(F.col("event_type") == "error", 429).otherwise(200))
    items = F.array_join(F.array_repeat(F.lit("{}"), k % 4), ",")
    ok_body = (F.when(k % 7 == 0, F.lit("not-json")).when(k % 7 == 1, F.lit('{"data":null}'))
               .when(k % 7 == 2, F.lit('{"pagination":{}}')).when(k % 7 == 3, F.lit('{"data":{"a":1}}'))
               .when(k % 7 == 4, F.lit("[1,2]"))
               .otherwise(F.concat(F.lit('{"data":['), items, F.lit("]}"))))
    body = (F.when(status == 0, F.lit(None)).when(status == 500, F.lit("oops"))
            .when(status == 429, F.lit('{"error":{"code":"rate_limit"}}')).otherwise(ok_body))
    transport = (F.when(status == 0, F.lit("request failed: timed out"))
                 .when(status == 429, F.lit("HTTP 429: Too Many Requests")))
    storage = F.when(body.isNotNull() & (i % 17 == 3), F.lit("object storage failed: disk full"))
    params = F.map_filter(F.create_map(
        F.lit("dep_iata"), F.concat(F.lit("P"), F.col("user_id") % 9),
        F.lit("limit"), k.cast("string"),
        F.lit("Access_Key"), F.when(i % 3 == 0, F.concat(F.lit("secret"), i)),
        F.lit("token"), F.when(i % 7 == 1, F.concat(F.lit("t"), i))), lambda _k, v: v.isNotNull())
    return e.select(
        F.concat(F.lit("r"), i).alias("ingestion_id"),
        status.cast("int").alias("http_status"),
        F.encode(body, "UTF-8").alias("body"),
        transport.cast("string").alias("transport_error"),
        storage.cast("string").alias("storage_error"),
        F.when(i % 37 == 0, F.lit("a/b")).when(i % 5 == 0, F.lit("/flights/"))
        .otherwise(F.lit("flights")).alias("endpoint"),
        params.alias("params"),
        F.col("ts").alias("ingested_at"),
    )


def param_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(request_id, items ARRAY<STRING>)``: KEY=VALUE lists with a repeated
    key (last wins), a value holding '=', and seeded malformed items."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "props")
    i = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    extra = (F.when(k % 10 == 3, F.lit("broken")).when(k % 10 == 4, F.lit("=empty"))
             .otherwise(F.concat(F.lit("note=a=b"), k)))
    return e.select(i.alias("request_id"), F.array(
        F.concat(F.lit("dep_iata=P"), F.col("user_id") % 9),
        F.concat(F.lit("limit="), k),
        extra,
        F.concat(F.lit("dep_iata=Q"), k % 9),
    ).alias("items"))


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts ``(request_id, attempt, http_status)``: 4 consecutive events
    per request; error → 503, view → no response (0), click → 429, else 200."""
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    i = F.col("event_id")
    status = (F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "view", 0)
              .when(F.col("event_type") == "click", 429).otherwise(200))
    return e.select((i.cast("long") / EVENTS_PER_BODY).cast("long").alias("request_id"),
                    (i % EVENTS_PER_BODY + 1).cast("int").alias("attempt"),
                    status.cast("int").alias("http_status"))
