"""Independent DuckDB SQL for every registered query.

The SQL derives each expected result from the raw driver tables by definition (newest row
of a key, sums and counts of a group, what a pair of versions leaves behind, fault rules
of an event's body) rather than by replaying the engine's own operators.  Column names
and types match the Spark results.
"""

from __future__ import annotations

from .queries import (AS_OF, CUT, DETAIL_ROWS, LOOKBACK_AS_OF, LOOKBACK_HOURS, RECENT,
                      RUN_HOURS, WINDOW_START)


def _iso(ts: str) -> str:
    frac = f"strftime({ts}, '%f')"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {frac} <> '000000' "
            f"THEN '.' || {frac} ELSE '' END || '+00:00')")


# -- flight observations -----------------------------------------------------

_SCHED = "(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)))"
_DELAY = "CAST(l.l_quantity AS INTEGER)"

FLIGHT_OBS = f"""
flight_obs AS (
  SELECT
    sha256('FL' || l.l_orderkey || '-' || l.l_linenumber || '|P' || c.c_nationkey || '|' || {_iso(_SCHED)})
      AS flight_instance_key,
    'FL' || l.l_orderkey || '-' || l.l_linenumber AS flight_iata,
    CASE WHEN l.l_linestatus = 'F' THEN 'landed' ELSE 'scheduled' END AS flight_status,
    'A' || s.s_nationkey AS airline_iata,
    'Airline ' || s.s_nationkey || ' ' || l.l_returnflag || l.l_linestatus AS airline_name,
    'P' || c.c_nationkey AS departure_airport_iata,
    'Port ' || c.c_nationkey || ' ' || l.l_linestatus AS departure_airport_name,
    'P' || (l.l_partkey % 25) AS arrival_airport_iata,
    'Port ' || (l.l_partkey % 25) || ' ' || l.l_returnflag AS arrival_airport_name,
    {_SCHED} AS scheduled_departure_at,
    {_SCHED} + to_minutes({_DELAY}) AS actual_departure_at,
    {_SCHED} + INTERVAL 3 HOUR AS scheduled_arrival_at,
    {_SCHED} + INTERVAL 3 HOUR + to_minutes({_DELAY}) AS actual_arrival_at,
    {_DELAY} AS delay_minutes,
    {_DELAY} > 15 AS is_delayed,
    l.l_shipdate AS observed_at,
    'lineitem/' || l.l_partkey || '/' || l.l_suppkey AS source_file,
    sha256(concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag,
                     l.l_linestatus, strftime(l.l_shipdate, '%Y-%m-%d'))) AS payload_sha256,
    'valid' AS quality_status,
    CAST(NULL AS VARCHAR) AS quality_reason
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

_ORDER = "observed_at DESC, payload_sha256 DESC, source_file DESC"


def _latest(src: str, name: str, where: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_instance_key ORDER BY {_ORDER}) AS _rn
    FROM {src} WHERE {where}) WHERE _rn = 1)"""


def _fact(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT flight_instance_key, airline_iata, departure_airport_iata, arrival_airport_iata,
         scheduled_departure_at, delay_minutes, is_delayed, observed_at, source_file
  FROM {src} WHERE quality_status = 'valid' AND delay_minutes IS NOT NULL)"""


def _rollup(src: str, name: str, key: str, out_key: str) -> str:
    """Counts and sums of a group first, its ratios from them."""
    return f"""
{name} AS (
  SELECT code AS {out_key}, hour_start_at, n AS total_flights, late AS delayed_flights,
         late / n::DOUBLE AS delay_rate, minutes / timed::DOUBLE AS average_delay_minutes
  FROM (SELECT {key} AS code, time_bucket(INTERVAL 1 HOUR, scheduled_departure_at) AS hour_start_at,
               count(*) AS n, count(*) FILTER (is_delayed) AS late,
               sum(delay_minutes) AS minutes, count(delay_minutes) AS timed
        FROM {src} GROUP BY ALL)
  WHERE code IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_EARLY = f"observed_at < TIMESTAMP '{CUT}'"
_LATE = f"observed_at >= TIMESTAMP '{CUT}'"

GOLD = _with(FLIGHT_OBS, _latest("flight_obs", "silver"), _fact("silver", "fact"),
             _rollup("fact", "airline_hour", "airline_iata", "airline_iata"),
             _rollup("fact", "airport_hour", "departure_airport_iata", "airport_iata"))

_W = "ROUND(SUM(average_delay_minutes * total_flights) / NULLIF(SUM(total_flights), 0), 9)"


def _by_key(src: str, key: str) -> str:
    return f"""
SELECT {key}, n AS total_flights, late AS delayed_flights, late / nullif(n, 0)::DOUBLE AS delay_rate,
       round(minutes / nullif(n, 0), 9) AS average_delay_minutes
FROM (SELECT {key}, sum(total_flights)::BIGINT AS n, sum(delayed_flights)::BIGINT AS late,
             sum(total_flights * average_delay_minutes) AS minutes
      FROM {src} GROUP BY ALL)
ORDER BY delay_rate DESC NULLS LAST, n DESC NULLS LAST, {key} NULLS LAST"""


def _upsert_latest_sql(state: str, stage: str, cols: list[str], order: list[str],
                       backfill: list[str] = ()) -> str:
    """Every key of either side once: the newer of its two rows, the state's on a tie
    unless the stage has a label that the state lacks."""
    new, old = (f"({', '.join(f'{side}.{c}' for c in order)})" for side in "st")
    wins = f"{new} > {old}"
    if backfill:
        fills = " OR ".join(f"t.{c} IS NULL AND s.{c} IS NOT NULL" for c in backfill)
        wins += f" OR {new} = {old} AND ({fills})"
    newer = f"t.flight_instance_key IS NULL OR s.flight_instance_key IS NOT NULL AND ({wins})"
    picked = ", ".join(f"CASE WHEN {newer} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"""
SELECT {picked} FROM {state} t FULL JOIN {stage} s ON s.flight_instance_key = t.flight_instance_key"""


OBS_COLS = ["flight_instance_key", "flight_iata", "flight_status", "airline_iata", "airline_name",
            "departure_airport_iata", "departure_airport_name", "arrival_airport_iata",
            "arrival_airport_name", "scheduled_departure_at", "actual_departure_at",
            "scheduled_arrival_at", "actual_arrival_at", "delay_minutes", "is_delayed",
            "observed_at", "source_file", "payload_sha256", "quality_status", "quality_reason"]
FACT_COLS = ["flight_instance_key", "airline_iata", "departure_airport_iata", "arrival_airport_iata",
             "scheduled_departure_at", "delay_minutes", "is_delayed", "observed_at", "source_file"]
LABELS = ["airline_name", "departure_airport_name", "arrival_airport_name"]
MEASURES = ["total_flights", "delayed_flights", "delay_rate", "average_delay_minutes"]


def _upsert_changed_sql(before: str, after: str, keys: list[str], keep_missing: bool) -> str:
    on = " AND ".join(f"b.{k} IS NOT DISTINCT FROM a.{k}" for k in keys)
    same = " AND ".join(f"b.{m} IS NOT DISTINCT FROM a.{m}" for m in MEASURES)
    cols = ", ".join(f"CASE WHEN a._in THEN a.{c} ELSE b.{c} END AS {c}" for c in [*keys, *MEASURES])
    tag = (f"CASE WHEN b._in IS NULL THEN 'insert' WHEN a._in IS NULL THEN "
           f"'{'keep' if keep_missing else 'delete'}' WHEN {same} THEN 'keep' ELSE 'update' END")
    return f"""
SELECT * FROM (
  SELECT {cols}, {tag} AS _change
  FROM (SELECT *, TRUE AS _in FROM {before}) b FULL OUTER JOIN (SELECT *, TRUE AS _in FROM {after}) a ON {on})
WHERE _change <> 'delete'"""


def _history_sql(src: str, key: str, label: str, table: str) -> str:
    return f"""
SELECT sha256({key} || '|' || CAST(observed_at AS VARCHAR)) AS {table}_sk, {key}, {label},
       observed_at AS effective_from,
       lead(observed_at) OVER (PARTITION BY {key} ORDER BY observed_at) AS effective_to,
       lead(observed_at) OVER (PARTITION BY {key} ORDER BY observed_at) IS NULL AS is_current
FROM (
  SELECT *, lag({label}) OVER w AS _prev, row_number() OVER w AS _pos
  FROM (
    SELECT {key}, COALESCE({label}, {key}) AS {label}, observed_at FROM (
      SELECT *, row_number() OVER (PARTITION BY {key}, observed_at
                                   ORDER BY source_file DESC, payload_sha256 DESC) AS _rn
      FROM {src} WHERE {key} IS NOT NULL AND quality_status = 'valid') WHERE _rn = 1)
  WINDOW w AS (PARTITION BY {key} ORDER BY observed_at))
WHERE _pos = 1 OR _prev IS DISTINCT FROM {label}"""


def _newest_label(src: str, name: str, key: str, label: str) -> str:
    """Per code the label of its greatest (time, file, label) row."""
    return f"""
{name} AS (
  SELECT {key}, COALESCE(newest.l, {key}) AS {label}, newest.t AS observed_at
  FROM (SELECT {key}, max({{'t': observed_at, 'f': source_file, 'l': {label}}}) AS newest
        FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}))"""


def _airline_stage(src: str, name: str) -> str:
    return _newest_label(f"(SELECT * FROM {src} WHERE quality_status = 'valid')", name,
                         "airline_iata", "airline_name")


def _airport_stage(src: str, name: str) -> str:
    ends = f"""(SELECT observed_at, source_file, unnest(
      [{{'c': departure_airport_iata, 'n': departure_airport_name}},
       {{'c': arrival_airport_iata, 'n': arrival_airport_name}}]) AS airport
    FROM {src} WHERE quality_status = 'valid')"""
    return _newest_label(
        f"(SELECT airport.c AS airport_iata, airport.n AS airport_name, observed_at, source_file FROM {ends})",
        name, "airport_iata", "airport_name")


def _scd_merge_sql(dim: str, stage: str, key: str, label: str, table: str) -> str:
    """One pass over current rows paired with the stage: what a pair leaves behind
    and what it opens."""
    pairs = f"""(
  SELECT c.{table}_sk, c.{key}, c.{label}, c.effective_from, c.effective_to,
         s.{key} AS code, s.{label} AS name, s.observed_at AS seen,
         c.{key} IS NOT NULL AS had,
         s.{key} IS NOT NULL AND (c.{key} IS NULL OR (
           c.{label} IS DISTINCT FROM s.{label} AND s.observed_at > c.effective_from)) AS opens
  FROM (FROM {dim} WHERE is_current) c FULL JOIN {stage} s ON c.{key} = s.{key})"""
    return f"""
SELECT {table}_sk, {key}, {label}, effective_from, effective_to, is_current FROM {dim} WHERE NOT is_current
UNION ALL
SELECT {table}_sk, {key}, {label}, effective_from, CASE WHEN opens THEN seen ELSE effective_to END, NOT opens
FROM {pairs} WHERE had
UNION ALL
SELECT sha256(code || '|' || CAST(seen AS VARCHAR)), code, name, seen, CAST(NULL AS TIMESTAMP), TRUE
FROM {pairs} WHERE opens"""


def _empty_dim(name: str, key: str, label: str, table: str) -> str:
    return f"""
{name} AS (SELECT CAST(NULL AS VARCHAR) AS {table}_sk, CAST(NULL AS VARCHAR) AS {key},
                  CAST(NULL AS VARCHAR) AS {label}, CAST(NULL AS TIMESTAMP) AS effective_from,
                  CAST(NULL AS TIMESTAMP) AS effective_to, CAST(NULL AS BOOLEAN) AS is_current
           WHERE FALSE)"""


# -- payload bodies ----------------------------------------------------------

_ISO6 = "'%Y-%m-%dT%H:%M:%S.%f'"

EVENTS_PAYLOAD = f"""
ev AS (
  SELECT event_id AS i, ts, user_id AS u, event_type AS t,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         event_id // 4 AS b, CAST(event_id % 4 AS INTEGER) AS pos,
         CASE WHEN event_id % 67 = 0 THEN 'not_object' WHEN event_id % 103 = 0 THEN 'numeric_code'
              WHEN event_id % 83 = 0 THEN 'naive_ts' WHEN event_id % 89 = 0 THEN 'negative'
              WHEN event_id % 79 = 0 THEN 'text_delay' WHEN event_id % 73 = 0 THEN 'null_delay'
              WHEN event_id % 71 = 0 THEN 'bad_arrival_delay' WHEN event_id % 61 = 0 THEN 'blank_flight'
              ELSE 'ok' END AS fault
  FROM events),
rec AS (
  SELECT *, CASE WHEN fault = 'not_object' THEN '[' || i || ']' ELSE
    '{{"flight_status":"' || ' ' || upper(t) || ' ' ||
    '","departure":{{"airport":"Airport ' || (u % 9) ||
    '","iata":"' || CASE WHEN i % 2 = 0 THEN '\\t' ELSE ' ' END || 'p' || (u % 9) || ' ' ||
    '","delay":' || CASE WHEN fault = 'null_delay' THEN 'null' ELSE CAST(k AS VARCHAR) END ||
    ',"scheduled":"' || CASE WHEN fault = 'naive_ts' THEN strftime(ts, {_ISO6})
                             WHEN i % 3 = 0 THEN strftime(ts, {_ISO6}) || 'Z'
                             WHEN i % 3 = 1 THEN strftime(ts, {_ISO6}) || '+00:00'
                             ELSE strftime(ts + INTERVAL 330 MINUTE, {_ISO6}) || '+05:30' END ||
    '","actual":' || CASE WHEN i % 5 = 0 THEN 'null'
                          ELSE '"' || strftime(ts + to_minutes(k), {_ISO6}) || 'Z"' END ||
    '}},"arrival":{{"airport":"Airport ' || (k % 9) || '","iata":"p' || (k % 9) ||
    '","delay":' || CASE WHEN fault = 'negative' THEN '-1'
                         WHEN fault = 'text_delay' THEN '" ' || (k + 1) || ' "'
                         WHEN fault = 'null_delay' THEN 'null'
                         WHEN fault = 'bad_arrival_delay' THEN '"' || k || '.5"'
                         ELSE CAST(k + 1 AS VARCHAR) END ||
    ',"scheduled":"' || strftime(ts + INTERVAL 2 HOUR, {_ISO6}) || 'Z"' ||
    '}},"airline":{{"name":' || CASE WHEN i % 11 = 0 THEN '""' ELSE '"Airline ' || (u % 7) || '"' END ||
    ',"iata":"a' || (u % 7) || '"}},"flight":{{"iata":' ||
       CASE WHEN fault = 'numeric_code' THEN CAST(i AS VARCHAR) WHEN fault = 'blank_flight' THEN '"  "'
            ELSE '"ev' || i || '"' END || '}}' ||
    CASE WHEN i % 13 = 0 THEN ',"aircraft_type":"A32' || (k % 3) || 'N"'
         WHEN i % 13 = 1 THEN ',"aircraft_type":null' ELSE '' END || '}}' END AS record
  FROM ev),
bodies AS (
  SELECT b, max(ts) AS observed_at,
         '{{"pagination":{{"offset":' || (b * 4) || ',"count":' || count(*) || '}},"data":[' ||
         string_agg(record, ',' ORDER BY pos) || ']}}' AS full_text
  FROM rec GROUP BY b),
payloads AS (
  SELECT b, observed_at,
         'bronze/source=flightapi/endpoint=flights/ingestion_date=' || strftime(observed_at, '%Y-%m-%d') ||
         '/b' || b || '.json' AS object_path,
         CASE WHEN b % 97 = 5 THEN 'not_array' WHEN b % 101 = 7 THEN 'truncated' ELSE 'ok' END AS bfault,
         sha256(CASE WHEN b % 97 = 5 THEN '{{"data":{{"offset":' || (b * 4) || '}}}}'
                     WHEN b % 101 = 7 THEN substr(full_text, 1, length(full_text) - 2)
                     ELSE full_text END) AS payload_sha256
  FROM bodies),
expected AS (
  SELECT e.*, p.observed_at, p.object_path, p.payload_sha256,
    CASE WHEN e.fault IN ('numeric_code', 'blank_flight') THEN NULL ELSE 'EV' || e.i END AS flight_iata,
    CASE fault WHEN 'negative' THEN NULL WHEN 'null_delay' THEN NULL WHEN 'bad_arrival_delay' THEN NULL
               ELSE e.k + 1 END AS delay_minutes,
    NULLIF(concat_ws('; ',
      CASE WHEN e.fault IN ('numeric_code', 'blank_flight') THEN 'missing flight.iata' END,
      CASE WHEN e.fault = 'naive_ts' THEN 'missing departure.scheduled' END,
      CASE WHEN e.fault = 'naive_ts' THEN 'invalid departure.scheduled' END,
      CASE WHEN e.fault = 'negative' THEN 'negative delay'
           WHEN e.fault = 'bad_arrival_delay' THEN 'invalid delay' END), '') AS reason
  FROM ev e JOIN payloads p ON e.b = p.b WHERE p.bfault = 'ok' AND e.fault <> 'not_object'),
parsed AS (
  SELECT CASE WHEN reason IS NULL
              THEN sha256('EV' || i || '|P' || (u % 9) || '|' || {_iso('ts')})
              ELSE 'quarantine:' || payload_sha256 || ':' || pos END AS flight_instance_key,
         flight_iata, lower(t) AS flight_status, 'A' || (u % 7) AS airline_iata,
         CASE WHEN i % 11 = 0 THEN NULL ELSE 'Airline ' || (u % 7) END AS airline_name,
         'P' || (u % 9) AS departure_airport_iata, 'Airport ' || (u % 9) AS departure_airport_name,
         'P' || (k % 9) AS arrival_airport_iata, 'Airport ' || (k % 9) AS arrival_airport_name,
         CASE WHEN fault = 'naive_ts' THEN NULL ELSE ts END AS scheduled_departure_at,
         CASE WHEN i % 5 = 0 THEN NULL ELSE ts + to_minutes(k) END AS actual_departure_at,
         ts + INTERVAL 2 HOUR AS scheduled_arrival_at,
         CAST(NULL AS TIMESTAMP) AS actual_arrival_at,
         CAST(delay_minutes AS INTEGER) AS delay_minutes, delay_minutes > 15 AS is_delayed,
         observed_at, object_path AS source_file, payload_sha256,
         CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantined' END AS quality_status,
         reason AS quality_reason,
         CASE WHEN i % 13 = 0 THEN lower('A32' || (k % 3) || 'N') END AS aircraft_type,
         i % 13 IN (0, 1) AS _saw, pos
  FROM expected
  UNION ALL
  SELECT 'quarantine:' || p.payload_sha256 || ':' || e.pos, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, p.observed_at, p.object_path, p.payload_sha256,
         'quarantined', 'flight record is not an object', NULL, FALSE, e.pos
  FROM ev e JOIN payloads p ON e.b = p.b WHERE p.bfault = 'ok' AND e.fault = 'not_object'
  UNION ALL
  SELECT 'quarantine:' || payload_sha256 || ':0', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, observed_at, object_path, payload_sha256,
         'quarantined',
         CASE bfault WHEN 'not_array' THEN 'response data field is not an array'
                     ELSE 'response body is not valid JSON' END, NULL, FALSE, 0
  FROM payloads WHERE bfault <> 'ok')"""

PARSED = "WITH " + EVENTS_PAYLOAD + "\n"
PARSED_COLS = ", ".join([*OBS_COLS, "aircraft_type"])


# -- responses ---------------------------------------------------------------

RESPONSES = """
r0 AS (
  SELECT 'r' || event_id AS ingestion_id, event_id AS i, ts, user_id AS u, event_type AS t,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
r1 AS (
  SELECT *, CASE WHEN k % 10 = 0 THEN 0 WHEN t = 'error' AND k % 2 = 0 THEN 500
                 WHEN t = 'error' THEN 429 ELSE 200 END AS http_status,
         CASE WHEN i % 37 = 0 THEN 'a/b' WHEN i % 5 = 0 THEN '/flights/' ELSE 'flights' END AS raw_endpoint
  FROM r0),
r2 AS (
  SELECT *,
    CASE WHEN http_status = 0 THEN NULL WHEN http_status = 500 THEN 'oops'
         WHEN http_status = 429 THEN '{"error":{"code":"rate_limit"}}'
         WHEN k % 7 = 0 THEN 'not-json' WHEN k % 7 = 1 THEN '{"data":null}'
         WHEN k % 7 = 2 THEN '{"pagination":{}}' WHEN k % 7 = 3 THEN '{"data":{"a":1}}'
         WHEN k % 7 = 4 THEN '[1,2]'
         ELSE '{"data":[' || rtrim(repeat('{},', k % 4), ',') || ']}' END AS body,
    CASE WHEN http_status = 0 THEN 'request failed: timed out'
         WHEN http_status = 429 THEN 'HTTP 429: Too Many Requests' END AS transport_error
  FROM r1),
r3 AS (
  SELECT *,
    CASE WHEN body IS NOT NULL AND i % 17 = 3 THEN 'object storage failed: disk full' END AS storage_error,
    CASE WHEN body IS NULL THEN NULL
         WHEN body IN ('oops', 'not-json', '[1,2]') THEN 'response body is not valid JSON'
         WHEN http_status = 200 AND k % 7 = 3 THEN 'response data field is not an array' END AS payload_error,
    CASE WHEN http_status = 200 AND k % 7 >= 5 THEN k % 4 ELSE 0 END AS record_count,
    'bronze/source=flightapi/endpoint=' || trim(raw_endpoint, '/') || '/ingestion_date=' ||
      strftime(ts, '%Y-%m-%d') || '/' || ingestion_id || '.json' AS object_key,
    '{"dep_iata":"P' || (u % 9) || '","limit":"' || k || '"}' AS request_parameters,
    i % 3 = 0 OR i % 7 = 1 AS has_credentials
  FROM r2),
manifest AS (
  SELECT ingestion_id, 'flightapi' AS source_name, trim(raw_endpoint, '/') AS endpoint,
         request_parameters,
         CASE WHEN body IS NOT NULL AND storage_error IS NULL THEN 's3a://landing/' || object_key END
           AS object_path,
         ts AS ingested_at, http_status, sha256(body) AS payload_sha256,
         CAST(record_count AS INTEGER) AS record_count,
         COALESCE(NULLIF(concat_ws('; ', transport_error, storage_error, payload_error), ''),
                  CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN 'HTTP ' || http_status END)
           AS error_message,
         body
  FROM r3 WHERE raw_endpoint <> 'a/b')"""

_LOOKBACK = (f"http_status BETWEEN 200 AND 299 AND object_path IS NOT NULL AND ingested_at >= "
             f"TIMESTAMP '{LOOKBACK_AS_OF}' - INTERVAL {LOOKBACK_HOURS} HOUR")

_MCOLS = ("ingestion_id, source_name, endpoint, request_parameters, object_path, ingested_at, "
          "http_status, payload_sha256, record_count, error_message")


def _gold_tables() -> str:
    return (GOLD.rstrip() + "," + _airline_stage("silver", "airline_stage") + ","
            + _airport_stage("silver", "airport_stage") + ","
            + _empty_dim("airline_empty", "airline_iata", "airline_name", "airline") + ","
            + _empty_dim("airport_empty", "airport_iata", "airport_name", "airport") + f""",
airline_dim AS ({_scd_merge_sql("airline_empty", "airline_stage", "airline_iata", "airline_name", "airline")}),
airport_dim AS ({_scd_merge_sql("airport_empty", "airport_stage", "airport_iata", "airport_name", "airport")}),
airline_hist AS ({_history_sql("flight_obs", "airline_iata", "airline_name", "airline")})
""")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["delay_rate_by_airline"] = GOLD + _by_key("airline_hour", "airline_iata")
    q["delay_rate_by_airport"] = GOLD + _by_key("airport_hour", "airport_iata")
    q["hourly_delay_trend"] = GOLD + f"""
SELECT hour_start_at, CAST(SUM(total_flights) AS BIGINT) AS total_flights,
       CAST(SUM(delayed_flights) AS BIGINT) AS delayed_flights,
       CAST(SUM(delayed_flights) AS DOUBLE) / NULLIF(SUM(total_flights), 0) AS delay_rate,
       {_W} AS average_delay_minutes
FROM airline_hour GROUP BY hour_start_at ORDER BY hour_start_at ASC NULLS LAST"""
    q["total_flights"] = GOLD + "SELECT CAST(COALESCE(SUM(total_flights), 0) AS BIGINT) AS total_flights FROM airline_hour"
    q["delayed_flights"] = GOLD + "SELECT CAST(COALESCE(SUM(delayed_flights), 0) AS BIGINT) AS delayed_flights FROM airline_hour"
    q["overall_delay_rate"] = GOLD + """
SELECT COALESCE(CAST(SUM(delayed_flights) AS DOUBLE) / NULLIF(SUM(total_flights), 0), 0e0) AS delay_rate
FROM airline_hour"""
    q["weighted_average_delay"] = GOLD + f"SELECT COALESCE({_W}, 0e0) AS average_delay_minutes FROM airline_hour"
    q["delay_detail_top500"] = GOLD + f"""
SELECT flight_instance_key, flight_iata, airline_iata, airline_name, departure_airport_iata,
       departure_airport_name, arrival_airport_iata, arrival_airport_name, scheduled_departure_at,
       delay_minutes, is_delayed, observed_at
FROM silver WHERE quality_status = 'valid' AND delay_minutes IS NOT NULL
ORDER BY scheduled_departure_at DESC NULLS LAST, delay_minutes DESC NULLS LAST, flight_instance_key
LIMIT {DETAIL_ROWS}"""
    q["agg_airline_hour"] = GOLD + "SELECT * FROM airline_hour"
    q["rollup_refresh"] = GOLD + "SELECT * FROM airline_hour"
    q["gold_run"] = GOLD + "SELECT * FROM airline_hour"
    measures = "hour_start_at, total_flights, delayed_flights, delay_rate, average_delay_minutes"
    q["gold_run_recovered"] = GOLD + f"""
SELECT 'airline' AS dimension, airline_iata AS code, {measures} FROM airline_hour
UNION ALL SELECT 'airport', airport_iata, {measures} FROM airport_hour"""
    steps = [FLIGHT_OBS, _latest("flight_obs", "early", _EARLY), _latest("flight_obs", "silver")]
    for t, stage in (("airline", _airline_stage), ("airport", _airport_stage)):
        names = (f"{t}_iata", f"{t}_name", t)
        steps += [stage("early", f"{t}_first"), stage("silver", f"{t}_second"), _empty_dim(f"{t}_none", *names),
                  f"\n{t}_one AS ({_scd_merge_sql(f'{t}_none', f'{t}_first', *names)})",
                  f"\n{t}_two AS ({_scd_merge_sql(f'{t}_one', f'{t}_second', *names)})"]
    q["gold_dimensions"] = _with(*steps) + "UNION ALL ".join(
        f"SELECT '{t}' AS dimension, {t}_iata AS code, {t}_name AS label, {t}_sk AS sk, effective_from, effective_to, "
        f"is_current FROM {t}_two " for t in ("airline", "airport"))
    q["agg_airport_hour"] = GOLD + "SELECT * FROM airport_hour"
    q["latest_per_key"] = GOLD + "SELECT * FROM silver"
    as_of = _with(FLIGHT_OBS, _latest("flight_obs", "old", f"observed_at <= TIMESTAMP '{AS_OF}'"),
                  _latest("flight_obs", "silver"))
    q["state_as_of"] = as_of + "SELECT * FROM old"
    q["state_diff"] = as_of + """
SELECT COALESCE(o.flight_instance_key, n.flight_instance_key) AS flight_instance_key,
       CASE WHEN o.flight_instance_key IS NULL THEN 'added' WHEN n.flight_instance_key IS NULL THEN 'removed'
            ELSE 'changed' END AS diff,
       o.delay_minutes AS old_delay_minutes, o.airline_iata AS old_airline_iata,
       o.observed_at AS old_observed_at, n.delay_minutes AS new_delay_minutes,
       n.airline_iata AS new_airline_iata, n.observed_at AS new_observed_at
FROM old o FULL OUTER JOIN silver n ON o.flight_instance_key = n.flight_instance_key
WHERE o.flight_instance_key IS NULL OR n.flight_instance_key IS NULL
   OR o.delay_minutes IS DISTINCT FROM n.delay_minutes OR o.airline_iata IS DISTINCT FROM n.airline_iata
   OR o.observed_at IS DISTINCT FROM n.observed_at"""
    two = _with(FLIGHT_OBS, _latest("flight_obs", "late_stage", _LATE),
                _latest("flight_obs", "early_stage", _EARLY))
    q["upsert_two_batches"] = two + f"""
, first_state AS (SELECT * FROM late_stage)
{_upsert_latest_sql("first_state", "early_stage", OBS_COLS, ["observed_at", "payload_sha256", "source_file"], LABELS)}"""
    q["upsert_metrics"] = two + """
SELECT _change, COUNT(*) AS rows FROM (
  SELECT CASE WHEN e.flight_instance_key IS NULL THEN 'insert'
              WHEN l.flight_instance_key IS NULL THEN 'keep'
              WHEN l.observed_at > e.observed_at
                OR (l.observed_at = e.observed_at AND l.payload_sha256 > e.payload_sha256)
                OR (l.observed_at = e.observed_at AND l.payload_sha256 = e.payload_sha256
                    AND l.source_file > e.source_file) THEN 'update'
              ELSE 'keep' END AS _change
  FROM early_stage e FULL OUTER JOIN late_stage l ON e.flight_instance_key = l.flight_instance_key)
GROUP BY _change"""
    q["upsert_backfill"] = GOLD.rstrip() + """,
st AS (SELECT * FROM silver WHERE substr(flight_instance_key, 3, 1) < '8'),
t AS (SELECT * REPLACE (
        CASE WHEN substr(flight_instance_key, 1, 1) < '4' THEN NULL ELSE airline_name END AS airline_name,
        CASE WHEN substr(flight_instance_key, 2, 1) = 'a' THEN NULL ELSE departure_airport_name END
          AS departure_airport_name) FROM silver)
""" + _upsert_latest_sql("t", "st", OBS_COLS, ["observed_at", "payload_sha256", "source_file"], LABELS)
    incr = _with(FLIGHT_OBS, _latest("flight_obs", "before_state", f"observed_at < TIMESTAMP '{WINDOW_START}'"),
                 _latest("flight_obs", "window_stage", f"observed_at >= TIMESTAMP '{WINDOW_START}'"))
    newer = ("(s.observed_at > t.observed_at OR (s.observed_at = t.observed_at AND s.payload_sha256 > t.payload_sha256)"
             " OR (s.observed_at = t.observed_at AND s.payload_sha256 = t.payload_sha256 AND s.source_file > t.source_file)"
             " OR (s.observed_at = t.observed_at AND s.payload_sha256 = t.payload_sha256 AND s.source_file = t.source_file"
             " AND ((t.airline_name IS NULL AND s.airline_name IS NOT NULL)"
             " OR (t.departure_airport_name IS NULL AND s.departure_airport_name IS NOT NULL)"
             " OR (t.arrival_airport_name IS NULL AND s.arrival_airport_name IS NOT NULL))))")
    pick = ", ".join(f"CASE WHEN t.flight_instance_key IS NULL OR (s.flight_instance_key IS NOT NULL AND {newer}) "
                     f"THEN s.{c} ELSE t.{c} END AS {c}" for c in OBS_COLS)
    q["upsert_incremental"] = incr + f"""
SELECT {pick},
       CASE WHEN t.flight_instance_key IS NULL THEN 'insert'
            WHEN s.flight_instance_key IS NOT NULL AND {newer} THEN 'update' ELSE 'keep' END AS _change
FROM before_state t FULL OUTER JOIN window_stage s ON t.flight_instance_key = s.flight_instance_key"""
    q["partitioned_upsert"] = GOLD + "SELECT * FROM silver"
    q["partitioned_manifest"] = _with(FLIGHT_OBS, _latest("flight_obs", "silver")) + f"""
SELECT strftime(scheduled_departure_at, '%Y-%m') AS part,
       CAST(MAX(CASE WHEN observed_at >= TIMESTAMP '{WINDOW_START}' THEN 1 ELSE 0 END) AS INTEGER)
         AS data_version
FROM silver GROUP BY 1"""
    fact2 = _with(FLIGHT_OBS, _latest("flight_obs", "silver"),
                  _latest("flight_obs", "silver_early", _EARLY),
                  _fact("silver", "fact"), _fact("silver_early", "fact_early"))
    q["fact_upsert"] = fact2 + _upsert_latest_sql("fact_early", "fact", FACT_COLS,
                                                  ["observed_at", "source_file"])
    q["agg_upsert_changed"] = (fact2.rstrip() + ","
                               + _rollup("fact_early", "before_agg", "airline_iata", "airline_iata") + ","
                               + _rollup("fact", "after_agg", "airline_iata", "airline_iata") + "\n"
                               + _upsert_changed_sql("before_agg", "after_agg",
                                                     ["airline_iata", "hour_start_at"], False))
    recent = _with(FLIGHT_OBS, _latest("flight_obs", "silver"),
                   _latest("flight_obs", "silver_recent", f"observed_at >= TIMESTAMP '{RECENT}'"),
                   _fact("silver", "fact"), _fact("silver_recent", "fact_recent"),
                   _rollup("fact", "before_agg", "airline_iata", "airline_iata"),
                   _rollup("fact_recent", "after_agg", "airline_iata", "airline_iata"))
    q["agg_upsert_keep_missing"] = recent + _upsert_changed_sql(
        "before_agg", "after_agg", ["airline_iata", "hour_start_at"], True)
    evo = _with(FLIGHT_OBS, _latest("flight_obs", "silver_early", _EARLY),
                _latest("flight_obs", "late_stage", _LATE))
    q["schema_evolution_union"] = evo + """
, s0 AS (SELECT *, CAST(NULL AS VARCHAR) AS aircraft_type FROM silver_early),
s1 AS (SELECT *, 'a32' || (length(flight_iata) % 3) || 'n' AS aircraft_type FROM late_stage)
""" + _upsert_latest_sql("s0", "s1", [*OBS_COLS, "aircraft_type"],
                         ["observed_at", "payload_sha256", "source_file"], LABELS)
    q["scd2_history"] = _with(FLIGHT_OBS) + _history_sql("flight_obs", "airline_iata", "airline_name", "airline")
    q["scd2_merge_step"] = (_with(FLIGHT_OBS, _latest("flight_obs", "silver"),
                                  _airline_stage("silver", "stage"))
                            + f", dim AS ({_history_sql('(SELECT * FROM flight_obs WHERE ' + _EARLY + ')', 'airline_iata', 'airline_name', 'airline')})\n"
                            + _scd_merge_sql("dim", "stage", "airline_iata", "airline_name", "airline"))
    q["rollup_rows"] = GOLD + "SELECT * FROM airline_hour ORDER BY airline_iata, hour_start_at"
    roles = """
roles AS (
  SELECT departure_airport_iata AS airport_iata, departure_airport_name AS airport_name,
         observed_at, source_file, payload_sha256, quality_status FROM flight_obs
  UNION ALL
  SELECT arrival_airport_iata, arrival_airport_name, observed_at, source_file, payload_sha256,
         quality_status
  FROM flight_obs)"""
    q["dim_history"] = (_with(FLIGHT_OBS, roles)
                        + _history_sql("roles", "airport_iata", "airport_name", "airport")
                        .replace("ORDER BY source_file DESC, payload_sha256 DESC",
                                 "ORDER BY source_file DESC, payload_sha256 DESC, airport_name DESC")
                        + "\nORDER BY airport_iata, effective_from")
    q["scd2_two_role_stage"] = _with(FLIGHT_OBS, _latest("flight_obs", "silver"),
                                     _airport_stage("silver", "stage")) + "SELECT * FROM stage"
    q["quality_checks"] = _gold_tables() + """
SELECT 'fact has invalid delay' AS "check",
       COUNT(*) FILTER (WHERE flight_instance_key IS NULL OR delay_minutes < 0) AS violations FROM fact
UNION ALL
SELECT 'airport dimension has duplicate current keys', COUNT(*) FROM (
  SELECT airport_iata FROM airport_dim WHERE is_current GROUP BY airport_iata HAVING COUNT(*) > 1)
UNION ALL
SELECT 'airline dimension has duplicate current keys', COUNT(*) FROM (
  SELECT airline_iata FROM airline_hist WHERE is_current GROUP BY airline_iata HAVING COUNT(*) > 1)
UNION ALL
SELECT 'airport dimension has invalid date range',
       COUNT(*) FILTER (WHERE effective_to IS NOT NULL AND effective_to <= effective_from) FROM airport_dim
UNION ALL
SELECT 'airline dimension has invalid date range',
       COUNT(*) FILTER (WHERE effective_to IS NOT NULL AND effective_to <= effective_from) FROM airline_hist"""
    q["duplicate_observation_keys"] = _with(FLIGHT_OBS) + """
SELECT flight_instance_key, COUNT(*) AS rows FROM flight_obs GROUP BY flight_instance_key HAVING COUNT(*) > 1"""
    q["table_counts"] = _gold_tables() + """
SELECT 'observations' AS "table", COUNT(*) AS rows FROM flight_obs
UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'fact', COUNT(*) FROM fact
UNION ALL SELECT 'airline_dim', COUNT(*) FROM airline_dim
UNION ALL SELECT 'airport_dim', COUNT(*) FROM airport_dim
UNION ALL SELECT 'airline_hour', COUNT(*) FROM airline_hour
UNION ALL SELECT 'airport_hour', COUNT(*) FROM airport_hour"""
    q["version_list"] = f"""
SELECT 0 AS version, TIMESTAMP '{CUT}' AS committed_at
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}')
UNION ALL
SELECT 1, TIMESTAMP '2002-01-01 00:00:00'
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"""
    q["read_version"] = _with(FLIGHT_OBS, _latest("flight_obs", "silver_early", _EARLY)) + "SELECT * FROM silver_early"
    q["run_metrics"] = two + """
SELECT * FROM (
  SELECT 0 AS run, COUNT(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS deleted FROM early_stage
  UNION ALL
  SELECT 1, COUNT(*) FILTER (WHERE e.flight_instance_key IS NULL),
         COUNT(*) FILTER (WHERE (l.observed_at, l.payload_sha256, l.source_file)
                              > (e.observed_at, e.payload_sha256, e.source_file)), 0
  FROM late_stage l LEFT JOIN early_stage e ON e.flight_instance_key = l.flight_instance_key)
WHERE inserted + updated > 0"""

    q["parse_payloads"] = PARSED + f"SELECT {PARSED_COLS} FROM parsed"
    q["payload_silver"] = q["parse_payloads"]
    q["bronze_to_silver_run"] = PARSED.rstrip() + f""",
sent AS (
  SELECT p.*, y.payload_sha256 AS new_sha, y.b IS NOT NULL AS resent
  FROM parsed p LEFT JOIN (
    SELECT q.b, q.object_path, sha256(replace(CASE
             WHEN q.bfault = 'not_array' THEN '{{"data":{{"offset":' || (q.b * 4) || '}}}}'
             WHEN q.bfault = 'truncated' THEN left(x.full_text, length(x.full_text) - 2)
             ELSE x.full_text END, '"Airline ', '"Carrier ')) AS payload_sha256
    FROM payloads q JOIN bodies x USING (b) WHERE q.b % 5 = 0) y ON p.source_file = y.object_path),
logged AS (
  SELECT {PARSED_COLS} FROM parsed
  UNION ALL BY NAME
  SELECT {PARSED_COLS} FROM (
    SELECT * REPLACE (
      CASE WHEN quality_status = 'valid' THEN flight_instance_key
           ELSE 'quarantine:' || new_sha || ':' || pos END AS flight_instance_key,
      replace(airline_name, 'Airline ', 'Carrier ') AS airline_name,
      observed_at + INTERVAL 1 HOUR AS observed_at,
      replace(source_file, '/b', '/c') AS source_file, new_sha AS payload_sha256)
    FROM sent WHERE resent))
SELECT unnest(max_by(r, struct_pack(a := r.observed_at, b := r.payload_sha256, c := r.source_file)))
FROM (SELECT logged AS r FROM logged
      WHERE observed_at >= TIMESTAMP '{LOOKBACK_AS_OF}' - INTERVAL {RUN_HOURS} HOUR)
GROUP BY r.flight_instance_key"""
    q["quarantine_reasons"] = PARSED + """
SELECT quality_reason, COUNT(*) AS rows FROM parsed WHERE quality_status = 'quarantined' GROUP BY quality_reason"""
    q["explode_positions"] = PARSED + "SELECT payload_sha256, CAST(pos AS INTEGER) AS pos, quality_status FROM parsed"
    q["strict_timestamps"] = PARSED + """
SELECT flight_instance_key, scheduled_departure_at, actual_departure_at, scheduled_arrival_at,
       actual_arrival_at FROM parsed"""
    q["delay_parse"] = PARSED + "SELECT flight_instance_key, delay_minutes, is_delayed, quality_reason FROM parsed"
    q["instance_keys"] = PARSED + """
SELECT flight_instance_key, flight_iata, departure_airport_iata, scheduled_departure_at
FROM parsed WHERE quality_status = 'valid'"""
    q["additive_field"] = PARSED + """
SELECT saw, COUNT(*) AS files FROM (SELECT source_file, bool_or(_saw) AS saw FROM parsed GROUP BY source_file)
GROUP BY saw"""

    resp = "WITH " + RESPONSES + "\n"
    q["response_log_rules"] = resp + f"SELECT {_MCOLS} FROM manifest"
    q["param_redaction"] = resp + "SELECT ingestion_id, request_parameters, has_credentials FROM r3"
    q["object_keys"] = resp + """
SELECT ingestion_id, raw_endpoint <> 'a/b' AS valid_endpoint, object_key FROM r3"""
    q["credential_check"] = resp + """
SELECT ingestion_id, concat_ws('; ',
         CASE WHEN raw_endpoint = 'a/b' THEN 'endpoint must be a single relative path segment' END,
         CASE WHEN has_credentials THEN 'credentials must not be passed as request parameters' END) AS reason
FROM r3 WHERE raw_endpoint = 'a/b' OR has_credentials"""
    q["lookback_window"] = resp + f"SELECT object_path, ingested_at, payload_sha256 FROM manifest WHERE {_LOOKBACK}"
    q["log_payload_join"] = resp + f"""
SELECT object_path, ingested_at AS observed_at, payload_sha256, CAST(octet_length(encode(body)) AS INTEGER) AS body_bytes,
       sha256(body) = payload_sha256 AS checksum_ok
FROM manifest WHERE {_LOOKBACK}"""
    q["param_parse"] = """
WITH p AS (SELECT event_id AS request_id, user_id AS u, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT request_id, 'dep_iata' AS "key", 'Q' || (k % 9) AS "value",
       CASE WHEN k % 10 IN (3, 4) THEN 1 ELSE 0 END AS invalid_items FROM p
UNION ALL
SELECT request_id, 'limit', CAST(k AS VARCHAR), CASE WHEN k % 10 IN (3, 4) THEN 1 ELSE 0 END FROM p
UNION ALL
SELECT request_id, 'note', 'a=b' || k, 0 FROM p WHERE k % 10 NOT IN (3, 4)"""
    q["terminal_attempts"] = """
WITH att AS (
  SELECT event_id // 4 AS request_id, CAST(event_id % 4 + 1 AS INTEGER) AS attempt,
         CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 0 WHEN 'click' THEN 429 ELSE 200 END
           AS http_status
  FROM events WHERE event_id % 4 + 1 <= 3),
agg AS (
  SELECT request_id, min(attempt) FILTER (WHERE http_status > 0 AND http_status < 500) AS first_ok,
         max(attempt) AS last_attempt
  FROM att GROUP BY request_id)
SELECT a.request_id, COALESCE(first_ok, last_attempt) AS attempts, t.http_status,
       CAST(pow(2, COALESCE(first_ok, last_attempt) - 1) - 1 AS BIGINT) AS backoff_seconds
FROM agg a JOIN att t ON t.request_id = a.request_id AND t.attempt = COALESCE(first_ok, last_attempt)"""
    return q
