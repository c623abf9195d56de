"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole driver tables.

Fixed parameters of the registered scenarios (cut instants, as-of times)
live at the top of this module; the DuckDB oracle in ``oracle.py`` uses the
same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import unpack_digest
from ..operators import changelog, partitions, quality, scd, state
from ..schemas import (ADDITIVE_FIELDS, DIGESTS, FACT_ORDER, LABEL_COLUMNS, OBSERVATION_EVOLVED,
                       OBSERVATION_KEY, OBSERVATION_ORDER, ROLLUP_MEASURES)
from ..session import ensure_utc, scratch_path
from ..sources import bindings, landing, payload
from . import gold_store, pipeline, serve

# Fixed scenario parameters (shared with the oracle SQL).
CUT = "1998-01-01 00:00:00"          # early batch < CUT <= late batch
AS_OF = "1998-06-30 00:00:00"        # as-of read of the observation log
RECENT = "1997-01-01 00:00:00"       # stage of the keep-missing rollup upsert
WINDOW_START = "2001-09-01 00:00:00"  # a short look-back window merged incrementally
LOOKBACK_AS_OF = "2024-01-20 00:00:00"
LOOKBACK_HOURS = 48
RUN_HOURS = 24 * 366                 # a first run over the whole log; a second one takes LOOKBACK_HOURS
DETAIL_ROWS = 500


def _ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


def _obs(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return bindings.flight_obs(spark, sf)


def _packed(df: DataFrame) -> DataFrame:
    """Observations with their digests as bytes, for queries that merge after the first state."""
    return state.packed(df, DIGESTS)


def _text(df: DataFrame) -> DataFrame:
    return state.unpacked(df, DIGESTS)


def _silver(spark, sf):
    return pipeline.silver(_obs(spark, sf))


def _fact(spark, sf):
    return pipeline.fact_stage(_silver(spark, sf))


def _early(spark, sf):
    return _obs(spark, sf).where(F.col("observed_at") < F.lit(CUT).cast("timestamp_ntz"))


def _late(spark, sf):
    return _obs(spark, sf).where(F.col("observed_at") >= F.lit(CUT).cast("timestamp_ntz"))


# -- serving (O1–O8) and rollups (G1–G6) -------------------------------------

def delay_rate_by_airline(spark, sf):
    return serve.by_key(pipeline.airline_rollup(_fact(spark, sf)), "airline_iata")


def delay_rate_by_airport(spark, sf):
    return serve.by_key(pipeline.airport_rollup(_fact(spark, sf)), "airport_iata")


def hourly_delay_trend(spark, sf):
    return serve.trend(pipeline.airline_rollup(_fact(spark, sf)))


def total_flights(spark, sf):
    return serve.total_flights(pipeline.airline_rollup(_fact(spark, sf)))


def delayed_flights(spark, sf):
    return serve.delayed_flights(pipeline.airline_rollup(_fact(spark, sf)))


def overall_delay_rate(spark, sf):
    return serve.overall_rate(pipeline.airline_rollup(_fact(spark, sf)))


def weighted_average_delay(spark, sf):
    return serve.weighted_average(pipeline.airline_rollup(_fact(spark, sf)))


def delay_detail_top500(spark, sf):
    return serve.detail(_silver(spark, sf), DETAIL_ROWS)


def agg_airline_hour(spark, sf):
    return pipeline.airline_rollup(_fact(spark, sf))


def agg_airport_hour(spark, sf):
    return pipeline.airport_rollup(_fact(spark, sf))


# -- state (F1–F6, F12, F13, O11) --------------------------------------------

def latest_per_key(spark, sf):
    return _silver(spark, sf)


def state_as_of(spark, sf):
    return _text(state.as_of(_packed(_obs(spark, sf)), _ts(AS_OF), OBSERVATION_KEY, OBSERVATION_ORDER))


def state_diff(spark, sf):
    old = state.as_of(_obs(spark, sf), _ts(AS_OF), OBSERVATION_KEY, OBSERVATION_ORDER)
    return state.diff(old, _silver(spark, sf), OBSERVATION_KEY,
                      ["delay_minutes", "airline_iata", "observed_at"])


def upsert_two_batches(spark, sf):
    """Late batch first, then the early batch: older arrivals are ignored."""
    empty = _packed(_obs(spark, sf)).limit(0)
    first = state.current(pipeline.merge_silver(empty, _packed(_late(spark, sf)), whole=True))
    return _text(state.current(pipeline.merge_silver(first, _packed(_early(spark, sf)), whole=True)))


def upsert_metrics(spark, sf):
    tagged = pipeline.merge_silver(pipeline.silver(_packed(_early(spark, sf))), _packed(_late(spark, sf)))
    return state.merge_metrics(tagged)


def _nulled_labels(df: DataFrame, k: Column) -> DataFrame:
    return (df.withColumn("airline_name", F.when(F.substring(k, 1, 1) < "4", None)
                          .otherwise(F.col("airline_name")))
            .withColumn("departure_airport_name", F.when(F.substring(k, 2, 1) == "a", None)
                        .otherwise(F.col("departure_airport_name"))))


def upsert_backfill(spark, sf):
    # the stage's rows are told by a column of their own that is folded with the other texts: both
    # sides of the merge then read one shuffle of the log (a filter on the key would be pushed below it)
    staged = F.when(F.substring("flight_instance_key", 3, 1) < "8", "y").otherwise("n")
    silver = pipeline.silver(_packed(_obs(spark, sf).withColumn("_staged", staged)), whole=True)
    known = _nulled_labels(silver, unpack_digest(F.col("flight_instance_key"))).drop("_staged")
    stage = silver.where(F.col("_staged") == "y").drop("_staged")
    return _text(state.current(pipeline.merge_silver(known, stage)))


def upsert_incremental(spark, sf):
    """A short look-back window merged into the state built from everything
    before it: the size-checked plan broadcasts the window (tags kept)."""
    start = F.lit(WINDOW_START).cast("timestamp_ntz")
    obs = _packed(_obs(spark, sf))
    before = pipeline.silver(obs.where(F.col("observed_at") < start), whole=True)
    return _text(pipeline.merge_silver_incremental(before, obs.where(F.col("observed_at") >= start), whole=True))


def _partitioned(spark, sf):
    """State before the window published as date partitions, then the window
    merged in: only partitions holding window keys are read and rewritten."""
    base = scratch_path(spark, "silver_parts")
    start = F.lit(WINDOW_START).cast("timestamp_ntz")
    pipeline.merge_into_partitions(base, _obs(spark, sf).where(F.col("observed_at") < start),
                                   grain="month")
    changes = pipeline.merge_into_partitions(
        base, _obs(spark, sf).where(F.col("observed_at") >= start), grain="month")
    return base, changes


def partitioned_upsert(spark, sf):
    return partitions.read(spark, _partitioned(spark, sf)[0])


def partitioned_manifest(spark, sf):
    """Which of the two merges last wrote each month partition."""
    base, changes = _partitioned(spark, sf)
    months = spark.read.parquet(base).select(F.col("_part").cast("string").alias("part")).distinct()
    if changes is None:
        return months.withColumn("data_version", F.lit(0))
    second = changes.select(F.col("_part").alias("part"), F.lit(1).alias("_by")).distinct()
    return months.join(second, "part", "left").select(
        "part", F.coalesce("_by", F.lit(0)).alias("data_version"))


def fact_upsert(spark, sf):
    fact0 = pipeline.fact_stage(pipeline.silver(_packed(_early(spark, sf))))
    full = pipeline.silver(_packed(_obs(spark, sf)))
    return _text(state.current(pipeline.merge_fact(fact0, full, FACT_ORDER)))


def agg_upsert_changed(spark, sf):
    """Contract behaviour: groups no longer produced by the fact are dropped."""
    before = pipeline.airline_rollup(pipeline.fact_stage(pipeline.silver(_early(spark, sf))))
    after = pipeline.airline_rollup(_fact(spark, sf))
    return state.upsert_changed(before, after, ["airline_iata", "hour_start_at"],
                                ROLLUP_MEASURES, keep_missing=False)


def agg_upsert_keep_missing(spark, sf):
    """Dashboard behaviour: groups missing from the stage are kept."""
    before = pipeline.airline_rollup(_fact(spark, sf))
    recent = _obs(spark, sf).where(F.col("observed_at") >= F.lit(RECENT).cast("timestamp_ntz"))
    after = pipeline.airline_rollup(pipeline.fact_stage(pipeline.silver(recent)))
    return state.upsert_changed(before, after, ["airline_iata", "hour_start_at"],
                                ROLLUP_MEASURES, keep_missing=True)


def rollup_refresh(spark, sf):
    """Gold built from the early state, then refreshed incrementally with the
    full state: only hours holding a changed fact row are recomputed."""
    # what gold takes from silver and the rest of the merge's order, bucketed by key for both upserts
    columns = [*gold_store.SOURCE_COLUMNS, "payload_sha256"]
    early = state.materialize_by_key(pipeline.silver(_packed(_early(spark, sf))).select(*columns), OBSERVATION_KEY)
    previous = pipeline.gold_from_silver(early)
    step = pipeline.merge_silver(early, _packed(_late(spark, sf)))
    changes = state.materialize_by_key(
        step.where(F.col(state.CHANGE) != F.lit(state.KEEP)).select(*gold_store.SOURCE_COLUMNS, state.CHANGE),
        OBSERVATION_KEY)
    return pipeline.gold_incremental(state.current(step), previous,
                                     silver_changes=changes, by_key=True).airline_hour


def gold_run(spark, sf):
    """Two stored gold runs (early state, then the full state); the airline rollup."""
    base = scratch_path(spark, "gold")
    gold_store.run(pipeline.silver(_early(spark, sf)), base, grain="month")
    gold_store.run(_silver(spark, sf), base, grain="month")
    return gold_store.read(spark, base, "airline_hour")


def gold_run_recovered(spark, sf):
    """A stored run, a second one that ends after its fact was published, and a third
    that finds nothing new but has to finish the second: both rollups."""
    base = scratch_path(spark, "gold")
    gold_store.run(pipeline.silver(_early(spark, sf)), base, grain="month")
    full = state.materialize(_silver(spark, sf).select(*gold_store.SOURCE_COLUMNS))
    folder, tables, inserted, updated, _ = gold_store.stage_run(full, base, grain="month")
    if tables:
        gold_store.commit(spark, base, folder, tables, inserted, updated)
    if "fact" in tables:
        gold_store.publish_table(spark, base, folder, "fact")
    gold_store.run(full, base, grain="month")
    return _both(lambda t: gold_store.read(spark, base, f"{t}_hour"), "hour_start_at", *ROLLUP_MEASURES)


def _both(table, *columns) -> DataFrame:
    """The airline's and the airport's table under each other."""
    return reduce(DataFrame.unionByName, [table(t).select(
        F.lit(t).alias("dimension"), F.col(f"{t}_iata").alias("code"), *columns) for t in ("airline", "airport")])


def gold_dimensions(spark, sf):
    """Both stored dimensions after a run on the early and one on the full state."""
    base = scratch_path(spark, "gold")
    gold_store.run(pipeline.silver(_early(spark, sf)), base, grain="month")
    gold_store.run(_silver(spark, sf), base, grain="month")

    def table(t):
        return gold_store.read(spark, base, f"{t}_dim").withColumnsRenamed({f"{t}_sk": "sk", f"{t}_name": "label"})

    return _both(table, "label", "sk", "effective_from", "effective_to", "is_current")


def schema_evolution_union(spark, sf):
    """Stage carries the additive field; the state gains it (old rows NULL)."""
    old = pipeline.silver(_packed(_early(spark, sf)), whole=True)
    stage = _packed(_late(spark, sf)).withColumn(
        "aircraft_type", F.concat(F.lit("a32"), F.length("flight_iata") % 3, F.lit("n")))
    s0, s1 = state.evolve(old, stage, ADDITIVE_FIELDS)
    return _text(state.current(pipeline.merge_silver(s0, s1, whole=True)))


# -- SCD2 (F7–F11, J1) -------------------------------------------------------

def scd2_history(spark, sf):
    return scd.history(_obs(spark, sf), "airline_iata", "airline_name", "airline",
                       tiebreak=("source_file", "payload_sha256"))


def scd2_merge_step(spark, sf):
    dim = scd.history(_early(spark, sf), "airline_iata", "airline_name", "airline",
                      tiebreak=("source_file", "payload_sha256"))
    return scd.merge(dim, pipeline.airline_stage(_silver(spark, sf)),
                     "airline_iata", "airline_name", "airline")


def scd2_two_role_stage(spark, sf):
    return pipeline.airport_stage(_silver(spark, sf))


def rollup_rows(spark, sf):
    """Hourly airline rollup rows ordered by airline and hour (O9)."""
    return serve.rollup_rows(pipeline.airline_rollup(_fact(spark, sf)), "airline_iata")


def dim_history(spark, sf):
    """Airport dimension history ordered by code and start (O10): SCD2 over
    both airport roles of the observation log."""
    obs = _obs(spark, sf)
    roles = obs.select(F.inline(F.array(
        F.struct(F.col("departure_airport_iata").alias("airport_iata"),
                 F.col("departure_airport_name").alias("airport_name"),
                 "observed_at", "source_file", "payload_sha256", "quality_status"),
        F.struct(F.col("arrival_airport_iata").alias("airport_iata"),
                 F.col("arrival_airport_name").alias("airport_name"),
                 "observed_at", "source_file", "payload_sha256", "quality_status"))))
    hist = scd.history(roles, "airport_iata", "airport_name", "airport",
                       tiebreak=("source_file", "payload_sha256", "airport_name"))
    return serve.dim_history(hist, "airport_iata")


# -- quality (N1–N6, G7, A17) ------------------------------------------------

def _gold_source(spark, sf) -> DataFrame:
    """What gold takes from silver, digests packed."""
    return pipeline.silver(_packed(_obs(spark, sf))).select(*gold_store.SOURCE_COLUMNS)


def _gold(spark, sf, silver=None) -> pipeline.Gold:
    return pipeline.gold_from_silver(silver if silver is not None else _silver(spark, sf))


def quality_checks(spark, sf):
    g = _gold(spark, sf, state.materialize(_gold_source(spark, sf)))
    airline_dim = scd.history(_obs(spark, sf), "airline_iata", "airline_name", "airline",
                              tiebreak=("source_file", "payload_sha256"))
    return quality.union_checks(quality.fact_check(g.fact),
                                quality.dimension_checks(g.airport_dim, "airport", "airport_iata"),
                                quality.dimension_checks(airline_dim, "airline", "airline_iata"))


def duplicate_observation_keys(spark, sf):
    return quality.duplicate_keys(_obs(spark, sf), "flight_instance_key")


def table_counts(spark, sf):
    silver = state.materialize(_gold_source(spark, sf))
    g = _gold(spark, sf, silver)  # the fact is a filter of the written silver rows
    return quality.table_counts({
        "observations": _obs(spark, sf), "silver": silver, "fact": g.fact,
        "airline_dim": g.airline_dim, "airport_dim": g.airport_dim,
        "airline_hour": g.airline_hour, "airport_hour": g.airport_hour})


# -- runs by replay of the change log (A15, A16, I5) --------------------------

def _replayed(spark, sf) -> str:
    """Change log of two silver merges: the early batch, then the late batch.  Its digests are bytes and its
    runs lie in buckets of the flight key: the second merge shuffles nothing of the first run."""
    base = scratch_path(spark, "silver_changes")
    near = ["scheduled_departure_at"]
    changelog.append(pipeline.silver(_packed(_early(spark, sf)), whole=True), base, _ts(CUT), OBSERVATION_KEY, near)
    before = (changelog.at_run(spark, base, OBSERVATION_KEY) if changelog.latest_run(spark, base) is not None
              else _packed(_early(spark, sf)).limit(0))
    # the log takes changed rows alone
    merged = pipeline.merge_silver(before, _packed(_late(spark, sf)), whole=True, keep=False)
    changelog.append(merged, base, _ts("2002-01-01 00:00:00"), OBSERVATION_KEY, near)
    return base


def version_list(spark, sf):
    return changelog.runs(spark, _replayed(spark, sf)).select(F.col("run").alias("version"), "committed_at")


def read_version(spark, sf):
    return _text(changelog.at_run(spark, _replayed(spark, sf), OBSERVATION_KEY, 0, whole=True))


def run_metrics(spark, sf):
    """What each run of the change log inserted and updated (A17)."""
    return changelog.runs(spark, _replayed(spark, sf)).select("run", "inserted", "updated", "deleted")


# -- payload parsing (C1–C16) ------------------------------------------------

def _parsed(spark, sf, keep_pos=False):
    ensure_utc(spark)
    return payload.parse(bindings.payload_log(spark, sf), keep_pos=keep_pos)


def parse_payloads(spark, sf):
    return payload.observations(_parsed(spark, sf))


def quarantine_reasons(spark, sf):
    return (_parsed(spark, sf).where(F.col("quality_status") == "quarantined")
            .groupBy("quality_reason").agg(F.count(F.lit(1)).alias("rows")))


def explode_positions(spark, sf):
    return _parsed(spark, sf, keep_pos=True).select("payload_sha256", "pos", "quality_status")


def strict_timestamps(spark, sf):
    return _parsed(spark, sf).select(
        "flight_instance_key", "scheduled_departure_at", "actual_departure_at",
        "scheduled_arrival_at", "actual_arrival_at")


def delay_parse(spark, sf):
    return _parsed(spark, sf).select("flight_instance_key", "delay_minutes", "is_delayed",
                                     "quality_reason")


def instance_keys(spark, sf):
    return _parsed(spark, sf).where(F.col("quality_status") == "valid").select(
        "flight_instance_key", "flight_iata", "departure_airport_iata", "scheduled_departure_at")


def additive_field(spark, sf):
    parsed = _parsed(spark, sf)
    per_file = parsed.groupBy("source_file").agg(F.bool_or("_saw_aircraft_type").alias("saw"))
    return per_file.groupBy("saw").agg(F.count(F.lit(1)).alias("files"))


def payload_silver(spark, sf):
    """Parsed payloads merged into current state (evolved when the field is seen)."""
    parsed = _parsed(spark, sf)
    return pipeline.silver(payload.observations(parsed))


def _resent(bodies: DataFrame) -> DataFrame:
    """Every body, and every fifth once more an hour later with other airline names."""
    again = (bodies.where(F.regexp_extract("object_path", r"/b(\d+)\.json$", 1).cast("long") % 5 == 0)
             .select(F.regexp_replace("object_path", "/b", "/c").alias("object_path"),
                     (F.col("observed_at") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("observed_at"),
                     F.encode(F.replace(F.col("body").cast("string"), F.lit('"Airline '),
                                        F.lit('"Carrier ')), "UTF-8").alias("body")))
    return bodies.select("object_path", "observed_at", "body").unionByName(again)


def bronze_to_silver_run(spark, sf):
    """Landed log and body store, then two look-back runs into a partitioned state."""
    ensure_utc(spark)
    log, store, base = (scratch_path(spark, n) for n in ("run-log", "run-store", "run-silver"))
    landed = _resent(bindings.payload_log(spark, sf)).withColumn("ingestion_date", F.to_date("observed_at"))
    # bodies first, laid out by date; their log rows come from the store and need no shuffle
    (landed.select(F.col("object_path").alias("path"), F.col("body").alias("content"),
                   F.col("observed_at").alias("ingested_at"), "ingestion_date")
     .hint("rebalance", "ingestion_date").write.option("compression", state.COMPRESSION)
     .partitionBy("ingestion_date").parquet(store))
    (landing.read_log(spark, store)
     .select(F.col("path").alias("object_path"), "ingested_at",
             F.sha2("content", 256).alias("payload_sha256"), F.lit(200).alias("http_status"),
             "ingestion_date")
     .write.option("compression", state.COMPRESSION).partitionBy("ingestion_date").parquet(log))
    pipeline.bronze_to_silver_run(spark, log, store, base, _ts(LOOKBACK_AS_OF), RUN_HOURS)
    pipeline.bronze_to_silver_run(spark, log, store, base, _ts(LOOKBACK_AS_OF), LOOKBACK_HOURS)
    silver = partitions.read(spark, base)
    return spark.createDataFrame([], OBSERVATION_EVOLVED) if silver is None else silver


# -- landing (A1–A7, B1–B9, D1–D3) -------------------------------------------

def _responses(spark, sf):
    ensure_utc(spark)
    return bindings.response_log(spark, sf)


def _log(spark, sf):
    return landing.land_responses(_responses(spark, sf), bindings.SOURCE, bindings.BUCKET)


def response_log_rules(spark, sf):
    return _log(spark, sf)


def param_redaction(spark, sf):
    r = _responses(spark, sf)
    return r.select("ingestion_id", landing.redact_params(F.col("params")).alias("request_parameters"),
                    landing.has_credentials(F.col("params")).alias("has_credentials"))


def param_parse(spark, sf):
    p = bindings.param_lists(spark, sf).select(
        "request_id", landing.parse_params(F.col("items")).alias("p"))
    return p.select("request_id", F.explode_outer(F.col("p.params")).alias("key", "value"),
                    F.size("p.invalid").alias("invalid_items"))


def object_keys(spark, sf):
    r = _responses(spark, sf)
    return r.select("ingestion_id", landing.valid_endpoint(F.col("endpoint")).alias("valid_endpoint"),
                    landing.object_key(bindings.SOURCE, F.col("endpoint"), F.col("ingested_at"),
                                       F.col("ingestion_id")).alias("object_key"))


def credential_check(spark, sf):
    return landing.rejected_requests(_responses(spark, sf))


def lookback_window(spark, sf):
    return landing.select_window(_log(spark, sf), _ts(LOOKBACK_AS_OF), LOOKBACK_HOURS)


def log_payload_join(spark, sf):
    """Log window ⋈ payload store on the object path."""
    r = _responses(spark, sf)
    store = r.where(F.col("body").isNotNull()).select(
        F.concat(F.lit(f"s3a://{bindings.BUCKET}/"),
                 landing.object_key(bindings.SOURCE, F.col("endpoint"), F.col("ingested_at"),
                                    F.col("ingestion_id"))).alias("path"),
        F.col("body").alias("content"))
    window = landing.select_window(_log(spark, sf), _ts(LOOKBACK_AS_OF), LOOKBACK_HOURS)
    joined = landing.attach_payloads(window, store)
    return joined.select("object_path", "observed_at", "payload_sha256",
                         F.length("body").alias("body_bytes"),
                         (F.sha2("body", 256) == F.col("payload_sha256")).alias("checksum_ok"))


def terminal_attempts(spark, sf):
    return landing.terminal_attempt(bindings.attempt_log(spark, sf), max_attempts=3)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "delay_rate_by_airline": delay_rate_by_airline,
    "delay_rate_by_airport": delay_rate_by_airport,
    "hourly_delay_trend": hourly_delay_trend,
    "total_flights": total_flights,
    "delayed_flights": delayed_flights,
    "overall_delay_rate": overall_delay_rate,
    "weighted_average_delay": weighted_average_delay,
    "delay_detail_top500": delay_detail_top500,
    "agg_airline_hour": agg_airline_hour,
    "agg_airport_hour": agg_airport_hour,
    "latest_per_key": latest_per_key,
    "state_as_of": state_as_of,
    "state_diff": state_diff,
    "upsert_two_batches": upsert_two_batches,
    "upsert_metrics": upsert_metrics,
    "upsert_backfill": upsert_backfill,
    "upsert_incremental": upsert_incremental,
    "partitioned_upsert": partitioned_upsert,
    "partitioned_manifest": partitioned_manifest,
    "fact_upsert": fact_upsert,
    "agg_upsert_changed": agg_upsert_changed,
    "agg_upsert_keep_missing": agg_upsert_keep_missing,
    "rollup_refresh": rollup_refresh,
    "gold_run": gold_run,
    "gold_run_recovered": gold_run_recovered,
    "gold_dimensions": gold_dimensions,
    "schema_evolution_union": schema_evolution_union,
    "scd2_history": scd2_history,
    "scd2_merge_step": scd2_merge_step,
    "scd2_two_role_stage": scd2_two_role_stage,
    "rollup_rows": rollup_rows,
    "dim_history": dim_history,
    "quality_checks": quality_checks,
    "duplicate_observation_keys": duplicate_observation_keys,
    "table_counts": table_counts,
    "version_list": version_list,
    "read_version": read_version,
    "run_metrics": run_metrics,
    "parse_payloads": parse_payloads,
    "quarantine_reasons": quarantine_reasons,
    "explode_positions": explode_positions,
    "strict_timestamps": strict_timestamps,
    "delay_parse": delay_parse,
    "instance_keys": instance_keys,
    "additive_field": additive_field,
    "payload_silver": payload_silver,
    "bronze_to_silver_run": bronze_to_silver_run,
    "response_log_rules": response_log_rules,
    "param_redaction": param_redaction,
    "param_parse": param_parse,
    "object_keys": object_keys,
    "credential_check": credential_check,
    "lookback_window": lookback_window,
    "log_payload_join": log_payload_join,
    "terminal_attempts": terminal_attempts,
}
