"""Pipeline composition: observations → silver state → gold tables.

Each step is a DataFrame function; ``merge_into_partitions`` and
``bronze_to_silver_run`` write to a partitioned state, and only what changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import hour_start
from ..operators import partitions, rollup, scd, state
from ..schemas import (ADDITIVE_FIELDS, DIGESTS, FACT_COLUMNS, FACT_ORDER, LABEL_COLUMNS, LABEL_FIELDS, OBSERVATION,
                       OBSERVATION_KEY, OBSERVATION_ORDER)
from ..sources import landing, payload


def silver(obs: DataFrame, whole: bool = False) -> DataFrame:
    """Current state from an observation log (newest wins per key).  Digests are shuffled as
    bytes; a log that comes packed gives a packed state, which merges use as it is.  ``whole``:
    all columns are read, so the rows are shuffled folded."""
    latest = state.latest_per_key(state.packed(obs, DIGESTS), OBSERVATION_KEY, OBSERVATION_ORDER, whole)
    return latest if dict(obs.dtypes)[OBSERVATION_KEY[0]] == "binary" else state.unpacked(latest, DIGESTS)


def merge_silver(current: DataFrame, stage: DataFrame, whole: bool = False, keep: bool = True) -> DataFrame:
    """One silver merge with label back-fill (tagged); both sides shuffled."""
    return state.upsert_latest(current, stage, OBSERVATION_KEY, OBSERVATION_ORDER,
                               backfill=LABEL_COLUMNS, whole=whole, keep=keep)


def merge_silver_incremental(current: DataFrame, stage: DataFrame, whole: bool = False) -> DataFrame:
    """Silver merge for a look-back window: the stage is written once, and the
    planner broadcasts it only when its real size allows."""
    return state.upsert_latest_sized(current, stage, OBSERVATION_KEY, OBSERVATION_ORDER,
                                     backfill=LABEL_COLUMNS, whole=whole)


def bronze_to_silver(current: DataFrame, payloads: DataFrame) -> DataFrame:
    """Parse a window of landed payloads and merge it into the silver state.

    The additive-field decision (a schema change) is taken before the merge
    by ``payload.saw_field_in`` (a substring pre-filter, then an exact check
    on the few candidate bodies).  Returns the tagged next state.
    """
    additive = [f.name for f in ADDITIVE_FIELDS]
    obs = payload.observations(payload.parse(payloads, additive))
    for f in ADDITIVE_FIELDS:
        saw = payload.saw_field_in(payloads, f.name)
        if not saw:
            obs = obs.drop(f.name)
    cur, stage = state.evolve(current, obs, [*LABEL_FIELDS, *ADDITIVE_FIELDS])
    return merge_silver_incremental(cur, stage)


def silver_partition(grain: str = "day", ts: str = "scheduled_departure_at") -> Column:
    """Partition of a silver row: its scheduled departure day (or month),
    which is part of the flight key, so every version of a key lands in one
    partition and new observations touch only recent ones.  Pick the grain
    so partitions hold at least a few hundred MB."""
    day = F.to_date(ts)
    return day if grain == "day" else F.date_format(day, "yyyy-MM")


def latest_stage(obs: DataFrame) -> DataFrame:
    """The window's latest row per key, written once."""
    return state.materialize(silver(obs, whole=True))


def merge_stage(base: str, stage: DataFrame, grain: str = "day") -> DataFrame | None:
    """Merge a written stage (``latest_stage``) into the partitioned state.

    Read only the state partitions its keys fall in; work out the changes; rewrite
    only the partitions that hold one.  Returns the written change set (``_change``,
    ``_part``), or None when nothing changed.
    """
    spark = stage.sparkSession
    part = partitions.part_value(silver_partition(grain), F.col(OBSERVATION_KEY[0]))
    parts = [r[0] for r in stage.select(part).distinct().collect()]
    before = partitions.read(spark, base, parts)
    # an empty relation to the planner: a first merge joins nothing
    known = before if before is not None else spark.createDataFrame([], OBSERVATION).limit(0)
    cur, st = state.evolve(known, stage, [*LABEL_FIELDS, *ADDITIVE_FIELDS])
    tagged = state.unpacked(state.stage_changes(state.packed(cur, DIGESTS), state.packed(st, DIGESTS), OBSERVATION_KEY,
                                                OBSERVATION_ORDER, backfill=LABEL_COLUMNS), DIGESTS)
    # a first merge changes every row of the stage, which is written already
    changes = (partitions.change_set(tagged, part) if before is not None
               else tagged.withColumn(partitions.PART, part))
    touched = partitions.write_changed(spark, base, before, changes, OBSERVATION_KEY, part)
    return changes if touched else None


def merge_into_partitions(base: str, obs: DataFrame, grain: str = "day") -> DataFrame | None:
    """Incremental silver merge of a window of observations into the partitioned state."""
    return merge_stage(base, latest_stage(obs), grain)


def state_of_keys(base: str, stage: DataFrame, grain: str = "day") -> DataFrame | None:
    """The state's rows for the keys of a written stage; only its partitions are read."""
    part = partitions.part_value(silver_partition(grain), F.col(OBSERVATION_KEY[0]))
    parts = [r[0] for r in stage.select(part).distinct().collect()]
    rows = partitions.read(stage.sparkSession, base, parts)
    return None if rows is None else rows.join(stage.select(*OBSERVATION_KEY), list(OBSERVATION_KEY), "left_semi")


def window_observations(payloads: DataFrame) -> DataFrame:
    """Observations of a window of bodies, with the additive fields that it holds."""
    additive = [f.name for f in ADDITIVE_FIELDS]
    obs = payload.observations(payload.parse(payloads, additive))
    return obs.drop(*(f for f in additive if not payload.saw_field_in(payloads, f)))


def merge_payloads_into(base: str, payloads: DataFrame) -> DataFrame | None:
    """Incremental bronze → silver: parse the window, take the additive-field
    decision, then ``merge_into_partitions``."""
    return merge_into_partitions(base, window_observations(payloads))


def bronze_to_silver_run(spark, log_path: str, store_path: str, base: str, as_of,
                         hours: int = 48) -> DataFrame:
    """One look-back run: log window → stored bodies of its dates → parse → merge
    into the partitioned state.  Returns one row of counts: files, rows parsed, keys
    staged, inserted, updated, and whether a column was added.

    Each body is parsed once: the parsed rows are written, the stage is reduced from
    them, and the counts are those of the written tables, so a task that runs again
    after an executor is lost counts once."""
    window = landing.select_window(landing.read_log(spark, log_path), as_of, hours)
    bodies = state.materialize(landing.attach_payloads(
        window, landing.read_log(spark, store_path)), "window-bodies")
    before = partitions.read(spark, base)
    parsed = state.materialize(window_observations(bodies), "window-parsed")
    stage = latest_stage(parsed)
    changes = merge_stage(base, stage)

    def count(df: DataFrame, name: str, what="*") -> DataFrame:
        return df.agg(F.count(what).alias(name))

    added = changes is not None and before is not None and any(
        f.name in changes.columns and f.name not in before.columns for f in ADDITIVE_FIELDS)
    tags = (spark.createDataFrame([], f"{state.CHANGE} string") if changes is None
            else changes.select(state.CHANGE))
    tallies = tags.agg(F.count_if(F.col(state.CHANGE) == state.INSERT).alias("inserted"),
                       F.count_if(F.col(state.CHANGE) == state.UPDATE).alias("updated"))
    staged = count(stage, "staged", OBSERVATION_KEY[0])
    return (count(bodies, "files").join(count(parsed, "parsed")).join(staged).join(tallies)  # one row each
            .withColumn("column_added", F.lit(added)))


def fact_stage(silver_state: DataFrame) -> DataFrame:
    return (silver_state.where((F.col("quality_status") == "valid") & F.col("delay_minutes").isNotNull())
            .select(*FACT_COLUMNS))


def merge_fact(fact: DataFrame, silver_state: DataFrame, order=FACT_ORDER) -> DataFrame:
    """Fact upsert from valid silver rows with a delay (tagged)."""
    # silver holds one row per key: there is nothing to reduce
    return state.upsert_latest(fact, fact_stage(silver_state), OBSERVATION_KEY, list(order),
                               stage_is_latest=True)


def airline_stage(silver_state: DataFrame) -> DataFrame:
    valid = silver_state.where(F.col("quality_status") == "valid")
    return scd.stage(valid, [("airline_iata", "airline_name")], "airline_iata", "airline_name")


def airport_stage(silver_state: DataFrame) -> DataFrame:
    valid = silver_state.where(F.col("quality_status") == "valid")
    return scd.stage(valid, [("departure_airport_iata", "departure_airport_name"),
                             ("arrival_airport_iata", "arrival_airport_name")],
                     "airport_iata", "airport_name")


def airline_rollup(fact: DataFrame) -> DataFrame:
    return rollup.hourly(fact, "airline_iata")


def airport_rollup(fact: DataFrame) -> DataFrame:
    return rollup.hourly(fact, "departure_airport_iata", "airport_iata")


@dataclass
class Gold:
    fact: DataFrame
    airline_dim: DataFrame
    airport_dim: DataFrame
    airline_hour: DataFrame
    airport_hour: DataFrame


def gold_from_silver(silver_state: DataFrame, previous: Gold | None = None,
                     keep_missing_groups: bool = False) -> Gold:
    """Gold tables from the current silver state (tags dropped).

    With ``previous`` the fact is upserted, dimensions take one SCD2 step
    and rollups are change-detecting upserts (``keep_missing_groups=True``
    keeps stale groups as the original dashboards do).
    """
    if previous is None:
        fact = fact_stage(silver_state)
        return Gold(fact,
                    scd.merge(_empty_dim(silver_state, "airline"), airline_stage(silver_state),
                              "airline_iata", "airline_name", "airline"),
                    scd.merge(_empty_dim(silver_state, "airport"), airport_stage(silver_state),
                              "airport_iata", "airport_name", "airport"),
                    airline_rollup(fact), airport_rollup(fact))
    fact = state.current(merge_fact(previous.fact, silver_state))
    return Gold(
        fact,
        scd.merge(previous.airline_dim, airline_stage(silver_state), "airline_iata", "airline_name", "airline"),
        scd.merge(previous.airport_dim, airport_stage(silver_state), "airport_iata", "airport_name", "airport"),
        state.current(state.upsert_changed(previous.airline_hour, airline_rollup(fact),
                                           ["airline_iata", "hour_start_at"], _MEASURES,
                                           keep_missing_groups)),
        state.current(state.upsert_changed(previous.airport_hour, airport_rollup(fact),
                                           ["airport_iata", "hour_start_at"], _MEASURES,
                                           keep_missing_groups)),
    )


_MEASURES = ["total_flights", "delayed_flights", "delay_rate", "average_delay_minutes"]


def gold_incremental(silver_state: DataFrame, previous: Gold,
                     keep_missing_groups: bool = False,
                     silver_changes: DataFrame | None = None, by_key: bool = False) -> Gold:
    """Gold from a new silver state and the previous gold, incrementally:
    the fact is upserted (tagged once, written once), dimensions take one
    SCD2 step, and rollups recompute only hours holding a changed fact row.

    With ``silver_changes`` (the rows the last silver merge inserted or
    updated, in a table of their own) the fact upsert reads only those:
    unchanged silver rows are already in the previous fact, so the result is
    the same, and the size-checked plan broadcasts a small change set instead
    of shuffling the fact.  With ``by_key`` the changes and the previous fact
    are bucketed by key: the upsert shuffles nothing, and who reads the fact
    joins them again, which moves less than a written fact."""
    if silver_changes is None:
        tagged = state.materialize(merge_fact(previous.fact, silver_state))
    else:
        tagged = state.upsert_latest_sized(
            previous.fact, fact_stage(state.current(silver_changes)), OBSERVATION_KEY, FACT_ORDER, written=True)
        tagged = tagged if by_key else state.materialize(tagged)
    # the hours of changed rows are all that both refreshes read of them, several times each
    changed = state.materialize(
        tagged.where(F.col(state.CHANGE) != F.lit(state.KEEP))
        .select(hour_start(F.col("scheduled_departure_at")).alias("scheduled_departure_at")).distinct(), "changed-hours")
    fact = state.current(tagged)
    return Gold(
        fact,
        scd.merge(previous.airline_dim, airline_stage(silver_state), "airline_iata", "airline_name", "airline"),
        scd.merge(previous.airport_dim, airport_stage(silver_state), "airport_iata", "airport_name", "airport"),
        state.current(rollup.refresh(previous.airline_hour, fact, changed, "airline_iata",
                                     keep_missing=keep_missing_groups)),
        state.current(rollup.refresh(previous.airport_hour, fact, changed, "departure_airport_iata",
                                     "airport_iata", keep_missing=keep_missing_groups)),
    )


def _empty_dim(like: DataFrame, table: str) -> DataFrame:
    from ..schemas import AIRLINE_DIM, AIRPORT_DIM
    schema = AIRLINE_DIM if table == "airline" else AIRPORT_DIM
    return like.sparkSession.createDataFrame([], schema)
