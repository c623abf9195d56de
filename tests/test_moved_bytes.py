"""What the large queries shuffle and write: merges of tables bucketed by key, narrow silver
copies, logs that are read once."""

import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsengine.operators import partitions, quality, scd, state
from obsengine.plans import gold_store, pipeline, queries
from obsengine.schemas import DIGESTS, FACT_ORDER, LABEL_COLUMNS, OBSERVATION, OBSERVATION_COLUMNS, OBSERVATION_KEY
from obsengine.session import shared_dir
from obsengine.sources import bindings, payload

T0 = datetime(2026, 8, 22, 6)


def _obs(spark, rows):
    """rows: (key, hours, sha, airline, delay)"""
    values = []
    for key, hours, sha, airline, delay in rows:
        r = dict.fromkeys(OBSERVATION_COLUMNS) | {
            "flight_instance_key": key, "airline_iata": airline, "airline_name": airline, "departure_airport_iata": "P",
            "scheduled_departure_at": T0 + timedelta(hours=len(key or "") % 3), "delay_minutes": delay,
            "is_delayed": delay is not None and delay > 15, "observed_at": T0 + timedelta(hours=hours), "source_file": "f",
            "payload_sha256": sha, "quality_status": "valid"}
        values.append(tuple(r[c] for c in OBSERVATION_COLUMNS))
    schema = type(OBSERVATION)([type(f)(f.name, f.dataType, True) for f in OBSERVATION.fields])
    return spark.createDataFrame(values, schema)


EARLY = [("k1", 0, "a", "A", 5), ("k1", 1, "b", "A", 20), ("k2", 0, "a", "B", None), ("k33", 0, "a", "B", 7),
         ("k444", 2, "c", None, 9), (None, 0, "a", "A", 3)]
LATE = [("k1", 2, "c", "B", 30), ("k1", 2, "c", "B", 30), ("k2", 1, "d", "B", 4), ("k33", 0, "0", "C", 50),
        ("k5", 3, "e", "C", 16), (None, 2, "b", "C", 8)]


def _folders(spark, name):
    return set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/obsengine/{name}-*"))


def _columns(spark, folders):
    """Columns of the written tables, partitions aside."""
    return [spark.read.parquet(f).columns for f in sorted(folders)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_a_table_by_key_is_merged_without_a_shuffle(spark, no_broadcast):
    tables = {t.name for t in spark.catalog.listTables()}
    before = state.packed(_obs(spark, EARLY), DIGESTS)
    held = state.materialize_by_key(pipeline.silver(before), OBSERVATION_KEY)
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert _rows(held) == _rows(pipeline.silver(before))
    late = state.packed(_obs(spark, LATE), DIGESTS)
    merged = pipeline.merge_silver(held, late)
    assert _plan(merged).count("Exchange hashpartitioning") == 1  # the late batch
    assert _rows(merged) == _rows(pipeline.merge_silver(state.materialize(pipeline.silver(before)), late))


def test_gold_by_key_equals_gold_of_whole_tables(spark, no_broadcast):
    early, late = (state.packed(_obs(spark, rows), DIGESTS) for rows in (EARLY, LATE))
    held = state.materialize_by_key(pipeline.silver(early), OBSERVATION_KEY)
    step = pipeline.merge_silver(held, late)
    changes = state.materialize_by_key(step.where(F.col(state.CHANGE) != state.KEEP), OBSERVATION_KEY)
    before = _folders(spark, "materialized")
    narrow = pipeline.gold_incremental(state.current(step), pipeline.gold_from_silver(held), silver_changes=changes, by_key=True)
    assert _folders(spark, "materialized") == before  # neither the stage nor the fact is written again
    assert "Exchange hashpartitioning" not in _plan(narrow.fact)
    whole = state.upsert_latest(pipeline.gold_from_silver(held).fact, pipeline.fact_stage(state.current(changes)),
                                OBSERVATION_KEY, FACT_ORDER)
    assert _rows(narrow.fact) == _rows(state.current(whole))
    rebuilt = pipeline.gold_from_silver(state.current(whole).withColumn("quality_status", F.lit("valid"))
                                        .withColumns({c: F.lit("") for c in LABEL_COLUMNS}))
    for table in ("airline_hour", "airport_hour"):
        assert _rows(getattr(narrow, table)) == _rows(getattr(rebuilt, table))


def test_small_changes_by_key_give_the_same_gold(spark):
    early, late = (state.packed(_obs(spark, rows), DIGESTS) for rows in (EARLY, LATE))
    held = state.materialize_by_key(pipeline.silver(early), OBSERVATION_KEY)
    step = state.materialize(pipeline.merge_silver(held, late))
    changes = state.materialize_by_key(step.where(F.col(state.CHANGE) != state.KEEP), OBSERVATION_KEY)
    narrow = pipeline.gold_incremental(state.current(step), pipeline.gold_from_silver(held), silver_changes=changes, by_key=True)
    whole = pipeline.gold_incremental(state.current(step), pipeline.gold_from_silver(held), silver_changes=changes)
    for table in ("fact", "airline_dim", "airport_dim", "airline_hour", "airport_hour"):
        assert _rows(getattr(narrow, table)) == _rows(getattr(whole, table))


def test_table_counts_writes_one_narrow_copy(spark, monkeypatch):
    monkeypatch.setattr(queries, "_obs", lambda *_: _obs(spark, EARLY + LATE))
    before = _folders(spark, "materialized")
    counts = {r["table"]: r["rows"] for r in queries.table_counts(spark, "").collect()}
    (copy,) = _columns(spark, _folders(spark, "materialized") - before)
    assert set(copy) == set(gold_store.SOURCE_COLUMNS)
    # k444 has no airline; the null key is one row
    assert counts == {"observations": 12, "silver": 6, "fact": 6, "airline_dim": 2, "airport_dim": 1, "airline_hour": 4,
                      "airport_hour": 3}


def test_quality_checks_write_one_narrow_copy(spark, monkeypatch):
    rows = [*EARLY, *LATE, ("k6", 0, "a", "A", -4), ("k7", 0, "a", "A", -4), ("k7", 1, "b", "A", 4)]
    monkeypatch.setattr(queries, "_obs", lambda *_: _obs(spark, rows))
    before = _folders(spark, "materialized")
    found = {r["check"]: r["violations"] for r in queries.quality_checks(spark, "").collect()}
    (copy,) = _columns(spark, _folders(spark, "materialized") - before)
    assert set(copy) == set(gold_store.SOURCE_COLUMNS)
    assert found.pop(quality.FACT_CHECK) == 2  # the row without a key and the negative delay
    assert len(found) == 4 and not any(found.values())


def test_history_reads_the_log_once(spark, tmp_path, no_broadcast):
    rows = _obs(spark, [("k", h, "a", a, 1) for h, a in ((0, "A"), (1, "A"), (50, "A"), (0, "B"), (30, "B"))])
    named = rows.withColumn("airline_name", F.concat("airline_iata", F.date_format("observed_at", "dd")))
    no_time = named.limit(2).withColumn("observed_at", F.lit(None).cast("timestamp_ntz"))
    named.unionByName(no_time).coalesce(1).write.parquet(str(tmp_path / "log"))
    dim = scd.history(spark.read.parquet(str(tmp_path / "log")), "airline_iata", "airline_name", "airline")
    rows = dim.select("airline_iata", "airline_name", "effective_from", "effective_to")
    found = rows.collect()
    assert _plan(rows).partition("== Initial Plan ==")[0].count("FileScan parquet") == 1
    assert sorted(map(tuple, found), key=str) == sorted([
        ("A", "A22", T0, T0 + timedelta(hours=50)), ("A", "A24", T0 + timedelta(hours=50), None),
        ("B", "B22", T0, T0 + timedelta(hours=30)), ("B", "B23", T0 + timedelta(hours=30), None)], key=str)


@pytest.fixture
def events(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i // 20, i % 20, i % 60), i % 5, "view", '{"k": %d}' % (i % 40)) for i in range(100)]
    rows += rows[40:44]  # rows that come twice
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_bodies_are_made_after_the_shuffle(spark, events):
    plan = _plan(bindings.payload_log(spark, events))
    assert "flight_status" in plan and "flight_status" not in plan[plan.index("Exchange hashpartitioning"):]
    assert plan.count("Exchange") == 1
    assert bindings.payload_log(spark, events).count() == 25


def test_a_run_lands_its_bodies_once(spark, events):
    landed, log, store = (_folders(spark, n) for n in ("run-landed", "run-log", "run-store"))
    silver = queries.bronze_to_silver_run(spark, events)
    assert _folders(spark, "run-landed") == landed
    (log,), (store,) = _folders(spark, "run-log") - log, _folders(spark, "run-store") - store
    logged, stored = spark.read.parquet(log), spark.read.parquet(store)
    assert set(logged.columns) == {"object_path", "ingested_at", "payload_sha256", "http_status", "ingestion_date"}
    assert logged.count() == stored.count() == 30  # every fifth body comes again
    bodies = queries._resent(bindings.payload_log(spark, events)).withColumn("payload_sha256", F.sha2("body", 256))
    assert _rows(logged.select("object_path", "ingested_at", "payload_sha256")) == _rows(
        bodies.select("object_path", "observed_at", "payload_sha256"))
    expected = pipeline.silver(payload.observations(payload.parse(bodies)))
    assert _rows(silver.select(*expected.columns)) == _rows(expected)


def test_partitions_are_laid_out_with_packed_digests(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(partitions, "packed", lambda rows, names: seen.append(names) or state.packed(rows, names))
    rows = _obs(spark, [("0a" * 32, 0, "b" * 64, "A", 1), ("quarantine:x:0", 0, "AB" * 32, "A", 1), (None, 0, None, "A", 1)])
    partitions.overwrite(rows, str(tmp_path / "t"), F.lit("p"))
    assert seen == [DIGESTS]
    assert _rows(partitions.read(spark, str(tmp_path / "t"))) == _rows(rows)
    partitions.overwrite(state.packed(rows, DIGESTS), str(tmp_path / "b"), F.lit("p"))  # bytes stay bytes
    assert _rows(partitions.read(spark, str(tmp_path / "b"))) == _rows(state.packed(rows, DIGESTS))
