"""Whole rows are shuffled folded; merges shuffle every row once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsengine.operators import state
from obsengine.plans import pipeline, queries
from obsengine.schemas import OBSERVATION, OBSERVATION_COLUMNS, OBSERVATION_KEY, OBSERVATION_ORDER

T0 = datetime(1998, 1, 1)
SHA = {c: c * 64 for c in "0123456789abcdef"}


def _obs(spark, rows):
    """rows: (key, hours since the cut, sha, airline name)"""
    values = []
    for i, (key, hours, sha, name) in enumerate(rows):
        r = dict.fromkeys(OBSERVATION_COLUMNS) | {
            "flight_instance_key": key, "flight_iata": f"FL{i}", "airline_iata": "A", "airline_name": name,
            "departure_airport_iata": "", "departure_airport_name": "a\x1fb\x1b1\x1b", "arrival_airport_name": "\x1b2",
            "scheduled_departure_at": T0 if i % 2 else None, "actual_departure_at": T0 + timedelta(microseconds=i),
            "actual_arrival_at": None if i % 3 else T0 - timedelta(days=9, microseconds=1), "delay_minutes": i,
            "is_delayed": False, "observed_at": T0 + timedelta(hours=hours), "source_file": "f", "payload_sha256": sha,
            "quality_status": "valid"}
        values.append(tuple(r[c] for c in OBSERVATION_COLUMNS))
    schema = type(OBSERVATION)([type(f)(f.name, f.dataType, True) for f in OBSERVATION.fields])
    return spark.createDataFrame(values, schema)


ROWS = [(SHA["1"], -2, "a", "A"), (SHA["1"], -1, "b", "B"), (SHA["4"], -1, "a", None), (SHA["4"], 1, "a", "C"),
        (SHA["9"], 1, "c", "D"), (SHA["9"], 1, "d", "D"), (SHA["9"], -3, "e", "E"), ("quarantine:x:0", 2, "a", None),
        (None, -1, "a", "N"), (None, 1, "a", "M"), (SHA["a"], -1, "a", "F"), (SHA["a"], -1, "a", "F")]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _whole_shuffles(df):
    """Shuffles of the executed plan that carry folded or plain whole rows; reused ones do not count."""
    df.collect()
    final = _plan(df).partition("== Initial Plan ==")[0]
    return sum("Exchange hashpartitioning(flight_instance_key" in x and "ReusedExchange" not in x for x in final.splitlines())


@pytest.fixture
def log(spark, monkeypatch):
    monkeypatch.setattr(queries, "_obs", lambda *_: _obs(spark, ROWS))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield _obs(spark, ROWS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_folded_rows_come_back(spark):
    log, apart = _obs(spark, ROWS), [*OBSERVATION_KEY, *OBSERVATION_ORDER]
    rows = state.folded(log, apart)
    assert [t for c, t in rows.dtypes if t == "string" and c not in apart] == ["string"]
    assert _rows(state.unfolded(rows, log, apart)) == _rows(log)
    assert state.unfolded(rows, log, apart).dtypes == log.dtypes
    narrow = log.select("flight_instance_key", "delay_minutes")
    assert _rows(state.unfolded(state.folded(narrow, apart), narrow, apart)) == _rows(narrow)


def test_whole_rows_are_shuffled_folded(spark, log):
    silver = pipeline.silver(log, whole=True)
    shuffle = _plan(silver)[_plan(silver).index("Exchange hashpartitioning"):]
    assert "concat_ws" in shuffle and "split_part" not in shuffle
    assert _rows(silver) == _rows(pipeline.silver(log))
    assert silver.columns == pipeline.silver(log).columns


def test_two_batches_shuffle_each_row_once(spark, log):
    merged = queries.upsert_two_batches(spark, "")
    assert _whole_shuffles(merged) == 2
    # a missing key meets no other: the late and the early one stay
    assert _rows(merged.where("flight_instance_key IS NOT NULL")) == _rows(
        pipeline.silver(log).where("flight_instance_key IS NOT NULL"))
    assert merged.where("flight_instance_key IS NULL").count() == 2


def test_an_empty_state_is_not_joined(spark, log):
    tagged = state.upsert_latest(log.limit(0), log, OBSERVATION_KEY, OBSERVATION_ORDER)
    assert "Join" not in _plan(tagged)
    assert {r[0] for r in tagged.select(state.CHANGE).collect()} == {state.INSERT}
    assert _rows(state.current(tagged)) == _rows(pipeline.silver(log))


def test_backfill_shuffles_the_log_once(spark, log):
    filled = queries.upsert_backfill(spark, "")
    assert _whole_shuffles(filled) == 1
    expected = {r["flight_instance_key"]: r.asDict() for r in pipeline.silver(log).collect()}
    for key, row in expected.items():
        staged = key is not None and key[2] < "8"
        if key is not None and not staged and key[0] < "4":
            row["airline_name"] = None
        if key is not None and not staged and key[1] == "a":
            row["departure_airport_name"] = None
    assert _rows(filled) == sorted((tuple(r.values()) for r in expected.values()), key=str)


def test_evolution_and_window_merges_shuffle_folded_rows(spark, log):
    evolved = queries.schema_evolution_union(spark, "")
    assert "concat_ws" in _plan(evolved) and _whole_shuffles(evolved) == 2
    types = {r["flight_instance_key"]: r["aircraft_type"] for r in evolved.where("flight_instance_key IS NOT NULL").collect()}
    assert types == {SHA["1"]: None, SHA["4"]: "a320n", SHA["9"]: "a320n", "quarantine:x:0": "a320n", SHA["a"]: None}
    merged = queries.upsert_incremental(spark, "")
    assert "concat_ws" in _plan(merged)
    assert {r[0] for r in merged.select(state.CHANGE).distinct().collect()} == {state.KEEP}
    assert _rows(state.current(merged)) == _rows(pipeline.silver(log))
