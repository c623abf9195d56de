"""Digests shuffled as bytes, first merges without joins, change sets written once."""

import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsengine.functions.keys import pack_digest, unpack_digest
from obsengine.operators import changelog, partitions, state
from obsengine.plans import gold_store, pipeline
from obsengine.schemas import OBSERVATION, OBSERVATION_COLUMNS
from obsengine.session import shared_dir

T0 = datetime(2026, 8, 22, 6)


def _obs(spark, rows):
    """rows: (key, hours, sha, airline name)"""
    values = []
    for key, hours, sha, name in rows:
        r = dict.fromkeys(OBSERVATION_COLUMNS) | {
            "flight_instance_key": key, "airline_iata": "A", "airline_name": name, "departure_airport_iata": "P",
            "scheduled_departure_at": T0, "delay_minutes": 5, "is_delayed": False,
            "observed_at": T0 + timedelta(hours=hours), "source_file": "f", "payload_sha256": sha,
            "quality_status": "valid"}
        values.append(tuple(r[c] for c in OBSERVATION_COLUMNS))
    return spark.createDataFrame(values, OBSERVATION)


def _folders(spark, name):
    return set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/obsengine/{name}-*"))


def test_digests_survive_packing(spark):
    texts = ["ab" * 32, "00" * 32, "AB" * 32, "g" * 64, "", "x" * 31, "y" * 32, "z" * 33, "quarantine:" + "ab" * 32 + ":0",
             "é" * 32, "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    p = df.select("t", pack_digest(F.col("t")).alias("p")).select("t", F.length("p").alias("n"), unpack_digest(F.col("p")).alias("u"))
    rows = p.collect()
    assert [r["u"] for r in rows] == texts
    assert [r["n"] == 32 for r in rows[:4]] == [True, True, False, False]
    assert len({r["n"] for r in rows}) > 1


def test_silver_shuffles_digests_as_bytes(spark):
    a, b = "0a" * 32, "0b" * 32
    log = _obs(spark, [(a, 1, a, "old"), (a, 1, b, "new"), ("quarantine:x:0", 1, a, "q")])
    silver = pipeline.silver(log)
    plan = silver._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "unhex" in exchange and "WindowGroupLimit" in exchange
    assert sorted(silver.select("flight_instance_key", "airline_name").collect()) == [(a, "new"), ("quarantine:x:0", "q")]
    held = pipeline.silver(state.packed(log, ["flight_instance_key", "payload_sha256"]))
    assert dict(held.dtypes)["payload_sha256"] == "binary"


def test_first_merge_writes_no_change_set(spark, tmp_path, monkeypatch):
    base, before = str(tmp_path / "silver"), _folders(spark, "change-set")
    changes = pipeline.merge_into_partitions(base, _obs(spark, [("k1", 0, "a", "n"), ("k2", 0, "a", "n")]))
    assert _folders(spark, "change-set") == before
    assert {r[0] for r in changes.select(state.CHANGE).collect()} == {state.INSERT}
    assert pipeline.merge_into_partitions(base, _obs(spark, [("k1", 0, "a", "n")])) is None
    second = pipeline.merge_into_partitions(base, _obs(spark, [("k1", 1, "a", "m"), ("k3", 0, "a", "n")]))
    assert sorted(second.select("flight_instance_key", state.CHANGE).collect()) == [("k1", "update"), ("k3", "insert")]
    rows = partitions.read(spark, base).select("flight_instance_key", "airline_name").collect()
    assert sorted(rows) == [("k1", "m"), ("k2", "n"), ("k3", "n")]


@pytest.mark.parametrize("small", [True, False])
def test_stage_changes_are_those_of_the_upsert(spark, monkeypatch, small):
    monkeypatch.setattr(state, "_fits_broadcast", lambda df: small)
    schema = "k string, o int, label string, v int"
    known = spark.createDataFrame([("a", 1, None, 1), ("b", 2, "x", 1), ("c", 1, "x", 1), ("d", 1, None, 1),
                                   (None, 1, "x", 1)], schema)
    stage = state.materialize(spark.createDataFrame(
        [("a", 1, "x", 2), ("b", 1, "y", 2), ("c", 2, None, 2), ("d", 1, None, 2), ("e", 1, "x", 2), (None, 0, "x", 2)], schema))
    whole = state.upsert_latest(known, stage, "k", ["o"], backfill=["label"], stage_written=True, stage_is_latest=True)
    expected = whole.where(F.col(state.CHANGE) != state.KEEP)
    found = state.stage_changes(known, stage, "k", ["o"], backfill=["label"])
    assert sorted(found.collect(), key=str) == sorted(expected.select(*found.columns).collect(), key=str)
    sized = state.upsert_latest_sized(known, stage, "k", ["o"], backfill=["label"])
    assert sorted(sized.collect(), key=str) == sorted(whole.collect(), key=str)


def test_a_run_is_written_once(spark, tmp_path):
    base, before = str(tmp_path / "log"), _folders(spark, "run-changes")
    state1 = _obs(spark, [("k1", 0, "a", "n")])
    assert changelog.append(state1, base, T0) == 0
    again = pipeline.merge_silver(changelog.at_run(spark, base, ["flight_instance_key"]), state1)
    assert changelog.append(again, base, T0) is None
    newer = pipeline.merge_silver(changelog.at_run(spark, base, ["flight_instance_key"]), _obs(spark, [("k1", 1, "a", "m")]))
    assert changelog.append(newer, base, T0) == 1
    assert _folders(spark, "run-changes") == before
    assert [tuple(r) for r in changelog.runs(spark, base).select("run", "inserted", "updated").orderBy("run").collect()] == [
        (0, 1, 0), (1, 0, 1)]


def test_gold_keeps_only_the_columns_it_uses(spark, tmp_path):
    before = _folders(spark, "gold-source")
    gold_store.run(pipeline.silver(_obs(spark, [("k1", 0, "a", "n")])), str(tmp_path / "gold"))
    (source,) = _folders(spark, "gold-source") - before
    assert set(spark.read.parquet(source).columns) == set(gold_store.SOURCE_COLUMNS)
    assert "payload_sha256" not in gold_store.SOURCE_COLUMNS
