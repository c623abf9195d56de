"""Landing-file stream → versioned silver state."""
import os
import time

import pytest

from conftest import fixture_bytes
from obsengine.plans import gold_store, pipeline
from obsengine.streaming import ingest


def _land(folder, name, data, mtime):
    p = folder / name
    p.write_bytes(data)
    os.utime(p, (mtime, mtime))


def test_stream_applies_newest_wins(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    base, ckpt = str(tmp_path / "silver"), str(tmp_path / "ckpt")
    t0 = 1_787_000_000
    _land(landing, "a.json", fixture_bytes("v1"), t0)
    q = ingest.start_silver_stream(spark, str(landing), base, ckpt)
    q.awaitTermination(120)
    first = ingest.current_state(spark, base).collect()
    assert [r.delay_minutes for r in first] == [33]

    # the late correction and an older re-send arrive in the next run
    _land(landing, "c.json", fixture_bytes("late_correction"), t0 + 7200)
    _land(landing, "b.json", fixture_bytes("v1"), t0 - 3600)
    q = ingest.start_silver_stream(spark, str(landing), base, ckpt)
    q.awaitTermination(120)
    rows = ingest.current_state(spark, base).collect()
    assert [(r.delay_minutes, r.source_file.endswith("c.json")) for r in rows] == [(52, True)]

    # a fresh checkpoint replays every file into the same state: nothing is lost or doubled
    _land(landing, "d.json", fixture_bytes("dimension_change"), t0 + 9000)
    q = ingest.start_silver_stream(spark, str(landing), base, str(tmp_path / "other"))
    q.awaitTermination(120)
    rows = ingest.current_state(spark, base).collect()
    assert [(r.airline_name, r.delay_minutes) for r in rows] == [("Fjordvinge Nord", 52)]


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_rollups_follow_the_stream(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    base, ckpt, gold = (str(tmp_path / n) for n in ("silver", "ckpt", "gold"))
    t0 = 1_787_000_000
    _land(landing, "a.json", fixture_bytes("v1"), t0)
    ingest.start_silver_stream(spark, str(landing), base, ckpt, gold=gold).awaitTermination(180)

    def check():
        silver = ingest.current_state(spark, base)
        for table, rollup in (("airline_hour", pipeline.airline_rollup), ("airport_hour", pipeline.airport_rollup)):
            want = _rows(rollup(pipeline.fact_stage(silver)))
            assert want and _rows(gold_store.read(spark, gold, table)) == want
        return [r.delay_minutes for r in gold_store.read(spark, gold, "fact").collect()]

    before = check()

    # the late correction reaches silver, then the batch breaks off before gold
    _land(landing, "c.json", fixture_bytes("late_correction"), t0 + 7200)
    plain = gold_store.run

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(gold_store, "run", broken)
    with pytest.raises(Exception, match="lost"):
        ingest.start_silver_stream(spark, str(landing), base, ckpt, gold=gold).awaitTermination(180)
    monkeypatch.setattr(gold_store, "run", plain)
    assert [r.delay_minutes for r in gold_store.read(spark, gold, "fact").collect()] == before

    # the batch runs again: silver has nothing new, gold gets its rows all the same
    ingest.start_silver_stream(spark, str(landing), base, ckpt, gold=gold).awaitTermination(180)
    assert check() == [52] != before
