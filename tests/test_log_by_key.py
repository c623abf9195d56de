"""Runs of the change log in buckets of the key."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obsengine.operators import changelog, state
from obsengine.plans import queries
from test_folded_rows import ROWS, _obs, _plan, _rows, log  # noqa: F401  (log is a fixture)

SCHEMA = "k string, v int, label string, observed_at timestamp_ntz, sha string, src string"
ORDER = ["observed_at", "sha", "src"]
T0 = datetime(2026, 1, 1)
HOUR = T0 + timedelta(hours=1)
FIRST = [("a", 1, None, T0, "s", "f"), ("b", 7, "B", T0, "s", "f"), ("c'", 3, "C", T0, "s", "f"), (None, 0, "N", T0, "s", "f")]
SECOND = [("a", 1, "A", T0, "s", "f"), ("b", 9, "B", T0 - timedelta(hours=1), "s", "f"), ("c'", 4, None, HOUR, "s", "f"),
          ("d", 5, "D", T0, "s", "f"), ("d", 5, "D", T0, "s", "f")]


def _exchanges(df):
    return _plan(df).count("Exchange hashpartitioning")


@pytest.mark.parametrize("folder", ["log", "it's a log"])
def test_runs_by_key(spark, tmp_path, folder):
    base, tables = str(tmp_path / folder), {t.name for t in spark.catalog.listTables()}
    assert changelog.append(spark.createDataFrame([], SCHEMA), base, T0, ["k"]) is None
    assert changelog.append(spark.createDataFrame(FIRST, SCHEMA), base, T0, ["k"], ["observed_at"]) == 0
    first = changelog.at_run(spark, base, ["k"])
    assert _exchanges(first) == 0 and first.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert _rows(first) == sorted(FIRST, key=str)
    stage = spark.createDataFrame(SECOND, SCHEMA)
    changed = state.upsert_latest(first, stage, "k", ORDER, backfill=["label"], keep=False)
    whole = state.upsert_latest(first, stage, "k", ORDER, backfill=["label"])
    assert _rows(changed) == _rows(whole.where(F.col(state.CHANGE) != state.KEEP).select(*changed.columns))
    assert changelog.append(changed, base, HOUR, ["k"]) == 1
    assert spark.read.parquet(base).count() == 7  # the kept rows are not written again
    assert changelog.append(changed.limit(0), base, HOUR, ["k"]) is None
    assert _rows(changelog.at_run(spark, base, ["k"], 0)) == sorted(FIRST, key=str)
    now = {r.k: (r.v, r.label) for r in changelog.at_run(spark, base, ["k"]).collect()}
    assert now == {"a": (1, "A"), "b": (7, "B"), "c'": (4, None), "d": (5, "D"), None: (0, "N")}
    assert sorted(map(tuple, changelog.runs(spark, base).collect())) == [(0, T0, 4, 0, 0), (1, HOUR, 1, 2, 0)]
    assert changelog.append(stage.limit(1).withColumn("_change", F.lit("delete")), base, HOUR) == 2  # a run without buckets
    assert {r.k for r in changelog.at_run(spark, base, ["k"]).collect()} == {"b", "c'", "d", None}
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_a_run_of_other_buckets_or_another_key_is_shuffled(spark, tmp_path):
    base = str(tmp_path / "log")
    changelog.append(spark.createDataFrame(FIRST, SCHEMA), base, T0, ["k"])
    assert len({r.v for r in changelog.at_run(spark, base, ["label"]).collect()}) == 4
    assert _exchanges(changelog.at_run(spark, base, ["label"])) == 1
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert _rows(changelog.at_run(spark, base, ["k"])) == sorted(FIRST, key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_repeated_keys_of_one_run_come_once(spark, tmp_path):
    base = str(tmp_path / "log")
    changelog.append(spark.createDataFrame(FIRST + FIRST, SCHEMA), base, T0, ["k"])
    assert _rows(changelog.at_run(spark, base, ["k"])) == sorted(FIRST, key=str)


def test_the_replay_shuffles_nothing_of_the_first_run(spark, log, monkeypatch):  # noqa: F811
    plans, append = [], changelog.append

    def seen(tagged, *args):
        plans.append(_exchanges(tagged))
        return append(tagged, *args)

    monkeypatch.setattr(changelog, "append", seen)
    early = queries.read_version(spark, "")
    assert plans == [1, 1] and _exchanges(early) == 0  # one shuffle of each batch, none of the log
    cut = F.lit(queries.CUT).cast("timestamp_ntz")
    rows = _obs(spark, ROWS).where(F.col("observed_at") < cut)
    assert _rows(early) == _rows(state.latest_per_key(rows, queries.OBSERVATION_KEY, queries.OBSERVATION_ORDER))
    assert early.columns == rows.columns
    # of the late batch only the four keys that are new, newer or missing come along
    assert _rows(queries.run_metrics(spark, "")) == [(0, 5, 0, 0), (1, 2, 2, 0)]
    assert [r.version for r in queries.version_list(spark, "").orderBy("version").collect()] == [0, 1]
