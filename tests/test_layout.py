"""Layout shuffles of partitioned tables and the joins of stored gold."""

from datetime import timedelta

from pyspark.sql import functions as F

from obsengine.operators import partitions, state
from obsengine.plans import gold_store, pipeline
from test_folded_rows import ROWS, SHA, T0, _obs, _plan, _rows, log  # noqa: F401  (log is a fixture)


def test_layout_shuffles_folded_rows(spark, tmp_path, monkeypatch):
    plans, fold = [], state.folded
    monkeypatch.setattr(partitions, "folded", lambda rows, apart: plans.append(apart) or fold(rows, apart))
    rows = _obs(spark, ROWS)
    partitions.overwrite(rows, str(tmp_path / "t"), F.coalesce(F.col("airline_name"), F.lit("none")))
    assert plans == [[partitions.PART]]
    assert _rows(partitions.read(spark, str(tmp_path / "t"))) == _rows(rows)
    assert partitions.read(spark, str(tmp_path / "t")).dtypes == rows.dtypes


def test_a_stage_is_shuffled_folded(spark, monkeypatch, log):  # noqa: F811
    plans, write = [], state.materialize
    monkeypatch.setattr(state, "materialize", lambda df, *name: plans.append(_plan(df)) or write(df, *name))
    assert _rows(pipeline.latest_stage(log)) == _rows(pipeline.silver(log))
    assert "concat_ws" in plans[0][plans[0].index("Exchange hashpartitioning"):]


def test_fact_changes_are_joined_by_bytes(spark, tmp_path, monkeypatch, log):  # noqa: F811
    plans, write = {}, gold_store.materialize
    monkeypatch.setattr(gold_store, "materialize", lambda df, name: plans.update({name: _plan(df)}) or write(df, name))
    silver, base = pipeline.silver(log.where("flight_instance_key IS NOT NULL")), str(tmp_path / "gold")
    first = silver.where(F.col("flight_instance_key") != SHA["9"]).withColumn(
        "delay_minutes", F.when(F.col("flight_instance_key") != SHA["4"], F.col("delay_minutes")).otherwise(99))
    gold_store.run(first, base)
    later = silver.withColumn("observed_at", F.col("observed_at") + F.make_dt_interval(
        hours=F.when(F.col("flight_instance_key") == SHA["4"], 1).otherwise(0)))
    counts = gold_store.run(later, base).first()
    assert (counts.inserted, counts.updated) == (1, 1)
    joined = plans["fact-changes"]
    assert joined.count("unhex") >= 2 and "SortMergeJoin" in joined
    fact = gold_store.read(spark, base, "fact")
    assert _rows(fact.select(*gold_store.FACT_COLUMNS)) == _rows(pipeline.fact_stage(later))
    for table, rollup in (("airline_hour", pipeline.airline_rollup(fact)), ("airport_hour", pipeline.airport_rollup(fact))):
        assert _rows(gold_store.read(spark, base, table)) == _rows(rollup)
    assert fact.where(F.col("observed_at") == T0 + timedelta(hours=2)).count() >= 1
