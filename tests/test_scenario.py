"""End-to-end scenario golden: v1 → v2 → late correction → gold →
dimension change, with a change log of runs, as-of reads and idempotent reruns."""
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from conftest import fixture_bytes, payloads, t
from obsengine.operators import changelog, partitions, quality, state
from obsengine.plans import pipeline
from obsengine.schemas import OBSERVATION
from obsengine.sources import landing

KEY = "51e0478cec43aff18ea2660ad01da6182cf714e14ff1fcfd85addd42bea00825"
T1, T2, T3, T4 = t(1), t(2), t(3), t(4)
LANDED = [("v1", T1, "v1"), ("v2", T2, "v2_additive"), ("late", T3, "late_correction"),
          ("dim", T4, "dimension_change")]


def window(spark, upto):
    return payloads(spark, [(f"s3a://b/{p}.json", ts, fixture_bytes(f)) for p, ts, f in LANDED[:upto]])


def test_scenario(spark, tmp_path):
    base = str(tmp_path / "silver")
    silver = spark.createDataFrame([], OBSERVATION)

    # v1: one row, no additive column yet
    tagged = pipeline.bronze_to_silver(silver, window(spark, 1))
    silver = state.current(tagged)
    assert "aircraft_type" not in silver.columns
    r = silver.first()
    assert (r.flight_instance_key, r.delay_minutes, r.observed_at) == (KEY, 33, T1)
    changelog.append(silver, base, T1)

    # v2: evolved, e195-e2, observed t2 (published: version 1)
    silver = state.current(pipeline.bronze_to_silver(changelog.at_run(spark, base, ["flight_instance_key"]), window(spark, 2)))
    r = silver.first()
    assert (r.delay_minutes, r.aircraft_type, r.observed_at) == (33, "e195-e2", T2)
    assert changelog.append(silver, base, T2) == 1

    # late correction: delay 52, additive field back to NULL; version 1 unchanged
    tagged = pipeline.bronze_to_silver(changelog.at_run(spark, base, ["flight_instance_key"]), window(spark, 3))
    assert {r._change for r in tagged.collect()} == {"update"}
    changelog.append(tagged, base, T3)
    silver = changelog.at_run(spark, base, ["flight_instance_key"])
    r = silver.first()
    assert (r.delay_minutes, r.aircraft_type, r.observed_at) == (52, None, T3)
    old = changelog.at_run(spark, base, ["flight_instance_key"], 1).first()
    assert (old.delay_minutes, old.aircraft_type) == (33, "e195-e2")

    # rerun of the same window: zero changes, nothing published
    rerun = pipeline.bronze_to_silver(silver, window(spark, 3))
    assert not state.has_changes(rerun)
    assert changelog.append(rerun, base, T3) is None

    # gold
    g = pipeline.gold_from_silver(silver)
    f = g.fact.collect()
    assert len(f) == 1 and (f[0].delay_minutes, f[0].is_delayed) == (52, True)
    assert [(r.airline_iata, r.effective_from, r.is_current) for r in g.airline_dim.collect()] == [("FV", T3, True)]
    assert sorted((r.airport_iata, r.effective_from) for r in g.airport_dim.collect()) == [("BGO", T3), ("OSL", T3)]
    hour = datetime(2026, 9, 3, 9)
    assert [tuple(r) for r in g.airline_hour.collect()] == [("FV", hour, 1, 1, 1.0, 52.0)]
    assert [tuple(r) for r in g.airport_hour.collect()] == [("OSL", hour, 1, 1, 1.0, 52.0)]

    # dimension change: new labels from t4, old versions closed at t4
    step = state.materialize(pipeline.bronze_to_silver(silver, window(spark, 4)))
    silver2 = state.current(step)
    changes = step.where(F.col("_change") != "keep")
    r = silver2.first()
    assert (r.airline_name, r.observed_at) == ("Fjordvinge Nord", T4)
    g2 = pipeline.gold_from_silver(silver2, previous=g)
    dims = sorted((r.airline_name, r.effective_to, r.is_current) for r in g2.airline_dim.collect())
    assert dims == [("Fjordvinge", T4, False), ("Fjordvinge Nord", None, True)]
    ap = g2.airport_dim.collect()
    assert len(ap) == 4 and sum(r.is_current for r in ap) == 2
    assert sorted(r.effective_to for r in ap if not r.is_current) == [T4, T4]
    assert [tuple(r) for r in g2.airline_hour.collect()] == [("FV", hour, 1, 1, 1.0, 52.0)]
    assert g2.fact.count() == 1
    inc = pipeline.gold_incremental(silver2, g)
    inc2 = pipeline.gold_incremental(silver2, g, silver_changes=changes)
    for a, b, c in [(inc.airline_hour, g2.airline_hour, inc2.airline_hour),
                    (inc.airport_hour, g2.airport_hour, inc2.airport_hour),
                    (inc.airline_dim, g2.airline_dim, inc2.airline_dim), (inc.fact, g2.fact, inc2.fact)]:
        want = sorted(map(tuple, b.collect()), key=repr)
        assert sorted(map(tuple, a.collect()), key=repr) == want
        assert sorted(map(tuple, c.collect()), key=repr) == want

    # gold invariants hold; gold rerun changes nothing
    checks = quality.union_checks(
        quality.check(g2.fact, {"fact has invalid delay":
                                F.col("flight_instance_key").isNull() | (F.col("delay_minutes") < 0)}),
        quality.duplicate_check(g2.airline_dim, "airline dimension has duplicate current keys",
                                "airline_iata", F.col("is_current")),
        quality.check(g2.airport_dim, {"airport dimension has invalid date range":
                                       F.col("effective_to") <= F.col("effective_from")}))
    quality.assert_all(checks)
    g3 = pipeline.gold_from_silver(silver2, previous=g2)
    assert sorted(map(tuple, g3.airline_dim.collect()), key=repr) == sorted(map(tuple, g2.airline_dim.collect()), key=repr)


def test_assert_all_raises_with_counts(spark):
    import pytest
    df = spark.createDataFrame([(1,), (-1,)], "d int")
    with pytest.raises(RuntimeError, match="negative"):
        quality.assert_all(quality.check(df, {"negative": F.col("d") < 0}))


def test_partitioned_merge_with_evolution(spark, tmp_path):
    base = str(tmp_path / "silver_parts")
    assert {r._change for r in pipeline.merge_payloads_into(base, window(spark, 1)).collect()} == {"insert"}
    assert "aircraft_type" not in partitions.read(spark, base).columns
    step = pipeline.merge_payloads_into(base, window(spark, 2).where(F.col("observed_at") == T2)).collect()
    assert [(r._change, r._part) for r in step] == [("update", "2026-09-03")]
    r = partitions.read(spark, base).first()
    assert (r.aircraft_type, r.delay_minutes, r.observed_at) == ("e195-e2", 33, T2)
    # the late correction lacks the field: NULL once evolved; replaying it writes nothing
    late = window(spark, 3).where(F.col("observed_at") == T3)
    assert pipeline.merge_payloads_into(base, late) is not None
    files = sorted(os.listdir(f"{base}/_part=2026-09-03"))
    assert pipeline.merge_payloads_into(base, late) is None
    assert sorted(os.listdir(f"{base}/_part=2026-09-03")) == files
    r = partitions.read(spark, base).first()
    assert (r.aircraft_type, r.delay_minutes) == (None, 52)


def test_first_merge_of_an_empty_window(spark, tmp_path):
    base = str(tmp_path / "none")
    assert pipeline.merge_payloads_into(base, window(spark, 0)) is None
    assert partitions.read(spark, base) is None


def test_failed_run_is_run_again(spark, tmp_path):
    base = str(tmp_path / "again")
    for _ in range(2):  # the second run stands for a retry after a crash behind the write
        pipeline.merge_payloads_into(base, window(spark, 2))
    assert partitions.read(spark, base).count() == 1


def test_old_state_without_label_columns(spark, tmp_path):
    labels = ["airline_name", "departure_airport_name", "arrival_airport_name"]
    old = state.current(pipeline.bronze_to_silver(spark.createDataFrame([], OBSERVATION),
                                                  window(spark, 1))).drop(*labels)
    r = state.current(pipeline.bronze_to_silver(old, window(spark, 1))).first()
    assert r.airline_name == "Fjordvinge" and r.arrival_airport_name == "Flesland"


def test_look_back_run(spark, tmp_path):
    store, log, base = (str(tmp_path / n) for n in ("store", "log", "state"))
    schema = ("ingestion_id string, http_status int, body binary, transport_error string, "
              "storage_error string, endpoint string, params map<string,string>, ingested_at timestamp")
    utc = lambda ts: ts.replace(tzinfo=timezone.utc)
    rows = [(p, 200, bytearray(fixture_bytes(f)), None, None, "flights", {}, utc(ts)) for p, ts, f in LANDED[:2]]
    rows.append(("down", 503, None, "timeout", None, "flights", {}, utc(T2)))
    landing.land(spark.createDataFrame(rows, schema), "src", "b", store, log)
    run = pipeline.bronze_to_silver_run(spark, log, store, base, T3)
    assert [tuple(r) for r in run.select("files", "parsed", "staged", "inserted", "updated").collect()] == [(2, 2, 1, 1, 0)]
    again = pipeline.bronze_to_silver_run(spark, log, store, base, T3).first()
    assert (again.inserted, again.updated, again.column_added) == (0, 0, False)
    assert partitions.read(spark, base).first().delay_minutes == 33


def test_a_run_parses_its_bodies_once(spark, tmp_path, monkeypatch):
    log, store, base = (str(tmp_path / n) for n in ("log", "store", "silver"))
    bodies = window(spark, 2).withColumn("ingestion_date", F.to_date("observed_at"))
    bodies.select(F.col("object_path").alias("path"), F.col("body").alias("content"),
                  "ingestion_date").write.partitionBy("ingestion_date").parquet(store)
    bodies.select("object_path", F.col("observed_at").alias("ingested_at"), "payload_sha256",
                  F.lit(200).alias("http_status"), "ingestion_date").write.partitionBy("ingestion_date").parquet(log)
    calls, plain = [], pipeline.payload.parse

    def counted(*args, **kwargs):
        calls.append(args)
        return plain(*args, **kwargs)

    monkeypatch.setattr(pipeline.payload, "parse", counted)
    counts = pipeline.bronze_to_silver_run(spark, log, store, base, T3)
    # the counts read written tables alone: no body is decoded again
    assert len(calls) == 1
    assert "parse_json" not in counts._jdf.queryExecution().executedPlan().toString()
    row, obs = counts.first(), pipeline.payload.observations(plain(bodies))
    assert (row.files, row.parsed) == (bodies.count(), obs.count())
    assert row.staged == row.inserted == obs.select("flight_instance_key").distinct().count()
