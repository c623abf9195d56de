"""State operators: newest-wins upsert properties, back-fill, change-detecting
upsert, as-of reads, evolution, change log."""
import itertools
import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsengine.operators import changelog, partitions, state
from obsengine.schemas import ADDITIVE_FIELDS

SCHEMA = "k string, v int, label string, observed_at timestamp_ntz, sha string, src string"
ORDER = ["observed_at", "sha", "src"]
T0 = datetime(2026, 1, 1)


def rows_of(df):
    return sorted(tuple(r) for r in state.current(df).collect())


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_batches(seed, n_batches=3, n_rows=12):
    rnd = random.Random(seed)
    out = []
    for b in range(n_batches):
        out.append([(f"k{rnd.randint(0, 4)}", rnd.randint(0, 99), rnd.choice(["A", "B", None]),
                     T0 + timedelta(hours=rnd.randint(0, 5)), f"s{rnd.randint(0, 3)}", f"f{b}-{i}")
                    for i in range(n_rows)])
    return out


def fold(spark, batches):
    st = batch(spark, [])
    for b in batches:
        st = state.current(state.upsert_latest(st, batch(spark, b), "k", ORDER))
    return st


def test_upsert_is_order_free_and_equals_latest_of_union(spark):
    for seed in range(3):
        bs = random_batches(seed)
        union = batch(spark, [r for b in bs for r in b])
        want = rows_of(state.latest_per_key(union, "k", ORDER))
        for perm in itertools.permutations(bs):
            assert rows_of(fold(spark, perm)) == want


def test_rerun_changes_nothing(spark):
    bs = random_batches(7)
    st = fold(spark, bs)
    again = state.upsert_latest(st, batch(spark, bs[0]), "k", ORDER)
    assert not state.has_changes(again)
    assert {r["_change"] for r in state.merge_metrics(again).collect()} == {"keep"}


def test_older_arrival_is_ignored_and_tags(spark):
    st = batch(spark, [("a", 1, "A", T0 + timedelta(hours=2), "s", "f")])
    stage = batch(spark, [("a", 9, "A", T0, "s", "f"), ("b", 2, "B", T0, "s", "f")])
    tagged = {r.k: (r.v, r._change) for r in state.upsert_latest(st, stage, "k", ORDER).collect()}
    assert tagged == {"a": (1, "keep"), "b": (2, "insert")}


def test_backfill_on_equal_order(spark):
    st = batch(spark, [("a", 1, None, T0, "s", "f")])
    stage = batch(spark, [("a", 1, "A", T0, "s", "f")])
    plain = state.upsert_latest(st, stage, "k", ORDER).first()
    filled = state.upsert_latest(st, stage, "k", ORDER, backfill=["label"]).first()
    assert (plain.label, plain._change) == (None, "keep")
    assert (filled.label, filled._change) == ("A", "update")


def test_as_of_max_is_current(spark):
    log = batch(spark, [r for b in random_batches(3) for r in b])
    cur = state.latest_per_key(log, "k", ORDER)
    assert rows_of(state.as_of(log, T0 + timedelta(days=1), "k", ORDER)) == rows_of(cur)
    early = state.as_of(log, T0 + timedelta(hours=1), "k", ORDER)
    assert all(r.observed_at <= T0 + timedelta(hours=1) for r in early.collect())


def test_upsert_changed(spark):
    sch = "key string, hour int, n long, rate double"
    before = spark.createDataFrame([("a", 1, 1, 0.5), ("b", 1, 2, None), ("c", 1, 3, 1.0)], sch)
    after = spark.createDataFrame([("a", 1, 1, 0.5), ("b", 1, 2, 0.1), ("d", 1, 4, 0.0)], sch)
    keep = {r.key: r._change for r in
            state.upsert_changed(before, after, ["key", "hour"], ["n", "rate"], True).collect()}
    assert keep == {"a": "keep", "b": "update", "c": "keep", "d": "insert"}
    drop = {r.key for r in state.upsert_changed(before, after, ["key", "hour"], ["n", "rate"], False).collect()}
    assert drop == {"a", "b", "d"}


def test_evolve_adds_column_and_nulls_missing(spark):
    st = batch(spark, [("a", 1, "A", T0, "s", "f")])
    stage = batch(spark, [("b", 2, "B", T0, "s", "f")]).withColumn("aircraft_type", F.lit("x"))
    s0, s1 = state.evolve(st, stage, ADDITIVE_FIELDS)
    assert s0.columns == s1.columns and "aircraft_type" in s0.columns
    later = batch(spark, [("b", 3, "B", T0 + timedelta(hours=1), "s", "f")])
    evolved = state.current(state.upsert_latest(s0, s1, "k", ORDER))
    e2, l2 = state.evolve(evolved, later, ADDITIVE_FIELDS)
    got = {r.k: r.aircraft_type for r in state.current(state.upsert_latest(e2, l2, "k", ORDER)).collect()}
    assert got == {"a": None, "b": None}  # newest payload lacks the field → NULL


def test_diff(spark):
    old = batch(spark, [("a", 1, "A", T0, "s", "f"), ("b", 2, "B", T0, "s", "f")])
    new = batch(spark, [("a", 5, "A", T0, "s", "f"), ("c", 3, "C", T0, "s", "f")])
    got = {r.k: r.diff for r in state.diff(old, new, "k", ["v"]).collect()}
    assert got == {"a": "changed", "b": "removed", "c": "added"}


def test_change_log_replays_runs(spark, tmp_path):
    base = str(tmp_path / "silver")
    assert changelog.latest_run(spark, base) is None and changelog.runs(spark, base).collect() == []
    v0 = changelog.append(batch(spark, [("a", 1, "A", T0, "s", "f"), ("b", 7, "B", T0, "s", "f")]), base, T0)
    hour = T0 + timedelta(hours=1)
    tagged = state.upsert_latest(changelog.at_run(spark, base, ["k"]), batch(spark, [("a", 2, "A", hour, "s", "f")]), "k", ORDER)
    v1 = changelog.append(tagged, base, hour)
    assert (v0, v1) == (0, 1) and spark.read.parquet(base).count() == 3  # the kept row is not written again
    noop = state.upsert_latest(changelog.at_run(spark, base, ["k"]), batch(spark, []), "k", ORDER)
    assert changelog.append(noop, base, T0 + timedelta(hours=2)) is None

    def values(run=None):
        return sorted((r.k, r.v) for r in changelog.at_run(spark, base, ["k"], run).collect())

    assert (values(0), values()) == ([("a", 1), ("b", 7)], [("a", 2), ("b", 7)])
    assert sorted(map(tuple, changelog.runs(spark, base).collect())) == [(0, T0, 2, 0, 0), (1, hour, 0, 1, 0)]
    gone = changelog.at_run(spark, base, ["k"]).where("k = 'b'").withColumn("_change", F.lit("delete"))
    assert changelog.append(gone, base, hour) == 2
    assert (values(), values(1)) == ([("a", 2)], [("a", 2), ("b", 7)])


def test_broadcast_plan_equals_shuffle_plan(spark):
    for seed in range(3):
        bs = random_batches(seed + 10)
        st = state.current(state.upsert_latest(batch(spark, []), batch(spark, bs[0]), "k", ORDER))
        stage = batch(spark, bs[1] + bs[2])
        a = state.upsert_latest(st, stage, "k", ORDER, backfill=["label"])
        b = state.upsert_latest(st, stage, "k", ORDER, backfill=["label"], stage_written=True)
        c = state.upsert_latest_sized(st, stage, "k", ORDER, backfill=["label"])
        key = lambda r: repr(r)
        assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)
        assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, c.collect()), key=key)


def test_written_stage_is_joined_without_shuffling_the_state(spark):
    st = batch(spark, [("a", 1, "A", T0, "s", "f")])
    stage = state.materialize(batch(spark, [("a", 2, "A", T0 + timedelta(hours=1), "s", "f")]))
    plan = state.upsert_latest(st, stage, "k", ORDER, stage_written=True,
                               stage_is_latest=True)._jdf \
        .queryExecution().executedPlan().toString()
    assert "LeftOuter, BuildRight" in plan and "LeftSemi, BuildRight" in plan


def test_partitions_rewrite_only_touched(spark, tmp_path):
    base = str(tmp_path / "pstate")
    part = partitions.part_value(F.to_date("observed_at"), F.col("k"))
    day = lambda d, h=0: datetime(2026, 1, d, h)

    def merge(rows, parts=None):
        before = partitions.read(spark, base, parts)
        cur = before if before is not None else batch(spark, [])
        changes = partitions.change_set(state.upsert_latest(cur, batch(spark, rows), "k", ORDER), part)
        return partitions.write_changed(spark, base, before, changes, ["k"], part)

    assert merge([("a", 1, "A", day(1), "s", "f"), ("b", 2, "B", day(2), "s", "f"),
                  ("c", 3, "C", day(2), "s", "f")]) == ["2026-01-01", "2026-01-02"]
    files = sorted(os.listdir(f"{base}/_part=2026-01-01"))
    assert [r.k for r in partitions.read(spark, base, ["2026-01-01"]).collect()] == ["a"]
    assert merge([("b", 5, "B", day(2, 5), "s", "f")], ["2026-01-02"]) == ["2026-01-02"]
    assert sorted(os.listdir(f"{base}/_part=2026-01-01")) == files
    assert sorted((r.k, r.v) for r in partitions.read(spark, base).collect()) == [("a", 1), ("b", 5), ("c", 3)]
    assert merge([("b", 5, "B", day(2, 5), "s", "f")], ["2026-01-02"]) == []


def test_describe(spark):
    d = {r.col_name: (r.data_type, r.nullable) for r in state.describe(batch(spark, [])).collect()}
    assert d["k"] == ("string", True) and d["observed_at"] == ("timestamp_ntz", True)
