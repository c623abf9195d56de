"""The supplier lookup of the flight log: no shuffle of the log for it, whatever the session's broadcast limit."""

from datetime import datetime

import pytest

from obsengine.sources import bindings


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime(2026, 8, 22)
    rows = {
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(o, 1, o + 7, s, 17.0, "N", "F", day) for o, s in [(1, 1), (2, 2), (3, 2), (4, None), (5, 9)]]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz", [(o, 1, day) for o in range(1, 6)]),
        "customer": ("c_custkey bigint, c_nationkey bigint", [(1, 3)]),
        # a key that comes twice and one that is missing
        "supplier": ("s_suppkey bigint, s_nationkey bigint", [(1, 4), (2, 5), (2, 6), (None, 7)])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    held = {x: spark.conf.get(x, None) for x in limits}
    for x in limits:
        spark.conf.set(x, "-1")
    yield str(tmp_path)
    for x, v in held.items():
        spark.conf.unset(x) if v is None else spark.conf.set(x, v)


def test_the_log_is_not_shuffled_for_the_lookup(spark, tables, monkeypatch):
    obs = bindings.flight_obs(spark, tables)
    found = sorted(map(str, obs.collect()))
    assert "hashpartitioning(l_suppkey" not in obs._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["airline_iata"] for r in obs.collect()) == ["A4", "A5", "A5", "A6", "A6"]
    monkeypatch.setattr(bindings, "LOOKUP_ROWS", 3)
    large = bindings.flight_obs(spark, tables)
    assert sorted(map(str, large.collect())) == found
    assert "hashpartitioning(l_suppkey" in large._jdf.queryExecution().executedPlan().toString()
