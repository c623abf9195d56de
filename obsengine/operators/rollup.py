"""Hourly rollups (partial + final hash aggregation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import hour_start


def hourly(fact: DataFrame, key: str, out_key: str | None = None,
           ts: str = "scheduled_departure_at", flag: str = "is_delayed",
           measure: str = "delay_minutes") -> DataFrame:
    """``(key, hour_start_at, total_flights, delayed_flights, delay_rate,
    average_delay_minutes)`` over rows with a non-null key."""
    out_key = out_key or key
    delayed = F.sum(F.when(F.col(flag), 1).otherwise(0))
    return (fact.where(F.col(key).isNotNull())
            .groupBy(F.col(key).alias(out_key), hour_start(F.col(ts)).alias("hour_start_at"))
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 delayed.alias("delayed_flights"),
                 (delayed.cast("double") / F.count(F.lit(1))).alias("delay_rate"),
                 F.avg(F.col(measure).cast("double")).alias("average_delay_minutes")))


MEASURES = ["total_flights", "delayed_flights", "delay_rate", "average_delay_minutes"]


def refresh(rollup_state: DataFrame, fact: DataFrame, changed: DataFrame, key: str,
            out_key: str | None = None, keep_missing: bool = False,
            ts: str = "scheduled_departure_at") -> DataFrame:
    """Incremental rollup maintenance (tagged like ``upsert_changed``).

    Only hours holding a changed fact row are recomputed from the fact; every
    other group is kept as is.  The hour is part of the flight key, so a
    corrected row (even one that moved to another airline) can only affect
    groups of its own hour.  ``keep_missing=False`` drops groups no longer
    produced (the contract); ``True`` keeps them (the dashboards).
    """
    from .state import CHANGE, KEEP, upsert_changed
    out_key = out_key or key
    hours = changed.select(hour_start(F.col(ts)).alias("hour_start_at")).distinct()
    touched_fact = fact.join(hours, hour_start(F.col(ts)) == hours["hour_start_at"], "left_semi")
    fresh = hourly(touched_fact, key, out_key, ts)
    inside = rollup_state.join(hours, "hour_start_at", "left_semi")
    outside = rollup_state.join(hours, "hour_start_at", "left_anti")
    merged = upsert_changed(inside, fresh, [out_key, "hour_start_at"], MEASURES, keep_missing)
    return outside.select(*rollup_state.columns, F.lit(KEEP).alias(CHANGE)).unionByName(merged)
