"""Serving queries over the rollups and the current state.

Re-aggregating an hourly rollup by one key uses count-weighted means
(``Σ avg·n / Σ n``); weighted means are rounded to ``PRECISION`` digits so
results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 9


def _rate(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den, F.lit(0))


def _weighted(avg: str = "average_delay_minutes", n: str = "total_flights") -> Column:
    return F.round(F.sum(F.col(avg) * F.col(n)) / F.nullif(F.sum(n), F.lit(0)), PRECISION)


def total_flights(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.coalesce(F.sum("total_flights"), F.lit(0)).cast("long").alias("total_flights"))


def delayed_flights(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.coalesce(F.sum("delayed_flights"), F.lit(0)).cast("long").alias("delayed_flights"))


def overall_rate(rollup: DataFrame) -> DataFrame:
    """Overall delay rate; 0 on an empty rollup."""
    return rollup.agg(F.coalesce(_rate(F.sum("delayed_flights"), F.sum("total_flights")),
                                 F.lit(0.0)).alias("delay_rate"))


def weighted_average(rollup: DataFrame) -> DataFrame:
    """Count-weighted average delay; 0 on an empty rollup."""
    return rollup.agg(F.coalesce(_weighted(), F.lit(0.0)).alias("average_delay_minutes"))


def by_key(rollup: DataFrame, key: str) -> DataFrame:
    """Delay rate per key ranked by rate, volume, key (NULL rate on empty)."""
    return (rollup.groupBy(key).agg(
        F.sum("total_flights").alias("total_flights"),
        F.sum("delayed_flights").alias("delayed_flights"),
        _rate(F.sum("delayed_flights"), F.sum("total_flights")).alias("delay_rate"),
        _weighted().alias("average_delay_minutes"))
        .orderBy(F.desc_nulls_last("delay_rate"), F.desc_nulls_last("total_flights"),
                 F.asc_nulls_last(key)))


def trend(rollup: DataFrame) -> DataFrame:
    """Hourly trend over all keys, in time order (NULL hour last)."""
    return (rollup.groupBy("hour_start_at").agg(
        F.sum("total_flights").alias("total_flights"),
        F.sum("delayed_flights").alias("delayed_flights"),
        _rate(F.sum("delayed_flights"), F.sum("total_flights")).alias("delay_rate"),
        _weighted().alias("average_delay_minutes"))
        .orderBy(F.asc_nulls_last("hour_start_at")))


DETAIL_COLUMNS = ["flight_iata", "airline_iata", "airline_name", "departure_airport_iata",
                  "departure_airport_name", "arrival_airport_iata", "arrival_airport_name",
                  "scheduled_departure_at", "delay_minutes", "is_delayed", "observed_at"]


def detail(state: DataFrame, n: int = 500) -> DataFrame:
    """Top-``n`` valid delayed-flight rows, newest schedule first; the key is
    the last sort column so ties are deterministic.  Plans as
    ``TakeOrderedAndProject`` (per-partition top-n, then a final merge)."""
    return (state.where((F.col("quality_status") == "valid") & F.col("delay_minutes").isNotNull())
            .orderBy(F.desc_nulls_last("scheduled_departure_at"), F.desc_nulls_last("delay_minutes"),
                     F.asc("flight_instance_key"))
            .limit(n).select("flight_instance_key", *DETAIL_COLUMNS))


def rollup_rows(rollup: DataFrame, key: str) -> DataFrame:
    return rollup.orderBy(F.asc_nulls_last(key), F.asc_nulls_last("hour_start_at"))


def dim_history(dim: DataFrame, key: str) -> DataFrame:
    return dim.orderBy(F.asc_nulls_last(key), F.asc_nulls_last("effective_from"))
