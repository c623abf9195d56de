"""Runs and states at a run, replayed from an append-only change log.

A merge's change set (inserted, updated and deleted rows) is appended with the number
of its run; nothing is ever rewritten.  The list of runs is an aggregation of the log,
the table at a run is the newest change of every key up to it.  One append is one
job, so a run is seen whole or not at all, and storage grows with the changes.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .state import (CHANGE, COMPRESSION, DELETE, INSERT, KEEP, UPDATE, _buckets, _names, latest_per_key, read_by_key,
                    write_by_key)

RUN, COMMITTED_AT = "_run", "_committed_at"
BY = "_by"  # how a run was bucketed: the buckets and the key, the same in all of its rows


def _log(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(base)
    except AnalysisException:
        return None


def runs(spark: SparkSession, base: str) -> DataFrame:
    """``(run, committed_at, inserted, updated, deleted)`` of every run, by aggregation."""
    log = _log(spark, base)
    if log is None:
        return spark.createDataFrame([], "run int, committed_at timestamp_ntz, inserted bigint, updated bigint, "
                                         "deleted bigint")
    kinds = [F.count_if(F.col(CHANGE) == kind).alias(name)
             for kind, name in ((INSERT, "inserted"), (UPDATE, "updated"), (DELETE, "deleted"))]
    return log.groupBy(F.col(RUN).alias("run")).agg(F.max(COMMITTED_AT).alias("committed_at"), *kinds)


def latest_run(spark: SparkSession, base: str) -> int | None:
    """The newest run; its number is a folder name, no row is read for it."""
    log = _log(spark, base)
    return None if log is None else log.select(F.max(RUN)).first()[0]


def append(tagged: DataFrame, base: str, committed_at: datetime, key: Sequence[str] = (),
           near: Sequence[str] = ()) -> int | None:
    """Append the changed rows of a merge (an untagged table counts as inserted) as the next
    run; returns its number, or None when nothing changed and nothing was written.  With a ``key``
    the run lies in buckets of it (``near``: see ``state.write_by_key``), which suits merges on that key."""
    spark = tagged.sparkSession
    if CHANGE not in tagged.columns:
        tagged = tagged.withColumn(CHANGE, F.lit(INSERT))
    last = latest_run(spark, base)
    number = 0 if last is None else last + 1
    # written straight into the run's folder: a merge that reads the log listed its files before,
    # and rows without a change make no folder
    rows = tagged.where(F.col(CHANGE) != KEEP).withColumn(COMMITTED_AT, F.lit(committed_at).cast("timestamp_ntz"))
    if key:
        n = _buckets(spark)
        by = rows.withColumn(BY, F.lit(f"{n} {','.join(_names(key))}"))
        write_by_key(by, f"{base}/{RUN}={number}", key, n, near)
    else:
        (rows.withColumn(RUN, F.lit(number)).write.mode("append").option("compression", COMPRESSION)
         .partitionBy(RUN).parquet(base))
    return number if latest_run(spark, base) == number else None


def _only_run(log: DataFrame, base: str, key: Sequence[str]) -> DataFrame | None:
    """The log when it is one run in buckets of the key."""
    if BY not in log.columns:
        return None
    found = log.select(RUN, BY).distinct().limit(2).collect()
    buckets, _, by = ((found[0][BY] or "") if len(found) == 1 else "").partition(" ")
    if by != ",".join(key):
        return None
    run = found[0][RUN]
    return read_by_key(log.sparkSession, f"{base}/{RUN}={run}", key, int(buckets)).withColumn(RUN, F.lit(run))


def at_run(spark: SparkSession, base: str, key: Sequence[str], run: int | None = None,
           whole: bool = False) -> DataFrame:
    """The table after ``run`` (default: the newest): per key its newest change up to then.
    Later runs are folders that are not read.  A first run in buckets of the key is not
    shuffled; ``whole``: see ``latest_per_key``."""
    log = _log(spark, base)
    if log is None:
        raise ValueError(f"no run below {base}")
    if run is not None:
        log = log.where(F.col(RUN) <= run)
    only = _only_run(log, base, _names(key))
    newest = latest_per_key(log, key, [RUN], whole) if only is None else latest_per_key(only, key, [RUN])
    return newest.where(F.col(CHANGE) != DELETE).drop(CHANGE, RUN, COMMITTED_AT, BY)
