"""Keyed current state: newest-wins, change-detecting upserts, as-of reads.

State is a DataFrame; every operator returns the *next* state as a DataFrame
(old state + changes → new state), so it composes with any storage layer.
Upserts tag each output row in ``_change`` (insert / update / keep / delete)
so callers can count changes and skip publishing a no-op in the same pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import pack_digest, unpack_digest
from ..functions.text import joined, parted

CHANGE = "_change"
INSERT, UPDATE, KEEP, DELETE = "insert", "update", "keep", "delete"
COMPRESSION = "zstd"  # of own tables: hex digests take half the room


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   whole: bool = False) -> DataFrame:
    """One row per key: the greatest ``order`` tuple (all descending).

    ``row_number() = 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so a hot key is cut to one row per map
    task before anything moves (map-side combine for top-1).  Who needs ``whole`` rows
    has them shuffled folded; columns that nobody reads are then shuffled too.
    """
    w = Window.partitionBy(*_names(key)).orderBy(*[F.col(c).desc() for c in order])
    apart = [*_names(key), *order]
    rows = folded(df, apart) if whole else df
    latest = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return unfolded(latest, df, apart) if whole else latest


TEXTS = "_texts"


def _foldable(df: DataFrame, apart: Sequence[str]) -> tuple[list[str], list[str]]:
    """Text columns and instants besides ``apart``."""
    rest = [(c, t) for c, t in df.dtypes if c not in apart]
    return [c for c, t in rest if t == "string"], [c for c, t in rest if t == "timestamp_ntz"]


def _origin(instants: Sequence[str]) -> Column:
    return F.coalesce(instants[0], F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def folded(df: DataFrame, apart: Sequence[str]) -> DataFrame:
    """Rows as they are shuffled: a row's slots of fixed width and the padding of its texts take
    more room than what they hold, so the text columns become one, and instants after the first
    their distance from it, mostly small numbers.  The columns ``apart`` stay.  Nothing is lost."""
    texts, instants = _foldable(df, apart)
    rows = df.withColumns({c: F.col(c) - _origin(instants) for c in instants[1:]})
    return rows.withColumn(TEXTS, joined([F.col(c) for c in texts])).drop(*texts) if texts else rows


def unfolded(rows: DataFrame, like: DataFrame, apart: Sequence[str]) -> DataFrame:
    """The rows of ``folded``, with the columns of ``like``."""
    texts, instants = _foldable(like, apart)
    values = dict(zip(texts, parted(F.col(TEXTS), len(texts)))) | {c: F.col(c) + _origin(instants) for c in instants[1:]}
    return rows.select(*[values.get(c, F.col(c)).alias(c) for c in like.columns])


def _surely_empty(df: DataFrame) -> bool:
    """Whether the planner can tell that there is no row."""
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    return most.isDefined() and most.get() == 0


def packed(df: DataFrame, digests: Sequence[str]) -> DataFrame:
    """Hex digest columns as bytes: half as long in shuffles and sorts.  Packed ones stay."""
    return df.withColumns({c: pack_digest(F.col(c)) for c, t in df.dtypes if c in digests and t == "string"})


def unpacked(df: DataFrame, digests: Sequence[str]) -> DataFrame:
    """Digest columns as text again."""
    return df.withColumns({c: unpack_digest(F.col(c)) for c, t in df.dtypes if c in digests and t == "binary"})


def _fits_broadcast(written: DataFrame) -> bool:
    """Whether the planner would broadcast a written table."""
    size = written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = written.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit


def _greater(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Lexicographic ``left > right`` over non-null columns."""
    return F.struct(*left) > F.struct(*right)


def upsert_latest(state: DataFrame, stage: DataFrame, key: str | Sequence[str],
                  order: Sequence[str], backfill: Sequence[str] = (),
                  stage_written: bool = False, stage_is_latest: bool = False, whole: bool = False,
                  keep: bool = True) -> DataFrame:
    """Monotone newest-wins upsert (never deletes).

    The stage is first reduced to its latest row per key.  A stage row
    replaces the state row when its ``order`` tuple is strictly greater, or
    equal while one of the ``backfill`` columns is NULL in state and set in
    the stage; a new key is inserted; older arrivals are ignored.  Without
    back-fill this is associative and commutative over batches, so replays
    and out-of-order batches give the same state.

    Plans: by default a full outer join on the key (both sides shuffled —
    right when the stage is as large as the state).  With ``stage_written``
    (the stage is a written table, see ``upsert_latest_sized``) the state is
    probed with a left join and new keys come from an anti join; the planner
    knows the table's real size and broadcasts it only below its own limit.
    A state that the planner knows to be empty is not joined, so the result keeps
    the stage's partitioning.  ``whole``: see ``latest_per_key``.  Without ``keep``
    the rows that stay as they are do not come along, and little of the state is read.
    """
    keys = _names(key)
    cols = [c for c in state.columns if c != CHANGE]
    stage = stage.select(*cols)
    if not stage_is_latest:
        stage = latest_per_key(stage, keys, order, whole)
    if _surely_empty(state):
        return stage.withColumn(CHANGE, F.lit(INSERT))
    if not keep:
        return stage_changes(state, stage, keys, order, backfill)
    s = stage.withColumn("_in_s", F.lit(True))
    t = state.select(*cols).withColumn("_in_t", F.lit(True)).alias("t")
    s = s.alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    t_ord = [F.col(f"t.{c}") for c in order]
    s_ord = [F.col(f"s.{c}") for c in order]
    fill = F.lit(False)
    for c in backfill:
        fill = fill | (F.col(f"t.{c}").isNull() & F.col(f"s.{c}").isNotNull())
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    newer = in_s & (_greater(s_ord, t_ord) | ((F.struct(*s_ord) == F.struct(*t_ord)) & fill))
    take_s = ~in_t | newer
    tag = F.when(~in_t, F.lit(INSERT)).when(take_s, F.lit(UPDATE)).otherwise(F.lit(KEEP))
    # both sides' keys are equal where they meet; coalesce keeps the partitioning of the only side left
    pick = [(F.coalesce(f"t.{c}", f"s.{c}") if c in keys else
             F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))).alias(c) for c in cols]
    if not stage_written:
        return t.join(s, cond, "full_outer").select(*pick, tag.alias(CHANGE))
    probed = t.join(s, cond, "left").select(*pick, tag.alias(CHANGE))
    # new keys: stage keys absent from the state (key-only scan)
    existing = state.select(*keys).join(stage.select(*keys), keys, "left_semi")
    inserted = stage.join(existing, keys, "left_anti").select(*cols, F.lit(INSERT).alias(CHANGE))
    return probed.unionByName(inserted)


def upsert_latest_sized(state: DataFrame, stage: DataFrame, key: str | Sequence[str],
                        order: Sequence[str], backfill: Sequence[str] = (),
                        written: bool = False, whole: bool = False) -> DataFrame:
    """``upsert_latest`` for a short window: the latest stage is written once to the shared
    folder, unless it comes from a table of its own (``written``).  One below the planner's
    limit is broadcast to the state; a larger one meets it in one full outer join, which works
    the state out once."""
    keys = _names(key)
    cols = [c for c in state.columns if c != CHANGE]
    latest = latest_per_key(stage.select(*cols), keys, order, whole)
    latest = latest if written else materialize(latest)
    return upsert_latest(state, latest, keys, order, backfill, stage_written=_fits_broadcast(latest),
                         stage_is_latest=True)


def stage_changes(state: DataFrame, stage: DataFrame, key: str | Sequence[str], order: Sequence[str],
                  backfill: Sequence[str] = ()) -> DataFrame:
    """The rows that ``upsert_latest`` of a written latest stage inserts or updates (tagged).
    A changed row is the stage's row, so of the state only keys, order and missing labels are
    read; under a stage small enough to broadcast, only those of its keys are shuffled."""
    keys = _names(key)
    known = state.select(*keys, F.struct(*order).alias("_known"),
                         *[F.col(c).isNull().alias(f"_no_{c}") for c in backfill])
    if _fits_broadcast(stage):
        known = known.join(stage.select(*keys), keys, "left_semi")
    fill = reduce(lambda a, b: a | b, [F.col(f"_no_{c}") & F.col(c).isNotNull() for c in backfill], F.lit(False))
    # the key's names repeat on both sides: the state's are dropped by the join
    new, now = F.col("_known").isNull(), F.struct(*[F.col(c) for c in order])
    newer = _greater([F.col(c) for c in order], [F.col(f"_known.{c}") for c in order])
    same = now == F.struct(*[F.col(f"_known.{c}").alias(c) for c in order])
    return (stage.join(known, keys, "left").where(new | newer | (same & fill))
            .select(*stage.columns, F.when(new, INSERT).otherwise(UPDATE).alias(CHANGE)))


def upsert_changed(state: DataFrame, stage: DataFrame, key: str | Sequence[str],
                   measures: Sequence[str], keep_missing: bool = True) -> DataFrame:
    """Change-detecting upsert: update a key when any measure differs
    null-safely, insert new keys; keys absent from the stage are kept
    (``keep_missing``) or tagged ``delete`` and dropped."""
    keys = _names(key)
    cols = [c for c in state.columns if c != CHANGE]
    t = state.select(*cols).withColumn("_in_t", F.lit(True)).alias("t")
    s = stage.select(*cols).withColumn("_in_s", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"t.{m}").eqNullSafe(F.col(f"s.{m}")) for m in measures])
    tag = (F.when(~in_t, F.lit(INSERT)).when(~in_s, F.lit(KEEP if keep_missing else DELETE))
           .when(same, F.lit(KEEP)).otherwise(F.lit(UPDATE)))
    out = j.select(*[F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                     for c in cols], tag.alias(CHANGE))
    return out if keep_missing else out.where(F.col(CHANGE) != F.lit(DELETE))


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as parquet under the cluster's shared checkpoint
    folder and read it back: lineage is cut, several consumers read files
    instead of recomputing the plan, and a lost executor re-reads files.
    (One columnar write; a reliable RDD checkpoint would compute twice.)"""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_by_key(df: DataFrame, key: str | Sequence[str], name: str = "by-key") -> DataFrame:
    """``materialize`` bucketed by key: later merges on the key shuffle nothing of it.  Meant for
    the result of a step on the key, whose tasks hold whole buckets, so each is one file.  The
    catalog is only needed to read buckets and forgets the table; its files stay."""
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    _bucketed(df, path, key, _buckets(spark)).saveAsTable(table)
    return _taken(spark, table)


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucketed(df: DataFrame, path: str, key: str | Sequence[str], buckets: int):
    return (df.write.format("parquet").option("path", path).option("compression", COMPRESSION)
            .bucketBy(buckets, *_names(key)))


def _taken(spark, table: str) -> DataFrame:
    """A table whose files stay when the catalog forgets it."""
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def write_by_key(df: DataFrame, folder: str, key: str | Sequence[str], buckets: int, near: Sequence[str] = ()) -> None:
    """Write a folder in buckets of the key; inside of one, rows with like values of ``near`` lie
    together, which packs better.  No row makes no file."""
    table = f"by_key_{uuid.uuid4().hex}"
    writer = _bucketed(df, folder, key, buckets).mode("overwrite")
    (writer.sortBy(*near) if near else writer).saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")


def read_by_key(spark, folder: str, key: str | Sequence[str], buckets: int) -> DataFrame:
    """A folder of ``write_by_key``: steps on the key shuffle nothing of it."""
    table = f"by_key_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in spark.read.parquet(folder).dtypes)
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet "
              f"CLUSTERED BY ({', '.join(f'`{k}`' for k in _names(key))}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return _taken(spark, table)


def current(tagged: DataFrame) -> DataFrame:
    """Drop the change tag (and deleted rows) → plain state."""
    if CHANGE not in tagged.columns:
        return tagged
    return tagged.where(F.col(CHANGE) != F.lit(DELETE)).drop(CHANGE)


def describe(df: DataFrame) -> DataFrame:
    """``(col_name, data_type, nullable)`` of a table, like ``DESCRIBE``
    (schema metadata only; no data is read)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name string, data_type string, nullable boolean")


def merge_metrics(tagged: DataFrame) -> DataFrame:
    """``(_change, rows)``: how many rows each upsert branch produced."""
    return tagged.groupBy(CHANGE).agg(F.count(F.lit(1)).alias("rows"))


def has_changes(tagged: DataFrame) -> bool:
    """True when any row was inserted / updated / deleted (one small job)."""
    return not tagged.where(F.col(CHANGE) != F.lit(KEEP)).isEmpty()


def evolve(state: DataFrame, stage: DataFrame, allowed: Sequence[T.StructField],
           saw: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Additive schema evolution.

    An ``allowed`` column missing from the state is added (old rows NULL) when
    the stage carries it (``saw`` overrides the test, e.g. from
    ``payload.saw_field``); once in the state it takes part in every later
    merge (a stage without it writes NULL).  Returns ``(state, stage)`` with
    identical column lists.
    """
    state_cols = set(state.columns)
    for f in allowed:
        present = saw if saw is not None else f.name in stage.columns
        if f.name not in state_cols and present:
            state = state.withColumn(f.name, F.lit(None).cast(f.dataType))
            state_cols.add(f.name)
    for f in allowed:
        if f.name in state_cols and f.name not in stage.columns:
            stage = stage.withColumn(f.name, F.lit(None).cast(f.dataType))
    cols = [c for c in state.columns if c != CHANGE]
    return state.select(*cols), stage.select(*cols)


def as_of(log: DataFrame, ts, key: str | Sequence[str], order: Sequence[str],
          time_col: str = "observed_at") -> DataFrame:
    """State as of instant ``ts``: replay the observation log up to ``ts``."""
    return latest_per_key(log.where(F.col(time_col) <= F.lit(ts)), key, order)


def diff(old: DataFrame, new: DataFrame, key: str | Sequence[str],
         compare: Sequence[str]) -> DataFrame:
    """Rows whose ``compare`` columns differ between two states.

    Output: key, ``diff`` (added / removed / changed), ``old_<c>``, ``new_<c>``.
    """
    keys = _names(key)
    o = old.select(*keys, *compare, F.lit(True).alias("_o"))
    n = new.select(*keys, *compare, F.lit(True).alias("_n"))
    o = o.select(*keys, "_o", *[F.col(c).alias(f"old_{c}") for c in compare])
    n = n.select(*keys, "_n", *[F.col(c).alias(f"new_{c}") for c in compare])
    j = o.join(n, keys, "full_outer")
    same = reduce(lambda a, b: a & b,
                  [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in compare])
    kind = (F.when(F.col("_o").isNull(), F.lit("added"))
            .when(F.col("_n").isNull(), F.lit("removed"))
            .when(~same, F.lit("changed")))
    return (j.withColumn("diff", kind).where(F.col("diff").isNotNull())
            .select(*keys, "diff", *[f"old_{c}" for c in compare], *[f"new_{c}" for c in compare]))
