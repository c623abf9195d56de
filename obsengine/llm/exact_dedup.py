"""Exact dedup: stateful streaming deduplication with full-byte checks.

Files arrive as a stream.  The keyed state (RocksDB on the executors' disks,
snapshots in the shared checkpoint folder, no expiry) holds per SHA-256 digest
the number of rows, the stable id of the row to keep (largest id) and its
content locator (the file that holds it).  A later call with the same
``checkpoint`` continues from that state.

A digest seen twice is a hit: the whole texts of hits are grouped by their
bytes, so texts that share a digest by accident stay apart.  Digests seen once
need no check.  Everything is planned by Catalyst; the driver only starts
queries.

Hot groups: copies are combined before each shuffle (partial aggregation), of
digests as of whole texts, so a text that makes up a third of all rows costs one
row per map task; the joins carry ids and digests, never texts, and no grouping
needs the rows of the last one in one place, so adaptive execution may split it.

Defined cases: a null text counts as empty; a null id never wins over an id,
and is not kept if its group has an id; rows that repeat an id with the same
text are one document and marked alike; an empty table gives no rows; other
columns are not read; a file older than those read before counts, and a text that is
missing from the state, as of a file changed in place, fails the query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm.common import body, written
from obsengine.session import scratch_path

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stores are many and small: no space is set aside for their logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


#: A hundred years.
MAX_FILE_AGE = "36500d"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = body(text_col)
    return df.select(F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest"))


def digest_state(spark: SparkSession, path: str, id_col: str, text_col: str,
                 digest: Callable[[Column], Column], checkpoint: str) -> DataFrame:
    """Drain the folder through the stateful query; the newest state per digest."""
    schema = spark.read.parquet(path).select(id_col, text_col).schema
    # A pattern that fits the path alone: a stream reads a folder or, by pattern, one file.
    # However old a file is beside the newest one, it counts: the state does not expire either.
    stream = (spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
              .parquet(f"{path[:-1]}[{path[-1]}]"))
    keyed = (stream.select(F.col(id_col).alias("id"), digest(body(text_col)).alias("digest"),
                           F.col("_metadata.file_path").alias("locator"))
             .groupBy("digest")
             .agg(F.max(F.struct("id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("n")))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{checkpoint}/updates/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (keyed.writeStream.outputMode("update").foreachBatch(store)
                 .option("checkpointLocation", f"{checkpoint}/query")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    updates = spark.createDataFrame([], keyed.schema)
    if query.lastProgress is not None or query.recentProgress:
        updates = spark.read.schema(keyed.schema).parquet(f"{checkpoint}/updates")
    # The count and the keeper of a digest only grow, so the newest update is the largest.
    return updates.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("n").alias("n"))


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256,
                checkpoint: str | None = None) -> DataFrame:
    """``id_col, keep_id, group_size, kept, digest`` per row of the files in ``path``."""
    checkpoint = checkpoint or scratch_path(spark, "exact-dedup")
    state = written(digest_state(spark, path, id_col, text_col, digest, checkpoint), "digests")
    docs = _rows(spark.read.parquet(path), id_col, text_col, digest)

    # Hits: whole texts grouped by their bytes, before they meet the state, so that copies
    # are combined in the map tasks and the joins carry digests alone.
    hits = state.where("n > 1").select("digest")
    distinct_texts = docs.select("digest", "text").distinct().select("digest")
    clashes = written(distinct_texts.join(hits, "digest", "left_semi").groupBy("digest")
                      .agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "digest-clashes")

    def result(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            "digest")

    plain = state.select("digest", F.col("keeper.id").alias("keep_id"),
                         F.col("n").alias("group_size"))
    # A text that the stream has not read (a file changed in place) fails the query.
    missing = F.raise_error(F.lit("a text of the folder is missing from the state")).cast("long")
    known = (docs.select("id", "digest").join(plain, "digest", "left")
             .withColumn("group_size", F.coalesce("group_size", missing)))
    if clashes.isEmpty():
        return result(known)
    text_key = F.sha2(F.concat(F.lit("\x01"), "text"), 512)
    classes = (docs.groupBy("digest", "text")
               .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .join(clashes.select("digest"), "digest", "left_semi")
               .select(text_key.alias("text_key"), "digest", "keep_id", "group_size"))
    mixed = docs.join(clashes.select("digest"), "digest", "left_semi").select(
        "id", "digest", text_key.alias("text_key"))
    return result(known.join(clashes, "digest", "left_anti")).unionByName(
        result(mixed.join(classes, ["digest", "text_key"])))
