"""Stream landed payload files into the partitioned silver state.

``readStream.format("binaryFile")`` picks up new landed files; each
micro-batch runs the same DataFrame step as the batch pipeline
(parse → evolve → newest-wins upsert, as ``pipeline.merge_payloads_into``)
inside ``foreachBatch``; only the state partitions the batch touches are
read and rewritten, and nothing is written when nothing changed.
The upsert is order-free and idempotent, so a replayed micro-batch, a new
checkpoint or a second stream into the same state changes nothing twice and
skips nothing.  Stream progress lives beside the state by default.

With a gold folder, each micro-batch goes on to the stored gold tables
(``gold_store.run``): the state's rows of the batch's keys become images before and
after and so signed sums added to the stored rollups.  A correction may come any time
later, so no watermark closes an hour and no streaming state is kept: the rollups
themselves are the state, and a batch touches only the partitions it falls in.
All keys of the batch are handed over, changed in silver or not, so a batch that
broke off between silver and gold brings its rows when it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import partitions
from ..plans import gold_store, pipeline
from ..session import ensure_utc

# Fixed schema of Spark's binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def landed_payloads(spark: SparkSession, landing_dir: str, pattern: str = "*.json",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming payload DataFrame ``(object_path, observed_at,
    payload_sha256, body)``; the file's modification time is its ingestion
    instant (UTC)."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(landing_dir)
    return files.select(
        F.col("path").alias("object_path"),
        F.col("modificationTime").cast("timestamp_ntz").alias("observed_at"),
        F.sha2("content", 256).alias("payload_sha256"),
        F.col("content").alias("body"),
    )


def _merge_batch(base: str, gold: str | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        stage = pipeline.latest_stage(pipeline.window_observations(batch))
        pipeline.merge_stage(base, stage)
        rows = pipeline.state_of_keys(base, stage) if gold else None
        if rows is not None:
            gold_store.run(rows, gold)
    return run


def start_silver_stream(spark: SparkSession, landing_dir: str, base: str,
                        checkpoint: str | None = None, available_now: bool = True,
                        processing_time: str | None = None, gold: str | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the landing → silver stream.  ``available_now`` processes what
    is there and stops (scheduled runs); otherwise a processing-time trigger.
    With ``gold`` the fact, dimensions and rollups stored there follow each batch."""
    ensure_utc(spark)
    ckpt = checkpoint or f"{base.rstrip('/')}_stream"
    writer = (landed_payloads(spark, landing_dir, max_files_per_trigger=max_files_per_trigger).writeStream
              .foreachBatch(_merge_batch(base, gold)).option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def current_state(spark: SparkSession, base: str) -> DataFrame:
    """The silver state (all partitions)."""
    return partitions.read(spark, base)
