"""Session helpers.

Library code never creates a session.  ``local_session`` exists for tests
and the bench only; ``shared_dir`` resolves the cluster-wide folder named by
``spark.checkpoint.dir`` (the only place this engine writes intermediate or
versioned state).  When it is unset, a local session gets a private folder and
a cluster session is refused: executors could not see each other's files there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
BROADCAST_BYTES = 1 << 20


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "obsengine") -> SparkSession:
    """A local session configured like the target cluster (AQE on, UTC)."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only sides proven tiny (planner statistics / AQE runtime
        # size under 1 MB); everything larger is a shuffled join, which is the
        # plan every fact-to-dimension join takes at cluster scale anyway.
        .config("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", os.environ.get("OBSENGINE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All engine timestamps are UTC instants; text renderings assume it.  Of
    repeated keys of a JSON object the last one counts."""
    if spark.conf.get(DUPLICATE_KEYS, None) != "true":
        spark.conf.set(DUPLICATE_KEYS, "true")
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (set one only when unset)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        configured = current
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="obsengine-checkpoint-")
        spark.sparkContext.setCheckpointDir(configured)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder for one run."""
    return f"{shared_dir(spark)}/obsengine/{name}-{uuid.uuid4().hex}"
