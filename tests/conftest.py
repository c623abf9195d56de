import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]").appName("obsengine-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


PAYLOAD_SCHEMA = T.StructType([
    T.StructField("object_path", T.StringType(), False),
    T.StructField("observed_at", T.TimestampNTZType(), False),
    T.StructField("payload_sha256", T.StringType(), False),
    T.StructField("body", T.BinaryType(), True),
])


def fixture_bytes(name: str) -> bytes:
    with open(os.path.join(FIXTURES, f"flights_{name}.json"), "rb") as f:
        return f.read()


def payloads(spark, items):
    """items: [(path, observed_at datetime, body bytes)] → payload DataFrame."""
    import hashlib
    rows = [(p, ts, hashlib.sha256(b).hexdigest(), bytearray(b)) for p, ts, b in items]
    return spark.createDataFrame(rows, PAYLOAD_SCHEMA)


def t(h: int, d: int = 22) -> datetime:
    return datetime(2026, 8, d, h, 0, 0)
