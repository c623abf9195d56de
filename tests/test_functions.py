"""Column functions: codes, labels, strict timestamps, delay, keys."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from obsengine.functions import keys, numbers, text, time

GOLDEN_KEY = "1203e18b2212aafb8dee8d21e3da19a6da9f21d4df90f88eae023b8c81b18035"


def one(spark, expr_col, json_text):
    df = spark.createDataFrame([(json_text,)], "j string").select(F.parse_json("j").alias("v"))
    return df.select(expr_col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, upper, expected", [
    ('" jfk "', True, "JFK"), ('"\\tlax\\n"', True, "LAX"), ('"   "', True, None),
    ('101', True, None), ('null', True, None), ('"LANDED "', False, "landed"),
    ('"\\u00a0ea\\u2003"', True, "EA"),
])
def test_code(spark, raw, upper, expected):
    assert one(spark, lambda v: text.code(v, upper), raw) == expected


@pytest.mark.parametrize("raw, expected", [
    ('" Example Air "', "Example Air"), ('""', None), ('12', None), ('"x Y"', "x Y")])
def test_label(spark, raw, expected):
    assert one(spark, text.label, raw) == expected


@pytest.mark.parametrize("raw, value, error", [
    ('"2026-08-20T14:00:00+00:00"', datetime(2026, 8, 20, 14), None),
    ('"2026-08-20T14:00:00Z"', datetime(2026, 8, 20, 14), None),
    ('"2026-08-20T14:00:00-05:30"', datetime(2026, 8, 20, 19, 30), None),
    ('"2026-08-20 14:00:00.123456+00:00"', datetime(2026, 8, 20, 14, 0, 0, 123456), None),
    ('"2026-08-20T14:00+00:00"', datetime(2026, 8, 20, 14), None),
    ('"2026-08-20T14:00:00"', None, "invalid f"),       # naive
    ('"2026-08-20"', None, "invalid f"),                # date only
    ('" 2026-08-20T14:00:00Z"', None, "invalid f"),     # padded
    ('"2026-08-20T14:00:00 Europe/Paris"', None, "invalid f"),
    ('1755698400', None, "invalid f"),                  # not a string
    ('null', None, None),
])
def test_strict_timestamp(spark, raw, value, error):
    r = one(spark, lambda v: time.strict_timestamp(v, "f"), raw)
    assert (r["value"], r["error"]) == (value, error)


def delay(spark, arrival, departure="null"):
    df = spark.createDataFrame([(arrival, departure)], "a string, d string").select(
        F.parse_json("a").alias("a"), F.parse_json("d").alias("d"))
    r = df.select(numbers.delay_minutes(F.col("a"), F.col("d")).alias("r")).first()["r"]
    return r["value"], r["error"]


@pytest.mark.parametrize("arrival, expected", [
    ("27", (27, None)), ("27.0", (27, None)), ('" 27 "', (27, None)), ('"27"', (27, None)),
    ("0", (0, None)), ("27.5", (None, "invalid delay")), ('"27.0"', (None, "invalid delay")),
    ('"+27"', (None, "invalid delay")), ('"027"', (None, "invalid delay")),
    ("true", (None, "invalid delay")), ("[]", (None, "invalid delay")),
    ("99999999999", (None, "invalid delay")), ("-1", (None, "negative delay")),
    ("-5.0", (None, "negative delay")), ("null", (None, None)),
])
def test_delay_rules(spark, arrival, expected):
    assert delay(spark, arrival) == expected


def test_delay_falls_back_only_when_arrival_missing(spark):
    assert delay(spark, "null", "24") == (24, None)
    assert delay(spark, '"bad"', "24") == (None, "invalid delay")


def test_delayed_flag(spark):
    df = spark.createDataFrame([(15,), (16,), (None,)], "d int")
    got = [r[0] for r in df.select(numbers.is_delayed(F.col("d"))).collect()]
    assert got == [False, True, None]


def test_instance_key_golden(spark):
    df = spark.createDataFrame([("ea101", "jfk", datetime(2026, 8, 20, 14))],
                               "f string, d string, s timestamp_ntz")
    assert df.select(keys.instance_key(F.col("f"), F.col("d"), F.col("s"))).first()[0] == GOLDEN_KEY


def test_iso_fraction_only_when_nonzero(spark):
    df = spark.createDataFrame([(datetime(2026, 8, 20, 14, 0, 0, 500000),), (datetime(2026, 8, 20, 14),)],
                               "s timestamp_ntz")
    got = [r[0] for r in df.select(time.iso_utc(F.col("s"))).collect()]
    assert got == ["2026-08-20T14:00:00.500000+00:00", "2026-08-20T14:00:00+00:00"]


def test_surrogate_key_trims_fraction(spark):
    df = spark.createDataFrame([("EA", datetime(2026, 8, 20, 10, 0, 0, 120000))], "k string, ts timestamp_ntz")
    import hashlib
    want = hashlib.sha256(b"EA|2026-08-20 10:00:00.12").hexdigest()
    assert df.select(keys.surrogate_key(F.col("k"), F.col("ts"))).first()[0] == want
