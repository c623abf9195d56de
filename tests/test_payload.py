"""Payload parsing: fixture documents and malformed envelopes."""
import hashlib

from pyspark.sql import functions as F

from conftest import fixture_bytes, payloads, t
from obsengine.session import ensure_utc
from obsengine.sources import payload

GOLDEN_KEY = "51e0478cec43aff18ea2660ad01da6182cf714e14ff1fcfd85addd42bea00825"


def parse(spark, items, **kw):
    return payload.parse(payloads(spark, items), keep_pos=True, **kw)


def test_v1_is_typed_and_keyed(spark):
    rows = parse(spark, [("v1.json", t(10), fixture_bytes("v1"))]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.quality_status == "valid" and r.quality_reason is None
    assert r.flight_instance_key == GOLDEN_KEY
    assert (r.flight_iata, r.departure_airport_iata, r.arrival_airport_iata) == ("FV7204", "OSL", "BGO")
    assert r.scheduled_departure_at.isoformat() == "2026-09-03T09:30:00"
    assert (r.delay_minutes, r.is_delayed, r.flight_status) == (33, True, "landed")
    assert r.airline_name == "Fjordvinge" and r.aircraft_type is None
    assert r.source_file == "v1.json" and r.payload_sha256 == hashlib.sha256(fixture_bytes("v1")).hexdigest()


def test_late_correction_same_key(spark):
    rows = parse(spark, [("v1", t(10), fixture_bytes("v1")),
                         ("late", t(11), fixture_bytes("late_correction"))]).orderBy("observed_at").collect()
    assert rows[0].flight_instance_key == rows[1].flight_instance_key
    assert [r.delay_minutes for r in rows] == [33, 52]


def test_additive_field_seen_with_value(spark):
    df = parse(spark, [("v1", t(10), fixture_bytes("v1")), ("v2", t(11), fixture_bytes("v2_additive"))])
    assert payload.saw_additive(df).first()["saw"] is True
    got = {r.source_file: r.aircraft_type for r in df.collect()}
    assert got == {"v1": None, "v2": "e195-e2"}
    v1_only = parse(spark, [("v1", t(10), fixture_bytes("v1"))])
    assert payload.saw_additive(v1_only).first()["saw"] is False


def test_key_with_null_value_counts_as_seen(spark):
    body = b'{"data":[{"aircraft_type":null}]}'
    recs = payload.explode_records(payload.decode(payloads(spark, [("p", t(1), body)])))
    assert payload.saw_field(recs, "aircraft_type").first()["saw"] is True


def test_bad_key_and_negative_delay_both_reported(spark):
    doc = fixture_bytes("v1").replace(b'"iata": "FV7204"', b'"iata": null').replace(b'"delay": 33', b'"delay": -1')
    r = parse(spark, [("bad", t(10), doc)]).first()
    assert r.quality_status == "quarantined"
    assert r.quality_reason == "missing flight.iata; negative delay"
    assert r.flight_instance_key == f"quarantine:{hashlib.sha256(doc).hexdigest()}:0"
    assert r.departure_airport_iata == "OSL"  # parsed fields are kept


def test_invalid_json_is_one_quarantined_row(spark):
    r = parse(spark, [("x", t(1), b"not-json")]).collect()
    assert len(r) == 1 and r[0].quality_reason == payload.NOT_JSON and r[0].pos == 0


def test_invalid_utf8_is_not_json(spark):
    r = parse(spark, [("x", t(1), b'{"data":["\xff"]}')]).collect()
    assert [x.quality_reason for x in r] == [payload.NOT_JSON]


def test_envelopes(spark):
    items = [
        ("missing", t(1), b'{"pagination":{}}'),
        ("null", t(1), b'{"data":null}'),
        ("object", t(1), b'{"data":{"a":1}}'),
        ("list_doc", t(1), b'[{"data":[]}]'),
        ("scalar", t(1), b'"data"'),
        ("empty", t(1), b'{"data":[]}'),
        ("mixed", t(1), b'{"data":[1,null,{"flight":{"iata":"X1"}}]}'),
    ]
    rows = parse(spark, items).select("source_file", "pos", "quality_reason").collect()
    got = sorted((r.source_file, r.pos, r.quality_reason) for r in rows)
    na, no = payload.NOT_ARRAY, payload.NOT_OBJECT
    assert got == sorted([
        ("missing", 0, na), ("null", 0, na), ("object", 0, na), ("list_doc", 0, na), ("scalar", 0, na),
        ("mixed", 0, no), ("mixed", 1, no),
        ("mixed", 2, "missing departure.iata; missing departure.scheduled"),
    ])


def test_unparsable_scheduled_gives_missing_and_invalid(spark):
    body = b'{"data":[{"flight":{"iata":"X1"},"departure":{"iata":"AAA","scheduled":"2026-08-20T14:00:00"}}]}'
    r = parse(spark, [("p", t(1), body)]).first()
    assert r.quality_reason == "missing departure.scheduled; invalid departure.scheduled"


def test_identical_bad_payload_collapses(spark):
    from obsengine.plans import pipeline
    df = parse(spark, [("a", t(1), b"oops"), ("a", t(2), b"oops")]).drop("pos")
    assert pipeline.silver(payload.observations(df)).count() == 1


def test_byte_order_mark_and_repeated_keys_are_read(spark):
    ensure_utc(spark)
    plain = fixture_bytes("v1")
    twice = plain.replace(b'"data":', b'"data": 1, "data":', 1)
    rows = parse(spark, [("bom", t(10), b"\xef\xbb\xbf" + plain), ("twice", t(10), twice)]).collect()
    assert [r.flight_instance_key for r in rows] == [GOLDEN_KEY] * 2


def test_timestamp_with_a_trailing_newline_is_invalid(spark):
    doc = fixture_bytes("v1").replace(b"11:30:00+02:00", b"11:30:00+02:00\\n")
    r = parse(spark, [("nl", t(10), doc)]).first()
    assert r.quality_status == "quarantined" and r.scheduled_departure_at is None


def test_bodies_in_every_encoding_of_json(spark):
    from obsengine.functions import variant
    text = '{"data":[{"name":"Å 🎉"}]}'
    codecs = ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be"]
    marked = [b"\xfe\xff" + text.encode("utf-16-be"), b"\x00\x00\xfe\xff" + text.encode("utf-32-be")]
    good = [text.encode(c) for c in codecs] + marked
    bad = [text.encode("utf-16-le")[:-1], b"\xff", '["'.encode("utf-16-le") + b"\x00\xd8" + '"]'.encode("utf-16-le"),
           '["'.encode("utf-16-be") + b"\xdc\x00" + '"]'.encode("utf-16-be"),
           "[".encode("utf-32-le") + b"\x00\x00\x11\x00"]
    short = [b"", b"1", b"1\x00", b"\x001", b"[]"]
    rows = [(i, bytearray(b)) for i, b in enumerate([*good, *bad, *short])] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, body binary").select("i", variant.body_text(F.col("body")).alias("t"))
    got = {r.i: r.t for r in df.collect()}
    assert [got[i] for i in range(len(good))] == [text] * len(good)
    assert [got[len(good) + i] for i in range(len(bad))] == [None] * len(bad)
    assert [got[len(good) + len(bad) + i] for i in range(5)] == ["", "1", "1", "1", "[]"] and got[99] is None
