"""Reject reasons (one row per code), both modes, envelope decoding."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tapflow.operators.validate import dead_letter, valid_taps, with_reject_reason
from tapflow.sources.envelope import envelope_taps

T = dt.datetime(2024, 1, 1, 8)
GOOD_TX = "00000000-0000-4000-8000-000000000001"
SCHEMA = ("transaction_id string, card_id string, bus_id string, event_type string, "
          "event_time timestamp_ntz, latitude double, longitude double")

CASES = [
    ((GOOD_TX, "C001", "BUS-01", "tap_in", T, -6.2, 106.8), None),
    ((None, "C001", "BUS-01", "tap_in", T, -6.2, 106.8), "missing_transaction_id"),
    ((GOOD_TX, None, "BUS-01", "tap_in", T, -6.2, 106.8), "missing_card_id"),
    ((GOOD_TX, "C001", None, "tap_in", T, -6.2, 106.8), "missing_bus_id"),
    ((GOOD_TX, "C001", "BUS-01", "error", T, -6.2, 106.8), "invalid_event_type"),
    ((GOOD_TX, "C001", "BUS-01", None, T, -6.2, 106.8), "invalid_event_type"),
    ((GOOD_TX, "C001", "BUS-01", "tap_in", None, -6.2, 106.8), "missing_timestamp"),
    ((GOOD_TX, "C001", "BUS-01", "tap_in", T, 91.0, 106.8), "invalid_latitude"),
    ((GOOD_TX, "C001", "BUS-01", "tap_in", T, float("nan"), 106.8), "invalid_latitude"),
    ((GOOD_TX, "C001", "BUS-01", "tap_in", T, None, 106.8), "invalid_latitude"),
    ((GOOD_TX, "C001", "BUS-01", "tap_in", T, -6.2, 181.0), "invalid_longitude"),
    (("short-id", "C001", "BUS-01", "tap_in", T, -6.2, 106.8), "malformed_transaction_id"),
    ((GOOD_TX, "C-1", "BUS-01", "tap_in", T, -6.2, 106.8), "malformed_card_id"),
    ((GOOD_TX, "C001", "TRAM-1", "tap_in", T, -6.2, 106.8), "malformed_bus_id"),
]


@pytest.fixture()
def cases(spark):
    return spark.createDataFrame([c[0] for c in CASES], SCHEMA)


def test_reason_per_row(cases):
    got = [r.error_reason for r in with_reject_reason(cases).collect()]
    assert got == [c[1] for c in CASES]


def test_strict_mode_drops_pattern_and_type_failures(cases):
    got = [r.error_reason for r in with_reject_reason(cases, strict_reference=True).collect()]
    assert got == [None, "missing_timestamp", "invalid_latitude", "invalid_latitude",
                   "invalid_latitude", "invalid_longitude"]


def test_good_rows_same_in_both_modes(cases):
    a = valid_taps(cases).collect()
    b = valid_taps(cases, strict_reference=True).collect()
    assert a == b and len(a) == 1


def test_envelope_decode_and_unparseable_payload(spark):
    env = spark.createDataFrame([
        (b"k", b'{"transaction_id":"' + GOOD_TX.encode() + b'","card_id":"C1","bus_id":"BUS-01",'
         b'"event_type":"tap_in","timestamp":1704096000123,"latitude":-6.2,"longitude":106.8}',
         "t", 0, 1, T),
        (b"k", b"not json at all", "t", 0, 2, T),
    ], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp_ntz")
    d = envelope_taps(env)
    rows = d.orderBy("kafka_offset").collect()
    assert rows[0].event_time == dt.datetime(2024, 1, 1, 8, 0, 0, 123000)
    assert rows[0].parsed and not rows[1].parsed
    dl = dead_letter(d).collect()
    assert [(r.error_reason, r.kafka_offset, r.value_raw) for r in dl] == [
        ("unknown_parse_error", 2, "not json at all")]


def test_publish_frame_decodes_back(spark):
    """The published (key, value) rows decode to the same taps (times at ms)."""
    from tapflow.sinks.tables import publish_frame
    from tapflow.sources.envelope import decode_taps

    taps = spark.createDataFrame([c[0] for c in CASES[:1]] + [
        (GOOD_TX[:-1] + "2", "C002", "BUS-07", "tap_out", T.replace(microsecond=123456), -6.21, 106.81)],
        SCHEMA)
    pub = publish_frame(taps)
    env = pub.select("value", F.col("value").cast("string").alias("value_raw"),
                     F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
                     F.lit(0).cast("long").alias("kafka_offset"),
                     F.lit(None).cast("timestamp").alias("kafka_timestamp"))
    back = decode_taps(env).select("parsed", "transaction_id", "bus_id", "event_time").collect()
    assert [tuple(r) for r in back] == [
        (True, GOOD_TX, "BUS-01", T),
        (True, GOOD_TX[:-1] + "2", "BUS-07", T.replace(microsecond=123000))]
    assert [r.key for r in pub.collect()] == ["BUS-01", "BUS-07"]


def _one_envelope(spark, values):
    return spark.createDataFrame([(b"k", v, "t", 0, i, T) for i, v in enumerate(values)],
                                 "key binary, value binary, topic string, partition int, offset long, "
                                 "timestamp timestamp_ntz")


def test_unreadable_time_reaches_the_dead_letters(spark):
    body = ('{"transaction_id":"' + GOOD_TX + '","card_id":"C1","bus_id":"BUS-01","event_type":"tap_in",'
            '"timestamp":%s,"latitude":-6.2,"longitude":106.8}')
    values = [(body % t).encode() for t in ("9223372036854775807", "-9223372036854775808", "null", "1704096000123")]
    for ntz in (True, False):
        d = envelope_taps(_one_envelope(spark, values), ntz_event_time=ntz)
        got = {r.kafka_offset: r.error_reason for r in dead_letter(d).collect()}
        assert got == {0: "invalid_timestamp_parse", 1: "invalid_timestamp_parse", 2: "missing_timestamp"}


def _struct(time_sql, tx="transaction_id"):
    return lambda value: F.expr(f"""named_struct('transaction_id', {tx}, 'card_id', 'C1', 'bus_id', 'BUS-01',
        'event_type', 'tap_in', 'timestamp', {time_sql}, 'latitude', -6.2D, 'longitude', 106.8D)""")


@pytest.mark.parametrize("ntz", [True, False])
def test_decoder_with_a_timestamp(spark, ntz):
    """What the Avro decoder yields: the time is a TIMESTAMP already."""
    decode = _struct("TIMESTAMP'2024-01-01 08:00:00.123 UTC'", f"'{GOOD_TX}'")
    rows = envelope_taps(_one_envelope(spark, [b"x"]), decode, ntz_event_time=ntz)
    assert rows.first().event_time == dt.datetime(2024, 1, 1, 8, 0, 0, 123000)
    assert dead_letter(rows).count() == 0


def test_decoder_with_a_struct_of_nulls(spark):
    """An undecodable Avro payload is a struct of nulls, not a null struct."""
    decode = lambda value: F.from_json(F.lit("{}"), "transaction_id string, card_id string, bus_id string, "  # noqa: E731
                                       "event_type string, timestamp timestamp, latitude double, longitude double")
    rows = envelope_taps(_one_envelope(spark, [b"x"]), decode)
    assert [r.error_reason for r in dead_letter(rows).collect()] == ["unknown_parse_error"]


def test_avro_publishing_is_framed(spark):
    from tapflow.sinks.tables import publish_frame
    taps = spark.createDataFrame([c[0] for c in CASES[:1]], SCHEMA)
    with pytest.raises(ValueError):
        publish_frame(taps, "avro")
    value = publish_frame(taps, "avro", schema_id=258, encode=lambda rec: F.to_json(rec).cast("binary")).first().value
    assert bytes(value[:5]) == b"\0\0\0\1\2" and bytes(value[5:6]) == b"{"
