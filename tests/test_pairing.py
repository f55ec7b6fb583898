"""Pairing: batch form vs a per-card state machine; open and expired taps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapflow.operators import trips as tr


def state_machine(rows, max_open_us=None):
    """Last tap_in wins; a tap_out consumes it; a tap_out alone is ignored."""
    trips, pending = [], {}
    for card, ts, tx, typ in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        p = pending.get(card)
        if p is not None and max_open_us is not None and \
                (ts - p[0]) / dt.timedelta(microseconds=1) > max_open_us:
            p = pending.pop(card)
            p = None
        if typ == "tap_in":
            pending[card] = (ts, tx)
        elif p is not None:
            trips.append((card, p[1], tx))
            pending.pop(card)
    return sorted(trips), pending


def _taps(spark, rows):
    data = [(tx, card, "BUS-01", typ, ts, -6.2, 106.8) for card, ts, tx, typ in rows]
    return spark.createDataFrame(
        data, "transaction_id string, card_id string, bus_id string, event_type string, "
              "event_time timestamp_ntz, latitude double, longitude double")


def _random_rows(seed, n=400):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(n):
        card = "HOT" if rnd.random() < 0.35 else f"C{rnd.randint(1, 12)}"
        ts = t0 + dt.timedelta(minutes=rnd.randint(0, 20 * 60) // 5 * 5)
        rows.append((card, ts, f"t{i:05d}", rnd.choice(["tap_in", "tap_in", "tap_out"])))
    return rows


@pytest.mark.parametrize("seed", [7, 8, 9])
@pytest.mark.parametrize("bucket,hot", [(None, None), (600, None), (3600, 40), (600, 40)])
def test_trips_equal_state_machine(spark, seed, bucket, hot):
    rows = _random_rows(seed)
    want, pending = state_machine(rows)
    got = tr.trips(_taps(spark, rows), bucket_seconds=bucket, hot_key_rows=hot)
    assert sorted((r.card_id, r.tap_in_tx_id, r.tap_out_tx_id) for r in got.collect()) == want
    opened = tr.open_taps(_taps(spark, rows))
    assert sorted((r.card_id, r.tap_in_tx_id) for r in opened.collect()) == \
        sorted((c, p[1]) for c, p in pending.items())


@pytest.mark.parametrize("seed", [3, 4])
def test_trips_max_open_equal_state_machine(spark, seed):
    rows = _random_rows(seed)
    max_open = 2 * 3600
    want, _ = state_machine(rows, max_open_us=max_open * 1_000_000)
    got = tr.trips(_taps(spark, rows), max_open_seconds=max_open, bucket_seconds=1800)
    assert sorted((r.card_id, r.tap_in_tx_id, r.tap_out_tx_id) for r in got.collect()) == want


def test_trip_ends_on_other_vehicle_keeps_tap_in_bus(spark):
    t = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([
        ("a", "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
        ("b", "C1", "BUS-02", "tap_out", t + dt.timedelta(minutes=9), -6.21, 106.81),
    ], "transaction_id string, card_id string, bus_id string, event_type string, "
       "event_time timestamp_ntz, latitude double, longitude double")
    r = tr.trips(df, include_tap_out_bus=True).collect()
    assert [(x.bus_id, x.tap_out_bus_id) for x in r] == [("BUS-01", "BUS-02")]


def test_trip_id_is_deterministic(spark):
    t = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([
        ("a", "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
        ("b", "C1", "BUS-01", "tap_out", t + dt.timedelta(minutes=1), -6.2, 106.8),
    ], "transaction_id string, card_id string, bus_id string, event_type string, "
       "event_time timestamp_ntz, latitude double, longitude double")
    a = tr.trips(df).collect()[0].trip_id
    b = tr.trips(df).collect()[0].trip_id
    import hashlib
    assert a == b == hashlib.sha256(b"C1|a|b").hexdigest()


def test_same_time_ties_broken_by_transaction_id(spark):
    t = dt.datetime(2024, 1, 1, 8)
    df = spark.createDataFrame([
        ("x2", "C1", "BUS-01", "tap_out", t, -6.2, 106.8),
        ("x1", "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
    ], "transaction_id string, card_id string, bus_id string, event_type string, "
       "event_time timestamp_ntz, latitude double, longitude double")
    r = tr.trips(df).collect()
    assert [(x.tap_in_tx_id, x.tap_out_tx_id) for x in r] == [("x1", "x2")]
    v = tr.trip_rule_violations(tr.trips(df)).collect()
    assert {x.violation for x in v} == {"tap_out_not_after_tap_in"}


def test_rule_violations(spark):
    t = dt.datetime(2024, 1, 1, 8)
    m = dt.timedelta(minutes=1)
    df = spark.createDataFrame([
        ("a", "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
        ("b", "C1", "BUS-01", "tap_out", t + 55 * m, -6.2, 106.8),     # too long
        ("c", "C1", "BUS-01", "tap_in", t + 58 * m, -6.2, 106.8),      # too soon
        ("d", "C1", "BUS-01", "tap_out", t + 70 * m, -6.2, 106.8),
        ("e", "C1", "BUS-01", "tap_in", t + 90 * m, -6.2, 106.8),      # fine
        ("f", "C1", "BUS-01", "tap_out", t + 100 * m, -6.2, 106.8),
    ], "transaction_id string, card_id string, bus_id string, event_type string, "
       "event_time timestamp_ntz, latitude double, longitude double")
    v = tr.trip_rule_violations(tr.trips(df)).orderBy("tap_in_time").collect()
    assert [x.violation for x in v] == ["trip_too_long", "transfer_too_soon"]


def test_expired_taps(spark):
    t = dt.datetime(2024, 1, 1, 8)
    h = dt.timedelta(hours=1)
    df = spark.createDataFrame([
        ("a", "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
        ("b", "C1", "BUS-01", "tap_out", t + 3 * h, -6.2, 106.8),   # too late: a expires
        ("c", "C1", "BUS-01", "tap_in", t + 4 * h, -6.2, 106.8),
        ("d", "C1", "BUS-01", "tap_in", t + 5 * h, -6.2, 106.8),    # c replaced, not expired
    ], "transaction_id string, card_id string, bus_id string, event_type string, "
       "event_time timestamp_ntz, latitude double, longitude double")
    got = sorted(r.tap_in_tx_id for r in tr.expired_taps(df).collect())
    assert got == ["a"]                          # d is young at the end of the data
    later = df.unionByName(df.limit(1).selectExpr(
        "'z' AS transaction_id", "'C9' AS card_id", "bus_id", "'tap_out' AS event_type",
        "TIMESTAMP_NTZ'2024-01-01 16:00:00' AS event_time", "latitude", "longitude"))
    assert sorted(r.tap_in_tx_id for r in tr.expired_taps(later).collect()) == ["a", "d"]
    assert tr.trips(df, max_open_seconds=7200).count() == 0
    assert tr.trips(df).count() == 1
