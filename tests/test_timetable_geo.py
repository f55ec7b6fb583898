"""Timetable expansion, legs, and nearest segment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapflow.config import STOPS
from tapflow.operators import geo, timetable as tt


def _taps(spark, bus, stops, day=2):
    """One tap a minute at each of the given stop indexes."""
    t = dt.datetime(2024, 5, day, 6)
    rows = [(f"{bus}-{day}-{i:03d}", bus, t + dt.timedelta(minutes=i), STOPS[k][1], STOPS[k][2])
            for i, k in enumerate(stops)]
    return spark.createDataFrame(rows, "transaction_id string, bus_id string, event_time timestamp_ntz, "
                                       "latitude double, longitude double")


RUN = [0, 0, 1, 2, 2, 2, 3, 2, 1, 1, 0, 4]


@pytest.mark.parametrize("bus", ["BUS-01", "BUS-25", "BUS-99999999999"])
def test_visits_come_from_the_taps(spark, bus):
    t = tt.timetable(_taps(spark, bus, RUN)).orderBy("seq_no").collect()
    assert [r.stop_idx for r in t] == [0, 1, 2, 3, 2, 1, 0, 4]
    assert [r.arrival.minute for r in t] == [0, 2, 3, 6, 7, 8, 10, 11]
    assert [r.direction[0] for r in t] == list("ffffbbbf")
    assert [r.leg_no for r in t] == [0, 0, 0, 0, 1, 1, 1, 2]
    assert [r.seq_no for r in t] == list(range(8))


def test_legs_and_counts(spark):
    table = tt.timetable(_taps(spark, "BUS-25", RUN).unionByName(_taps(spark, "BUS-25", [5, 3, 3, 9], day=3)))
    legs = tt.direction_legs(table)
    got = [(r.service_date.day, r.leg, r.direction, r.n_stops, r.stop_list)
           for r in legs.orderBy("service_date", "leg").collect()]
    assert got == [(2, 1, "forward", 4, "H-A,H-B,H-C,H-D"), (2, 2, "backward", 3, "H-C,H-B,H-A"),
                   (3, 1, "backward", 2, "H-F,H-D")]           # legs of one stop are left out
    c = tt.leg_direction_counts(legs).where("service_date = '2024-05-02'").first()
    assert (c.forward_legs, c.backward_legs, c.total_legs) == (1, 1, 2)
    assert tt.timetable_head(table, 2).count() == 4


def test_a_single_visit(spark):
    t = tt.timetable(_taps(spark, "BUS-07", [4, 4])).collect()
    assert [(r.seq_no, r.leg_no, r.direction, r.stop_id) for r in t] == [(0, 0, "forward", "H-E")]


def _python_segment(lat, lon):
    d = sorted(((s[1] - lat) ** 2 + (s[2] - lon) ** 2, i) for i, s in enumerate(STOPS))
    a, b = sorted([d[0][1], d[1][1]])
    return f"{STOPS[a][0]} -> {STOPS[b][0]}"


def test_segment_matches_direct_computation(spark):
    pts = [(-6.1375 - k * 0.00089, 106.8135 + k * 0.00003) for k in range(100)]
    pts += [(s[1], s[2]) for s in STOPS]
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = [r.s for r in df.select(geo.segment("lat", "lon").alias("s")).collect()]
    assert got == [_python_segment(a, b) for a, b in pts]


def test_segment_null_position(spark):
    df = spark.createDataFrame([(None, 106.8)], "lat double, lon double")
    assert df.select(geo.segment("lat", "lon").alias("s")).first().s is None


def test_epoch_is_zone_free_across_dst(spark):
    """Naive-UTC epochs do not depend on the session zone (DST gap rows)."""
    import calendar
    from tapflow.functions.times import epoch_micros
    rows = [dt.datetime(2024, 3, 10, 1, 59, 59, 999999), dt.datetime(2024, 3, 10, 2, 30, 0, 123456),
            dt.datetime(2024, 3, 10, 3, 15), dt.datetime(1969, 12, 31, 23, 59, 59, 500000)]
    df = spark.createDataFrame([(r,) for r in rows], "t timestamp_ntz")
    want = [calendar.timegm(r.timetuple()) * 1_000_000 + r.microsecond for r in rows]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert [r[0] for r in df.select(epoch_micros(df, "t")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
