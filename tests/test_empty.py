"""Empty input gives empty output (no errors) for every batch operator."""

import pytest

from tapflow.operators import occupancy as occ, timetable as tt, trips as tr
from tapflow.operators.dedup import dedup_taps
from tapflow.operators.validate import dead_letter, valid_taps

SCHEMA = ("transaction_id string, card_id string, bus_id string, event_type string, "
          "event_time timestamp_ntz, latitude double, longitude double")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("op", [
    lambda g: dedup_taps(valid_taps(g)),
    tr.trips, tr.open_taps, tr.expired_taps, tr.trips_max_open,
    lambda g: tr.trip_rule_violations(tr.trips(g)),
    occ.bus_tap_counts, occ.bus_aboard, occ.occupancy, occ.crowd_flags,
    occ.crowd_flags_windowed, occ.occupancy_idle_reset,
    tt.timetable, lambda g: tt.direction_legs(tt.timetable(g)),
])
def test_empty(empty, op):
    assert op(empty).count() == 0


def test_empty_dead_letter(spark):
    env = spark.createDataFrame([], SCHEMA + ", value_raw string, kafka_topic string, "
                                "kafka_partition int, kafka_offset long, kafka_timestamp timestamp")
    assert dead_letter(env).count() == 0
