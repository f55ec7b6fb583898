"""Replays over several micro-batches: idle reset, interval flags, handover."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tapflow.functions.times import epoch_micros
from tapflow.operators import occupancy as occ, trips as tr
from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.validate import select_tap_fields
from tapflow.plans import stream as plans
from tapflow.plans.batch import good_taps
from tapflow.session import scratch_path
from tapflow.streaming.occupancy import crowd_sessions_stream, make_idle_function
from tapflow.streaming.replay import Replay, write_time_slices
from tapflow.streaming.run import start_file_sink

HOUR = 3_600_000_000
SCHEMA = ("transaction_id string, card_id string, bus_id string, event_type string, event_time timestamp, "
          "latitude double, longitude double")
T0 = dt.datetime(2024, 1, 1, 8)


class State:
    """What the function asks of a group state."""

    def __init__(self):
        self.value, self.watermark, self.timeout = None, 0, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.timeout = ms


def plain_count(taps):
    """(id, session start, aboard) one tap after the other."""
    out, last, start, aboard = [], None, None, 0
    for us, tx, kind in sorted(taps):
        if last is None or us - last > HOUR:
            start, aboard = us, 0
        aboard += 1 if kind == "tap_in" else -1
        last = us
        out.append((tx, start, max(0, aboard)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_idle_function_in_any_batches(seed):
    """Out-of-order arrival within the watermark delay, ties, long breaks; the
    state is gone once the watermark is an hour past the last tap."""
    rnd = random.Random(seed)
    now, taps = 1_700_000_000_000_000, []
    for i in range(300):
        now += rnd.choice([0, 1, 60_000_000, 600_000_000, HOUR, HOUR + 1, 3 * HOUR])
        taps.append((now, f"t{rnd.randrange(10 ** 6):06d}-{i}", rnd.choice(["tap_in", "tap_in", "tap_out"])))
    count, state, got, seen = make_idle_function(3600), State(), [], 0
    removed = 0
    while seen < len(taps) or state.exists:
        batch = taps[seen:seen + rnd.randrange(1, 40)]
        seen += len(batch)
        rnd.shuffle(batch)
        frame = pd.DataFrame({"transaction_id": [t[1] for t in batch], "event_type": [t[2] for t in batch],
                              "event_time": pd.to_datetime([t[0] for t in batch], unit="us"),
                              "latitude": 1.0, "longitude": 2.0})
        for out in count(("BUS-1",), iter([frame] if batch else []), state):
            starts = out["session_start"].astype("datetime64[us]").astype("int64")
            got += list(zip(out["transaction_id"], starts, out["pending"]))
        removed += not state.exists
        # the next batch sees the watermark of this one
        state.watermark = max(t[0] for t in taps[:seen]) // 1000 if seen < len(taps) else (now + 5 * HOUR) // 1000
    assert got == plain_count(taps) and removed >= 1


def _run(spark, rows, build, slices=4):
    replay = Replay(rows, slices)
    stream = build(select_tap_fields(dedup_taps_stream(replay.stream)))
    out = scratch_path(spark, "test-out")
    query, = replay.run(lambda: start_file_sink(stream, out, scratch_path(spark, "test-ckpt"), trigger={"processingTime": "0 seconds"}))
    return spark.read.schema(stream.schema).parquet(out), query


def test_session_gap_is_as_in_batch(spark):
    """A tap exactly an hour later stays in the session, one later opens one."""
    us = dt.timedelta(microseconds=1)
    times = [T0, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=2) + us, T0 + dt.timedelta(days=2)]
    rows = spark.createDataFrame([(f"t{i}", "C", "BUS-9" if i < 3 else "other", "tap_in", t, 0.0, 0.0)
                                  for i, t in enumerate(times)], SCHEMA)
    got, query = _run(spark, rows, crowd_sessions_stream)
    assert sorted((r.session_start, r.tap_in_count) for r in got.where("bus_id = 'BUS-9'").collect()) == [
        (times[0], 2), (times[2], 1)]
    state = [s for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"].startswith("session")]
    assert state[-1]["numRowsTotal"] == 1            # only the vehicle seen last is held


def test_slices_are_time_ranges(spark):
    rows = plans._replay_rows(spark, SF_SMALL)
    folders = write_time_slices(rows, scratch_path(spark, "test-slices"), 5, files_per_slice=2)
    assert 2 <= len(folders) <= 5
    ranges = [spark.read.parquet(f).agg(F.min("event_time"), F.max("event_time"), F.count("*")).first() for f in folders]
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])) and sum(r[2] for r in ranges) == rows.count()


@pytest.mark.parametrize("slices", [2, 7])
def test_interval_flags_do_not_depend_on_batches(spark, monkeypatch, slices):
    monkeypatch.setattr(plans, "FEW_SLICES", slices)
    monkeypatch.setattr("tapflow.streaming.occupancy.crowd_flags_windowed_stream.__defaults__", (2,))
    got = plans.q_crowd_flags_windowed_stream(spark, SF_SMALL)
    want = occ.crowd_flags_windowed(good_taps(spark, SF_SMALL), threshold=2)
    cols = ["bus_id", "window_start", "flagged_at", "pending_count", "segment"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect())) != []


@pytest.mark.parametrize("share", [0.0, 0.3, 1.0])
def test_handover_at_any_cut(spark, share, monkeypatch):
    """Batch up to the cut plus a fresh stream from it give all trips; the
    stream reads no earlier row, whatever copies lie on either side."""
    good = good_taps(spark, SF_SMALL)
    us = epoch_micros(good, "event_time")
    lo, hi = good.agg(F.min(us), F.max(us)).first()
    cut = int(lo + (hi + 1 - lo) * share)
    read = []

    def spy(rows, slices):
        read.append(rows)
        return Replay(rows, slices)

    monkeypatch.setattr(plans, "Replay", spy)
    got = plans.trips_resumed(spark, SF_SMALL, cut, slices=3).select("trip_id").collect()
    assert sorted(got) == sorted(tr.trips(good).select("trip_id").collect())
    assert read[0].where(epoch_micros(read[0], "event_time") < cut).count() == 0


def test_copies_across_the_cut(spark):
    """The original is before the cut, its copy behind it."""
    from tapflow.streaming.handover import resumed_pairs, write_handover
    m = dt.timedelta(minutes=1)
    row = lambda i, kind, t: (f"t{i}", "C", "BUS-1", kind, t, 1.0, 2.0)      # noqa: E731
    before = spark.createDataFrame([row(1, "tap_in", T0), row(2, "tap_out", T0 + m), row(3, "tap_in", T0 + 2 * m)], SCHEMA)
    live = spark.createDataFrame([row(1, "tap_in", T0 + 3 * m), row(3, "tap_in", T0 + 3 * m), row(2, "tap_out", T0 + 4 * m),
                                  row(4, "tap_out", T0 + 5 * m), ("end", "X", "X", "tap_out", T0 + 600 * m, 0.0, 0.0)], SCHEMA)
    cut = int((T0 + 3 * m).replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    handover = write_handover(before, scratch_path(spark, "test-handover"), cut)
    replay = Replay(live, 2)
    pairs, out = resumed_pairs(handover, replay.stream), scratch_path(spark, "test-pairs")
    replay.run(lambda: start_file_sink(pairs, out, scratch_path(spark, "test-ckpt"), trigger={"processingTime": "0 seconds"}))
    assert [(r.tap_in_tx_id, r.tap_out_tx_id, r.tap_in_time) for r in spark.read.schema(pairs.schema).parquet(out).collect()] == [
        ("t3", "t4", T0 + 2 * m)]
