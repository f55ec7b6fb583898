"""Passengers aboard on a stream, with idle vehicles forgotten (W6) and one
flag per interval (M13).

``occupancy_idle_reset_stream`` is the keyed form: a vehicle's rows wait until
the watermark has passed them and are then counted in event-time order.  After
more than ``idle_seconds`` without a tap the count starts again from zero; an
event-time timeout removes the state of a vehicle as soon as the watermark is
that far ahead, so state holds active vehicles only.  A call gets one
vehicle's rows of one micro-batch and counts them by column shifts.

``crowd_sessions_stream`` gives the same sessions by native session windows,
one row per vehicle and session when it has closed, without Python.

``closed_intervals_stream`` and ``crowd_flags_windowed_stream`` chain two
stateful operators: a window aggregate in append mode reduces taps to a row per
(vehicle, interval), emitted in time order as the watermark passes; a keyed
running sum over those few rows gives the count at each interval's end.  Spark
allows no keyed state behind an aggregate in one query, so the second is a
query of its own that streams the first one's table.  The flags do not depend
on where micro-batches begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

from tapflow.config import CROWD_IDLE_SECONDS, CROWD_THRESHOLD, DEFAULT_FLAG_WINDOW
from tapflow.operators.geo import segment
from tapflow.operators.occupancy import clamp, crowd_message, delta

OCCUPANCY_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("bus_id", StringType()),
    StructField("event_time", TimestampType()),
    StructField("session_start", TimestampType()),
    StructField("pending", IntegerType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])

# Per-vehicle state: the running session (start, last tap, unclamped count) and
# the rows that the watermark has not passed.
IDLE_STATE_SCHEMA = StructType([
    StructField("session_start_us", LongType()),
    StructField("last_us", LongType()),
    StructField("aboard", LongType()),
    StructField("ids", ArrayType(StringType())),
    StructField("deltas", ArrayType(LongType())),
    StructField("times_us", ArrayType(LongType())),
    StructField("lats", ArrayType(DoubleType())),
    StructField("lons", ArrayType(DoubleType())),
])

_NO_TAP = -(1 << 62)


def _columns(frames: list[pd.DataFrame], saved) -> list[np.ndarray]:
    """ids, deltas, times, lats, lons of held and new rows."""
    held = saved[3:] if saved is not None else ([],) * 5
    new = pd.concat(frames, ignore_index=True) if frames else None
    times = (new["event_time"].astype("datetime64[us]").astype("int64") if new is not None else [])
    fresh = ([new["transaction_id"], np.where(new["event_type"] == "tap_in", 1, -1), times, new["latitude"], new["longitude"]]
             if new is not None else [[]] * 5)
    return [np.concatenate([np.asarray(h, dtype=t), np.asarray(f, dtype=t)])
            for h, f, t in zip(held, fresh, (object, "int64", "int64", "float64", "float64"))]


def make_idle_function(idle_seconds: int):
    idle_us = int(idle_seconds) * 1_000_000

    def count(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        saved = state.get if state.exists else None
        begin, last, aboard = saved[:3] if saved is not None else (_NO_TAP, _NO_TAP, 0)
        cols = _columns([c for c in chunks if len(c)], saved)
        wm_ms = state.getCurrentWatermarkMs()
        final = cols[2] < wm_ms * 1000
        held = [c[~final] for c in cols]
        at = np.nonzero(final)[0]
        at = at[np.lexsort((cols[0][at].astype(str), cols[2][at]))]
        ids, change, times, lats, lons = (c[at] for c in cols)
        n = len(times)
        if n:
            before = np.concatenate([[last], times[:-1]])
            new = (before == _NO_TAP) | (times - before > idle_us)
            total = aboard + np.cumsum(change)
            # what the running sum was before the row's session began
            opened = np.where(new, np.arange(n), -1)
            opened = np.maximum.accumulate(opened)
            base = np.where(opened >= 0, (total - change)[opened], 0)
            starts = np.where(opened >= 0, times[opened], begin)
            inside = total - base
            begin, last, aboard = int(starts[-1]), int(times[-1]), int(inside[-1])
            yield pd.DataFrame({
                "transaction_id": ids, "bus_id": np.full(n, key[0], dtype=object),
                "event_time": pd.to_datetime(times, unit="us"), "session_start": pd.to_datetime(starts, unit="us"),
                "pending": np.maximum(inside, 0).astype("int32"), "latitude": lats, "longitude": lons})
        if last != _NO_TAP and (last + idle_us) // 1000 < wm_ms:
            begin, last, aboard = _NO_TAP, _NO_TAP, 0      # no row to come can be within the hour
        if last == _NO_TAP and not len(held[2]):
            if state.exists:
                state.remove()
            return
        state.update((begin, last, aboard, [str(x) for x in held[0]], *(c.tolist() for c in held[1:])))
        deadline = [int(held[2].min()) // 1000] if len(held[2]) else []
        deadline += [(last + idle_us) // 1000] if last != _NO_TAP else []
        state.setTimeoutTimestamp(max(min(deadline), wm_ms) + 1)

    return count


def occupancy_idle_reset_stream(good: DataFrame, idle_seconds: int = CROWD_IDLE_SECONDS) -> DataFrame:
    """D6 on a stream of good taps with a watermark: a row per tap, with the
    start of its session."""
    return good.groupBy("bus_id").applyInPandasWithState(
        make_idle_function(idle_seconds), outputStructType=OCCUPANCY_SCHEMA, stateStructType=IDLE_STATE_SCHEMA,
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def idle_reset_flags(counted: DataFrame, threshold: int = CROWD_THRESHOLD) -> DataFrame:
    """A flag per tap after which more than ``threshold`` are aboard."""
    f = counted.where(F.col("pending") > threshold).select(
        "bus_id", F.col("event_time").alias("flagged_at"), F.col("pending").alias("pending_count"),
        segment("latitude", "longitude").alias("segment"))
    return f.withColumn("message", crowd_message(F.col("flagged_at"), F.col("bus_id"), F.col("segment"),
                                                 F.col("pending_count"), threshold))


def crowd_sessions_stream(good: DataFrame, idle_seconds: int = CROWD_IDLE_SECONDS) -> DataFrame:
    """Closed sessions of each vehicle: counters and the count at the end.
    A tap exactly ``idle_seconds`` after the last still belongs to the session,
    as session windows that touch are merged."""
    w = F.session_window("event_time", f"{idle_seconds} seconds")
    s = good.groupBy("bus_id", w.alias("w")).agg(
        F.sum(F.when(F.col("event_type") == "tap_in", 1).otherwise(0)).cast("long").alias("tap_in_count"),
        F.sum(F.when(F.col("event_type") == "tap_out", 1).otherwise(0)).cast("long").alias("tap_out_count"),
        F.max("event_time").alias("last_event_time"))
    return s.select("bus_id", F.col("w.start").alias("session_start"), "last_event_time", "tap_in_count", "tap_out_count",
                    clamp(F.col("tap_in_count") - F.col("tap_out_count")).alias("pending_count"))


_CLOSING_SCHEMA = StructType([
    StructField("bus_id", StringType()),
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("flagged_at", TimestampType()),
    StructField("aboard", LongType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])
_TOTAL_SCHEMA = StructType([StructField("aboard", LongType())])


def _running_total(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    frames = [c for c in chunks if len(c)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True).sort_values("window_start", ignore_index=True)
    before = state.get[0] if state.exists else 0
    rows["aboard"] = before + rows["delta"].cumsum()
    state.update((int(rows["aboard"].iloc[-1]),))
    yield rows[[f.name for f in _CLOSING_SCHEMA.fields]]


def closed_intervals_stream(good: DataFrame, window: str = DEFAULT_FLAG_WINDOW) -> DataFrame:
    """Change of the count and last tap per vehicle and interval (append mode:
    an interval comes once, when the watermark has passed its end)."""
    per = good.groupBy("bus_id", F.window("event_time", window).alias("w")).agg(
        F.sum(delta()).cast("long").alias("delta"),
        F.max(F.struct("event_time", "transaction_id", "latitude", "longitude")).alias("last"))
    return per.select("bus_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "delta",
                      F.col("last.event_time").alias("flagged_at"), F.col("last.latitude").alias("latitude"),
                      F.col("last.longitude").alias("longitude"))


INTERVAL_SCHEMA = StructType([StructField("delta", LongType()) if f.name == "aboard" else f for f in _CLOSING_SCHEMA.fields])


def crowd_flags_windowed_stream(closed: DataFrame, threshold: int = CROWD_THRESHOLD) -> DataFrame:
    """D5 on the stream of closed intervals: at most one flag per vehicle and
    interval, from the count at the interval's end.  The state is one number
    per vehicle."""
    closing = closed.groupBy("bus_id").applyInPandasWithState(
        _running_total, outputStructType=_CLOSING_SCHEMA, stateStructType=_TOTAL_SCHEMA, outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout)
    f = closing.where(F.col("aboard") > threshold).select(
        "bus_id", "window_start", "window_end", "flagged_at", clamp(F.col("aboard")).alias("pending_count"),
        segment("latitude", "longitude").alias("segment"))
    return f.withColumn("message", crowd_message(F.col("flagged_at"), F.col("bus_id"), F.col("segment"),
                                                 F.col("pending_count"), threshold))
