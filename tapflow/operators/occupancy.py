"""Passengers aboard per vehicle and crowding flags (batch form).

Counters are never clamped; only the reported value is ``max(0, in - out)``.
Because the count is a plain sum of +1 / -1, every form below is built from
associative pieces: totals are map-side combined aggregates, running counts
use the hot-key-safe prefix scan of ``scan.py`` (a fleet has few vehicles,
so a per-vehicle window alone would run one task per vehicle), and the
per-interval flags reduce to one row per (vehicle, interval) before any
ordered step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.config import (
    CROWD_IDLE_SECONDS, CROWD_MESSAGE_FORMAT, CROWD_THRESHOLD, DEFAULT_FLAG_WINDOW,
)
from tapflow.functions.times import (
    epoch_micros, format_seconds, ntz_from_epoch_micros, time_bucket,
)
from tapflow.operators.geo import segment
from tapflow.operators.scan import DEFAULT, HotKeys, prefix_sums, with_neighbor

ORDER = ["event_time", "transaction_id"]


def delta() -> Column:
    """+1 for a tap_in, -1 for a tap_out."""
    return F.when(F.col("event_type") == "tap_in", F.lit(1)).otherwise(F.lit(-1))


def clamp(c: Column) -> Column:
    return F.greatest(F.lit(0), c).cast("int")


def crowd_message(flagged_at: Column, bus: Column, seg: Column, count: Column,
                  threshold: int = CROWD_THRESHOLD) -> Column:
    return F.format_string(CROWD_MESSAGE_FORMAT, format_seconds(flagged_at), bus, seg,
                           count, F.lit(threshold))


def bus_tap_counts(good: DataFrame) -> DataFrame:
    """A1: tap_in and tap_out counters per vehicle."""
    return good.groupBy("bus_id").agg(
        F.sum(F.when(F.col("event_type") == "tap_in", 1).otherwise(0)).cast("long")
        .alias("tap_in_count"),
        F.sum(F.when(F.col("event_type") == "tap_out", 1).otherwise(0)).cast("long")
        .alias("tap_out_count"))


def bus_aboard(good: DataFrame) -> DataFrame:
    """A2: passengers aboard now per vehicle, clamped at zero."""
    c = bus_tap_counts(good)
    return c.select("bus_id", clamp(F.col("tap_in_count") - F.col("tap_out_count"))
                    .alias("pending_count"))


def occupancy(good: DataFrame, keep_position: bool = False,
              bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """D3: passengers aboard after each tap of a vehicle."""
    s = prefix_sums(good, ["bus_id"], ORDER, {"_aboard": delta()},
                    bucket_seconds=bucket_seconds, hot=hot)
    cols = ["transaction_id", "bus_id", "event_time", clamp(F.col("_aboard")).alias("pending")]
    if keep_position:
        cols += ["latitude", "longitude"]
    return s.select(*cols)


def crowd_flags(good: DataFrame, threshold: int = CROWD_THRESHOLD,
                bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """A flag for every tap after which more than ``threshold`` are
    aboard, with the nearest segment and a message.  ``flagged_at`` is the
    tap's event time, so replays give the same rows."""
    o = occupancy(good, keep_position=True, bucket_seconds=bucket_seconds, hot=hot)
    f = o.where(F.col("pending") > threshold)
    seg = segment("latitude", "longitude")
    return f.select(
        "bus_id", "transaction_id", F.col("event_time").alias("flagged_at"),
        F.col("pending").alias("pending_count"), seg.alias("segment"),
    ).withColumn("message", crowd_message(F.col("flagged_at"), F.col("bus_id"),
                                          F.col("segment"), F.col("pending_count"), threshold))


def _interval_seconds(window: str) -> int:
    n, unit = window.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s").lower()]
    return int(n) * mult


def crowd_flags_windowed(good: DataFrame, window: str = DEFAULT_FLAG_WINDOW,
                         threshold: int = CROWD_THRESHOLD) -> DataFrame:
    """At most one flag per vehicle per tumbling event-time interval,
    from the count at the interval's end; the position is the interval's
    last tap.  The ordered step runs on one row per (vehicle, interval)."""
    secs = _interval_seconds(window)
    per = good.withColumn("_w", time_bucket(good, "event_time", secs)).groupBy("bus_id", "_w").agg(
        F.sum(delta()).alias("_delta"),
        F.max(F.struct(*ORDER, "latitude", "longitude")).alias("_last"))
    upto = Window.partitionBy("bus_id").orderBy("_w").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    closing = per.withColumn("_aboard", F.sum("_delta").over(upto))
    f = closing.where(F.col("_aboard") > threshold)
    out = f.select(
        "bus_id",
        ntz_from_epoch_micros(F.col("_w") * F.lit(secs * 1_000_000)).alias("window_start"),
        ntz_from_epoch_micros((F.col("_w") + 1) * F.lit(secs * 1_000_000)).alias("window_end"),
        F.col("_last.event_time").alias("flagged_at"),
        clamp(F.col("_aboard")).alias("pending_count"),
        segment("_last.latitude", "_last.longitude").alias("segment"),
    )
    return out.withColumn("message", crowd_message(F.col("flagged_at"), F.col("bus_id"),
                                                   F.col("segment"), F.col("pending_count"),
                                                   threshold))


def occupancy_idle_reset(good: DataFrame, idle_seconds: int = CROWD_IDLE_SECONDS,
                         bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Aboard count that restarts from zero when a vehicle has had no
    tap for more than ``idle_seconds``.

    session start = first tap or gap > idle; with P the vehicle's running
    count, aboard = P - P(just before the session's first tap).  That base is
    the latest one in order, a running maximum of (order, base).
    """
    p = with_neighbor(good, ["bus_id"], ORDER, [], "_prev", direction="previous",
                      bucket_seconds=bucket_seconds, hot=hot)
    gap_us = epoch_micros(p, "event_time") - epoch_micros(p, "_prev.event_time")
    starts = p.withColumn("_new", (F.col("_prev").isNull() |
                                   (gap_us > F.lit(idle_seconds * 1_000_000))).cast("int"))
    s = prefix_sums(starts, ["bus_id"], ORDER, {"_P": delta(), "session_no": F.col("_new")},
                    bucket_seconds=bucket_seconds, hot=hot)
    base = F.when(F.col("_new") == 1, F.struct(*ORDER, (F.col("_P") - delta()).alias("base")))
    s = prefix_sums(s, ["bus_id"], ORDER, {}, {"_start": base}, bucket_seconds=bucket_seconds, hot=hot)
    return s.select("transaction_id", "bus_id", "event_time",
                    F.col("session_no").cast("long").alias("session_no"),
                    clamp(F.col("_P") - F.col("_start.base")).alias("pending"))
