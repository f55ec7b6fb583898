"""Crowd counts and flags on a stream (W5), without Python.

A streaming aggregation per vehicle keeps one state row per vehicle
(tap_in and tap_out counters plus the last position); in update mode each
micro-batch emits the vehicles it touched with their running totals.  The
aggregation is partial (map-side) before the shuffle, so a hot vehicle
costs one row per input partition per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.config import CROWD_THRESHOLD
from tapflow.operators.geo import segment
from tapflow.operators.occupancy import clamp, crowd_message


def crowd_counts_stream(good: DataFrame) -> DataFrame:
    """Running counters per vehicle (use output mode ``update``)."""
    agg = good.groupBy("bus_id").agg(
        F.sum(F.when(F.col("event_type") == "tap_in", 1).otherwise(0)).cast("long")
        .alias("tap_in_count"),
        F.sum(F.when(F.col("event_type") == "tap_out", 1).otherwise(0)).cast("long")
        .alias("tap_out_count"),
        F.max(F.struct("event_time", "transaction_id", "latitude", "longitude"))
        .alias("last"))
    return agg.select(
        "bus_id", "tap_in_count", "tap_out_count",
        clamp(F.col("tap_in_count") - F.col("tap_out_count")).alias("pending_count"),
        F.col("last.event_time").alias("last_event_time"),
        F.col("last.latitude").alias("last_lat"),
        F.col("last.longitude").alias("last_lon"))


def crowd_flags_from_counts(counts: DataFrame, threshold: int = CROWD_THRESHOLD) -> DataFrame:
    """Flags for vehicles above the threshold; position = last tap seen."""
    f = counts.where(F.col("pending_count") > threshold)
    return f.select(
        "bus_id", F.col("last_event_time").alias("flagged_at"), "pending_count",
        segment("last_lat", "last_lon").alias("segment"),
    ).withColumn("message", crowd_message(F.col("flagged_at"), F.col("bus_id"),
                                          F.col("segment"), F.col("pending_count"),
                                          threshold))
