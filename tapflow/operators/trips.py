"""Pairing taps into trips per card (batch form).

A tap_in waits for the card's next tap_out; a newer tap_in replaces it; a
tap_out with nothing waiting is ignored.  That state machine is the same as
"a tap_out pairs iff the card's immediately preceding event is a tap_in",
so the batch form is a previous-row lookup in (event_time, transaction_id)
order, no Python.  The lookup is the hot-key-safe scan of ``scan.py``.

The pairing key is the card alone: a trip may end on another vehicle and
carries the tap_in's ``bus_id`` (``tap_out_bus_id`` is optional).
``trip_id`` is a hash of (card, tap_in id, tap_out id), so replays give the
same ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapflow.config import MAX_TRIP_MINUTES, MIN_TRANSFER_MINUTES, PAIRING_TIMEOUT_SECONDS
from tapflow.functions.times import epoch_micros
from tapflow.operators.scan import DEFAULT, HotKeys, with_neighbor
from tapflow.schemas import TRIP_COLUMNS

ORDER = ["event_time", "transaction_id"]
_CARRIED = ["event_type", "bus_id", "latitude", "longitude"]


def trip_id(card: Column, tx_in: Column, tx_out: Column) -> Column:
    return F.sha2(F.concat_ws("|", card, tx_in, tx_out), 256)


def with_previous_tap(good: DataFrame,
                      bucket_seconds: int | None | str = DEFAULT,
                      hot_key_rows: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    return with_neighbor(good, ["card_id"], ORDER, _CARRIED, "prev",
                         direction="previous", bucket_seconds=bucket_seconds,
                         hot_key_rows=hot_key_rows, hot=hot)


def trips(good: DataFrame, max_open_seconds: int | None = None,
          include_tap_out_bus: bool = False,
          bucket_seconds: int | None | str = DEFAULT,
          hot_key_rows: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """One row per paired (tap_in, tap_out).

    ``max_open_seconds`` (D9): a tap_in waits at most that long; a later
    tap_out does not pair.
    """
    p = with_previous_tap(good, bucket_seconds, hot_key_rows, hot)
    cond = (F.col("event_type") == "tap_out") & (F.col("prev.event_type") == "tap_in")
    if max_open_seconds is not None:
        gap_us = epoch_micros(p, "event_time") - epoch_micros(p, "prev.event_time")
        cond = cond & (gap_us <= F.lit(max_open_seconds * 1_000_000))
    t = p.where(cond).select(
        trip_id(F.col("card_id"), F.col("prev.transaction_id"), F.col("transaction_id"))
        .alias("trip_id"),
        "card_id",
        F.col("prev.bus_id").alias("bus_id"),
        F.col("prev.transaction_id").alias("tap_in_tx_id"),
        F.col("transaction_id").alias("tap_out_tx_id"),
        F.col("prev.event_time").alias("tap_in_time"),
        F.col("event_time").alias("tap_out_time"),
        F.col("prev.latitude").alias("tap_in_lat"),
        F.col("prev.longitude").alias("tap_in_lon"),
        F.col("latitude").alias("tap_out_lat"),
        F.col("longitude").alias("tap_out_lon"),
        F.col("bus_id").alias("tap_out_bus_id"),
    )
    cols = TRIP_COLUMNS + (["tap_out_bus_id"] if include_tap_out_bus else [])
    return t.select(*cols)



def trips_max_open(good: DataFrame, max_open_seconds: int = PAIRING_TIMEOUT_SECONDS,
                   bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    return trips(good, max_open_seconds=max_open_seconds, bucket_seconds=bucket_seconds, hot=hot)


def open_taps(good: DataFrame) -> DataFrame:
    """Cards whose latest event is a tap_in (the pairing state's
    content after all rows).  ``max(struct)`` is a map-side-combined
    aggregate, so a hot card costs one row per input partition."""
    last = good.groupBy("card_id").agg(
        F.max(F.struct(*ORDER, *_CARRIED)).alias("last"))
    return last.where(F.col("last.event_type") == "tap_in").select(
        "card_id",
        F.col("last.transaction_id").alias("tap_in_tx_id"),
        F.col("last.bus_id").alias("bus_id"),
        F.col("last.event_time").alias("tap_in_time"),
        F.col("last.latitude").alias("tap_in_lat"),
        F.col("last.longitude").alias("tap_in_lon"),
    )


def expired_taps(good: DataFrame, max_open_seconds: int = PAIRING_TIMEOUT_SECONDS,
                 bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """tap_ins that neither pair nor get replaced within the maximum
    open time: the card's next event, or the end of the data where there is
    none, comes later than that."""
    n = with_neighbor(good, ["card_id"], ORDER, [], "next", direction="next",
                      bucket_seconds=bucket_seconds, hot=hot)
    end = good.agg(F.max("event_time").alias("end")).scalar()
    n = n.withColumn("_until", F.coalesce(F.col("next.event_time"), end))
    gap_us = epoch_micros(n, "_until") - epoch_micros(n, "event_time")
    cond = (F.col("event_type") == "tap_in") & (gap_us > F.lit(max_open_seconds * 1_000_000))
    return n.where(cond).select(
        "card_id",
        F.col("transaction_id").alias("tap_in_tx_id"),
        "bus_id",
        F.col("event_time").alias("tap_in_time"),
        F.col("latitude").alias("tap_in_lat"),
        F.col("longitude").alias("tap_in_lon"),
        F.col("next.event_time").alias("next_event_time"),
    )


def trip_rule_violations(trips_df: DataFrame,
                         max_trip_minutes: int = MAX_TRIP_MINUTES,
                         min_transfer_minutes: int = MIN_TRANSFER_MINUTES,
                         bucket_seconds: int | None | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Rider rules checked on trips, one row per (trip, broken rule):

    * ``tap_out_not_after_tap_in``: tap_out_time <= tap_in_time
    * ``trip_too_long``: more than ``max_trip_minutes``
    * ``transfer_too_soon``: tap_in no more than ``min_transfer_minutes``
      after the card's previous trip's tap_out
    """
    p = with_neighbor(trips_df, ["card_id"], ["tap_in_time", "tap_in_tx_id"],
                      ["tap_out_time"], "prev_trip", direction="previous",
                      time_col="tap_in_time", bucket_seconds=bucket_seconds, hot=hot)
    dur_us = epoch_micros(p, "tap_out_time") - epoch_micros(p, "tap_in_time")
    prev_out = F.col("prev_trip.tap_out_time")
    soon = prev_out.isNotNull() & (
        F.col("tap_in_time") <= prev_out + F.expr(f"INTERVAL {min_transfer_minutes} MINUTES"))
    rules = F.array(
        F.when(F.col("tap_out_time") <= F.col("tap_in_time"), F.lit("tap_out_not_after_tap_in")),
        F.when(dur_us > F.lit(max_trip_minutes * 60 * 1_000_000), F.lit("trip_too_long")),
        F.when(soon, F.lit("transfer_too_soon")),
    )
    broken = F.filter(rules, lambda r: r.isNotNull())
    return (p.withColumn("violation", F.explode(broken))
             .select("trip_id", "card_id", "tap_in_time", "tap_out_time",
                     prev_out.alias("prev_tap_out_time"), "violation"))
