"""Stop visits of the vehicles, taken from their taps, and one-way legs.

Every tap is at its nearest stop.  A vehicle's taps of one day, in time
order, are cut into visits wherever the stop changes; a visit's arrival is
its first tap, and its direction follows the stop list: forward when the stop
index grows, backward when it falls (the first visit takes the direction of
the move that follows).  A leg is a run of visits in one direction.

All ordered steps are the hot-key-safe scans of ``scan.py``, per vehicle and
day; any valid vehicle id takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.config import STOPS, TIMETABLE_HEAD_STOPS
from tapflow.functions.times import as_ntz
from tapflow.operators.geo import nearest_stops_sql
from tapflow.operators.scan import HotKeys, prefix_sums, with_neighbor

KEYS = ["bus_id", "service_date"]
ORDER = ["event_time", "transaction_id"]


def _direction(after, before):
    return F.when(after > before, F.lit("forward")).when(after < before, F.lit("backward"))


def with_service_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("service_date", F.to_date(as_ntz(rows, "event_time")))


def timetable(good: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Stop visits per (bus, day): bus_id, service_date, seq_no, leg_no,
    direction, stop_idx, stop_id, arrival."""
    hot = hot and hot.mapped(with_service_date)
    taps = (with_service_date(good).withColumn("event_time", as_ntz(good, "event_time"))
            .withColumn("stop_idx", F.expr(nearest_stops_sql("latitude", "longitude", 1) + "[0].idx"))
            .select(*KEYS, *ORDER, "stop_idx"))
    seen = with_neighbor(taps, KEYS, ORDER, ["stop_idx"], "_prev", hot=hot)
    visits = seen.where(F.col("_prev").isNull() | (F.col("_prev.stop_idx") != F.col("stop_idx"))).select(
        *KEYS, *ORDER, "stop_idx", F.col("_prev.stop_idx").alias("_from"))
    visits = with_neighbor(visits, KEYS, ORDER, ["stop_idx"], "_next", direction="next", hot=hot)
    visits = with_neighbor(visits, KEYS, ORDER, ["stop_idx", "_from"], "_before", hot=hot)
    here = _direction(F.col("stop_idx"), F.col("_from"))
    ahead = _direction(F.col("_next.stop_idx"), F.col("stop_idx"))
    before = _direction(F.col("_before.stop_idx"), F.col("_before._from"))
    visits = visits.select(
        *KEYS, *ORDER, "stop_idx", F.coalesce(here, ahead, F.lit("forward")).alias("direction"),
        # the first visit opens a leg; the second goes its way; then changes do
        F.when(F.col("_from").isNull() | (before.isNotNull() & (before != here)), 1).otherwise(0).alias("_turn"))
    numbered = prefix_sums(visits, KEYS, ORDER, {"_seq": F.lit(1), "_leg": F.col("_turn")}, hot=hot)
    ids = F.array(*[F.lit(s[0]) for s in STOPS])
    return numbered.select(
        *KEYS, (F.col("_seq") - 1).cast("int").alias("seq_no"), (F.col("_leg") - 1).cast("int").alias("leg_no"),
        "direction", F.col("stop_idx").cast("int").alias("stop_idx"),
        F.element_at(ids, F.col("stop_idx") + 1).alias("stop_id"), F.col("event_time").alias("arrival"))


def timetable_head(tt: DataFrame, n: int = TIMETABLE_HEAD_STOPS) -> DataFrame:
    """First ``n`` visits of each bus-day (seq_no is the visit's rank, so
    this is a filter, not a per-group sort)."""
    return tt.where(F.col("seq_no") < n)


def direction_legs(tt: DataFrame, min_stops: int = 2) -> DataFrame:
    """Each run of visits in one direction, of at least ``min_stops``
    stops.  A run cannot be longer than the stop list."""
    stops = F.array_sort(F.collect_list(F.struct("seq_no", "stop_id")))
    g = tt.groupBy(*KEYS, "leg_no", "direction").agg(
        F.count(F.lit(1)).alias("n_stops"), F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"), stops.alias("_stops"))
    return g.where(F.col("n_stops") >= min_stops).select(
        *KEYS, (F.col("leg_no") + 1).alias("leg"), "direction", F.col("n_stops").cast("long").alias("n_stops"),
        "first_arrival", "last_arrival",
        F.element_at("_stops", 1)["stop_id"].alias("first_stop"),
        F.element_at("_stops", -1)["stop_id"].alias("last_stop"),
        F.array_join(F.transform("_stops", lambda x: x["stop_id"]), ",").alias("stop_list"))


def leg_stops(legs: DataFrame) -> DataFrame:
    """Ordered stop list of each leg (at most one stop list long)."""
    return legs.select(*KEYS, "leg", "direction", "stop_list")


def leg_direction_counts(legs: DataFrame) -> DataFrame:
    """A5: legs per bus-day by direction, with the total."""
    return legs.groupBy(*KEYS).agg(
        F.sum(F.when(F.col("direction") == "forward", 1).otherwise(0)).cast("long")
        .alias("forward_legs"),
        F.sum(F.when(F.col("direction") == "backward", 1).otherwise(0)).cast("long")
        .alias("backward_legs"),
        F.count(F.lit(1)).cast("long").alias("total_legs"))
