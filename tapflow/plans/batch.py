"""Batch plans: each takes (spark, sf_dir) and returns a DataFrame.

All plans start from the driver's ``events`` table (projected to taps in
``sources/fixtures.py``), so their work grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.operators import geo, occupancy as occ, timetable as tt, trips as tr
from tapflow.operators.dedup import dedup_taps
from tapflow.operators.geo_index import nearest_segment_join
from tapflow.operators.scan import HotKeys
from tapflow.operators.validate import (
    dead_letter, event_type_ok, patterns_ok, ranges_ok, select_tap_fields,
    valid_taps, with_reject_reason,
)
from tapflow.sources.envelope import envelope_taps
from tapflow.sources.fixtures import taps, tap_envelope_source
from tapflow.config import STOPS, TOPIC_PARTITIONS

TAP_ORDER = ["event_time", "transaction_id"]


def good_taps(spark: SparkSession, sf_dir: str, strict_reference: bool = False,
              columns: list[str] | None = None) -> DataFrame:
    """P4 + W2: validated, de-duplicated taps (seven columns, or the id and
    ``columns``; the others are not shuffled)."""
    return dedup_taps(select_tap_fields(valid_taps(taps(spark, sf_dir), strict_reference)), columns=columns)


def hot_taps(spark: SparkSession, sf_dir: str) -> HotKeys:
    """Hot cards and vehicles, from the valid taps as they are read."""
    return HotKeys(valid_taps(taps(spark, sf_dir)))


def decoded_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_taps(tap_envelope_source(spark, sf_dir))


# --- sources / filters -----------------------------------------------------

def q_tap_envelope(spark, sf_dir):
    return decoded_envelope(spark, sf_dir).drop("parsed", "time_parsed")


def q_tap_pattern_filter(spark, sf_dir):
    return taps(spark, sf_dir).where(patterns_ok())


def q_tap_type_filter(spark, sf_dir):
    return taps(spark, sf_dir).where(event_type_ok())


def q_tap_range_filter(spark, sf_dir):
    return taps(spark, sf_dir).where(ranges_ok())


def q_good_taps(spark, sf_dir):
    return good_taps(spark, sf_dir)


def q_good_taps_strict(spark, sf_dir):
    return good_taps(spark, sf_dir, strict_reference=True)


def q_tap_dedup(spark, sf_dir):
    return dedup_taps(taps(spark, sf_dir).where(F.col("transaction_id").isNotNull()))


def q_reject_reason(spark, sf_dir):
    return with_reject_reason(taps(spark, sf_dir))


def q_reject_counts(spark, sf_dir):
    r = with_reject_reason(taps(spark, sf_dir))
    return r.groupBy(F.coalesce("error_reason", F.lit("none")).alias("error_reason")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_dead_letter(spark, sf_dir):
    return dead_letter(decoded_envelope(spark, sf_dir))


def q_dead_letter_strict(spark, sf_dir):
    return dead_letter(decoded_envelope(spark, sf_dir), strict_reference=True)


# --- trips -----------------------------------------------------------------

def q_trips(spark, sf_dir):
    return tr.trips(good_taps(spark, sf_dir), hot=hot_taps(spark, sf_dir))


def q_open_taps(spark, sf_dir):
    return tr.open_taps(good_taps(spark, sf_dir))


def q_trips_max_open(spark, sf_dir):
    return tr.trips_max_open(good_taps(spark, sf_dir), hot=hot_taps(spark, sf_dir))


def q_expired_taps(spark, sf_dir):
    return tr.expired_taps(good_taps(spark, sf_dir), hot=hot_taps(spark, sf_dir))


def q_trip_rule_violations(spark, sf_dir):
    hot = hot_taps(spark, sf_dir)
    return tr.trip_rule_violations(tr.trips(good_taps(spark, sf_dir), hot=hot), hot=hot)


# --- occupancy -------------------------------------------------------------

def q_bus_tap_counts(spark, sf_dir):
    return occ.bus_tap_counts(good_taps(spark, sf_dir, columns=["bus_id", "event_type"]))


def q_bus_aboard(spark, sf_dir):
    return occ.bus_aboard(good_taps(spark, sf_dir, columns=["bus_id", "event_type"]))


def q_occupancy(spark, sf_dir):
    return occ.occupancy(good_taps(spark, sf_dir, columns=["bus_id", "event_type", "event_time"]), hot=hot_taps(spark, sf_dir))


def q_crowd_flags(spark, sf_dir):
    return occ.crowd_flags(good_taps(spark, sf_dir), hot=hot_taps(spark, sf_dir))


def q_crowd_flags_windowed(spark, sf_dir):
    return occ.crowd_flags_windowed(good_taps(spark, sf_dir))


def q_occupancy_idle_reset(spark, sf_dir):
    return occ.occupancy_idle_reset(good_taps(spark, sf_dir, columns=["bus_id", "event_type", "event_time"]), hot=hot_taps(spark, sf_dir))


# --- geo -------------------------------------------------------------------

def q_nearest_segment(spark, sf_dir):
    g = good_taps(spark, sf_dir, columns=["latitude", "longitude"])
    return g.select("transaction_id", geo.segment("latitude", "longitude")
                    .alias("segment"))


def stop_table(spark: SparkSession) -> DataFrame:
    """The stop list as a table: idx, stop_id, lat, lon."""
    return spark.createDataFrame([(i, *stop) for i, stop in enumerate(STOPS)], "idx int, stop_id string, lat double, lon double")


def q_nearest_segment_join(spark, sf_dir):
    """J1 by joins with a stop table, which may have any size."""
    g = good_taps(spark, sf_dir, columns=["latitude", "longitude"])
    return nearest_segment_join(g, stop_table(spark)).select("transaction_id", "segment")


# --- small reports ---------------------------------------------------------

def q_tap_type_counts(spark, sf_dir):
    return good_taps(spark, sf_dir, columns=["event_type"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_first_taps(spark, sf_dir):
    """O3: the first ten taps by time (a sample report: the limit is the
    feature; Spark runs it as a per-partition top-k then a merge)."""
    return good_taps(spark, sf_dir).orderBy(*TAP_ORDER).limit(10)


def publish_partition(key, partitions: int = TOPIC_PARTITIONS):
    """Partition that the producer's default partitioner (CRC-32 of the key,
    modulo the partitions) gives a non-null key."""
    return F.pmod(F.crc32(key.cast("binary")), F.lit(partitions)).cast("int")


def q_bus_partition_sizes(spark, sf_dir):
    """K8: buses and rows per publish partition; a bus lies in one."""
    buses = good_taps(spark, sf_dir, columns=["bus_id"]).groupBy("bus_id").agg(F.count(F.lit(1)).alias("n"))
    return buses.groupBy(publish_partition(F.col("bus_id")).alias("partition")).agg(
        F.count(F.lit(1)).alias("n_buses"), F.sum("n").alias("n_rows"))


# --- timetable -------------------------------------------------------------

def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = good_taps(spark, sf_dir, columns=["bus_id", "event_time", "latitude", "longitude"])
    return tt.timetable(good, hot_taps(spark, sf_dir))


def q_timetable(spark, sf_dir):
    return visits(spark, sf_dir)


def q_timetable_head(spark, sf_dir):
    return tt.timetable_head(visits(spark, sf_dir))


def q_direction_legs(spark, sf_dir):
    return tt.direction_legs(visits(spark, sf_dir))


def q_leg_stops(spark, sf_dir):
    return tt.leg_stops(tt.direction_legs(visits(spark, sf_dir)))


def q_leg_direction_counts(spark, sf_dir):
    return tt.leg_direction_counts(tt.direction_legs(visits(spark, sf_dir)))


BATCH_QUERIES = {
    "tap_envelope": q_tap_envelope,
    "tap_pattern_filter": q_tap_pattern_filter,
    "tap_type_filter": q_tap_type_filter,
    "tap_range_filter": q_tap_range_filter,
    "good_taps": q_good_taps,
    "good_taps_strict": q_good_taps_strict,
    "tap_dedup": q_tap_dedup,
    "reject_reason": q_reject_reason,
    "reject_counts": q_reject_counts,
    "dead_letter": q_dead_letter,
    "dead_letter_strict": q_dead_letter_strict,
    "trips": q_trips,
    "open_taps": q_open_taps,
    "trips_max_open": q_trips_max_open,
    "expired_taps": q_expired_taps,
    "trip_rule_violations": q_trip_rule_violations,
    "bus_tap_counts": q_bus_tap_counts,
    "bus_aboard": q_bus_aboard,
    "occupancy": q_occupancy,
    "crowd_flags": q_crowd_flags,
    "crowd_flags_windowed": q_crowd_flags_windowed,
    "occupancy_idle_reset": q_occupancy_idle_reset,
    "nearest_segment": q_nearest_segment,
    "nearest_segment_join": q_nearest_segment_join,
    "tap_type_counts": q_tap_type_counts,
    "first_taps": q_first_taps,
    "bus_partition_sizes": q_bus_partition_sizes,
    "timetable": q_timetable,
    "timetable_head": q_timetable_head,
    "direction_legs": q_direction_legs,
    "leg_stops": q_leg_stops,
    "leg_direction_counts": q_leg_direction_counts,
}
