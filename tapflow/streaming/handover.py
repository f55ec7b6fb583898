"""State handed over between runs: read from a checkpoint, or from batch.

``waiting_taps`` reads the pairing state of a stopped query out of its
checkpoint with the state data source: the tap_ins that wait for a tap_out.

``Handover`` starts a fresh query at a cut time without reading anything before
it (a new checkpoint version, a changed query, a topic whose old rows are
gone).  What the new query needs to know is computed in batch up to the cut
and written as two small tables: the open tap_ins, which enter the stream as
its first rows, and the ids of taps seen within the watermark delay before the
cut (and of the open ones), which the live rows are anti-joined with, so a
redelivered copy does not count again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.config import WATERMARK_DELAY
from tapflow.functions.times import epoch_micros
from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.trips import open_taps
from tapflow.operators.validate import select_tap_fields
from tapflow.schemas import TAP_FIELDS
from tapflow.streaming.pairing import pair_taps_stream

PAIRING_OPERATOR = "applyInPandasWithState"


def state_operator(spark: SparkSession, checkpoint: str, name: str = PAIRING_OPERATOR) -> int:
    """The operator's number in the query's plan, from the checkpoint."""
    found = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == name)
    rows = found.select("operatorId").distinct().collect()          # a row per operator of one query
    if len(rows) != 1:
        raise ValueError(f"{len(rows)} operators named {name} in {checkpoint}")
    return rows[0][0]


def waiting_taps(spark: SparkSession, checkpoint: str) -> DataFrame:
    """D2 from the pairing state: cards whose tap_in waits for a tap_out."""
    state = (spark.read.format("statestore").option("operatorId", state_operator(spark, checkpoint)).load(checkpoint)
             .select(F.col("value.groupState").alias("s")).where("s.settled > 0"))
    rows = F.arrays_zip(*[F.col(f"s.{c}").alias(c) for c in ("cards", "ids", "buses", "times_us", "lats", "lons")])
    # the waiting ones come first in a bucket's rows
    first = state.select(F.explode(F.slice(rows, 1, F.col("s.settled"))).alias("w"))
    return first.select(F.col("w.cards").alias("card_id"), F.col("w.ids").alias("tap_in_tx_id"),
                        F.col("w.buses").alias("bus_id"), F.timestamp_micros("w.times_us").alias("tap_in_time"),
                        F.col("w.lats").alias("tap_in_lat"), F.col("w.lons").alias("tap_in_lon"))


@dataclass
class Handover:
    """Paths of the written tables."""
    open_path: str
    seen_path: str

    def seed_stream(self, spark: SparkSession) -> DataFrame:
        """The open tap_ins as stream rows (seven tap fields)."""
        schema = spark.read.parquet(self.open_path).schema
        return spark.readStream.schema(schema).parquet(self.open_path)

    def unseen(self, live: DataFrame) -> DataFrame:
        """Live rows whose id was not handed over."""
        return live.join(live.sparkSession.read.parquet(self.seen_path), "transaction_id", "left_anti")


def write_handover(good_before: DataFrame, base: str, cut_us: int, watermark_delay: str = WATERMARK_DELAY) -> Handover:
    """From de-duplicated good taps before the cut (epoch microseconds)."""
    out = Handover(f"{base.rstrip('/')}/open", f"{base.rstrip('/')}/seen")
    waiting = open_taps(good_before)
    as_taps = waiting.select(F.col("tap_in_tx_id").alias("transaction_id"), "card_id", "bus_id",
                             F.lit("tap_in").alias("event_type"),
                             F.timestamp_micros(epoch_micros(waiting, "tap_in_time")).alias("event_time"),
                             F.col("tap_in_lat").alias("latitude"), F.col("tap_in_lon").alias("longitude"))
    as_taps.write.parquet(out.open_path)
    spark = good_before.sparkSession
    recent = epoch_micros(good_before, "event_time") >= F.lit(cut_us) - _micros(watermark_delay)
    (good_before.where(recent).select("transaction_id")
     .union(spark.read.parquet(out.open_path).select("transaction_id")).distinct().write.parquet(out.seen_path))
    return out


def _micros(interval: str):
    return F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {interval})")


def resumed_pairs(handover: Handover, live_good: DataFrame, max_open_seconds: int | None = None, ordered: bool = True,
                  watermark_delay: str = WATERMARK_DELAY) -> DataFrame:
    """Pairing of live good taps (not de-duplicated) behind a handover.  The
    open taps come with the first micro-batch, whose rows are never late."""
    live = handover.unseen(live_good.select(*TAP_FIELDS))
    rows = live.unionByName(handover.seed_stream(live_good.sparkSession))
    good = select_tap_fields(dedup_taps_stream(rows, watermark_delay=watermark_delay))
    return pair_taps_stream(good, max_open_seconds=max_open_seconds, ordered=ordered)
