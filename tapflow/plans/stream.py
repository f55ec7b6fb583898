"""Streaming plans, run to completion with ``availableNow``.

Each plan streams the driver's ``events`` file as taps, runs the stateful
operator, writes to a fresh folder under the shared checkpoint directory
and returns the written table read back as a batch DataFrame (event times
as naive UTC, like the batch plans).
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapflow.config import PAIRING_TIMEOUT_SECONDS
from tapflow.functions.times import as_ntz, epoch_micros
from tapflow.operators import trips as tr
from tapflow.operators.dedup import dedup_taps, dedup_taps_stream
from tapflow.operators.validate import select_tap_fields, valid_taps
from tapflow.schemas import TAP_FIELDS, TRIP_COLUMNS
from tapflow.session import scratch_path
from tapflow.sources.fixtures import taps
from tapflow.streaming.account import FIELDS, RowAccount, accounted_taps
from tapflow.streaming.crowd import crowd_counts_stream, crowd_flags_from_counts
from tapflow.streaming.handover import resumed_pairs, waiting_taps, write_handover
from tapflow.streaming.key_store import KeyStore
from tapflow.streaming.occupancy import (
    INTERVAL_SCHEMA, closed_intervals_stream, crowd_flags_windowed_stream, crowd_sessions_stream,
    occupancy_idle_reset_stream,
)
from tapflow.streaming.pairing import pair_taps_stream
from tapflow.streaming.replay import SLICES, Replay, make_folder
from tapflow.streaming.run import drain, start_file_sink, start_foreach_batch
from tapflow.streaming.sources import taps_stream
from tapflow.sinks.ledger import CommittedTable, fan_out, read_committed
from tapflow.sinks.tables import parquet_batch_writer


def good_taps_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_tap_fields(dedup_taps_stream(valid_taps(taps_stream(spark, sf_dir)).select(*TAP_FIELDS)))


def _ntz(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, as_ntz(df, c))
    return df


def _run_append(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    drain(start_file_sink(stream, out, ckpt))
    return spark.read.schema(stream.schema).parquet(out)


def q_tap_dedup_stream(spark, sf_dir):
    return _ntz(_run_append(spark, good_taps_stream(spark, sf_dir), "dedup"), ["event_time"])


def _pairing_output(spark, sf_dir, max_open):
    s = pair_taps_stream(good_taps_stream(spark, sf_dir), max_open_seconds=max_open, ordered=False)
    return _ntz(_run_append(spark, s, "pairing"), ["tap_in_time", "tap_out_time"])


def q_trips_stream(spark, sf_dir):
    return _pairing_output(spark, sf_dir, None).where(
        F.col("record_type") == "trip").select(*TRIP_COLUMNS)


def q_trips_max_open_stream(spark, sf_dir):
    return _pairing_output(spark, sf_dir, PAIRING_TIMEOUT_SECONDS).where(
        F.col("record_type") == "trip").select(*TRIP_COLUMNS)


def _crowd_batches(spark, sf_dir) -> DataFrame:
    counts = crowd_counts_stream(good_taps_stream(spark, sf_dir))
    out, ckpt = scratch_path(spark, "crowd-out"), scratch_path(spark, "crowd-ckpt")
    # a table from the start, though no batch may have rows
    spark.createDataFrame([], counts.schema).write.parquet(f"{out}/batch_id=-1")
    drain(start_foreach_batch(counts, parquet_batch_writer(out), ckpt, output_mode="update"))
    return spark.read.parquet(out)   # batch_id comes back as a partition column


def _latest_per_bus(batches: DataFrame) -> DataFrame:
    cols = [c for c in batches.columns if c not in ("bus_id", "batch_id")]
    last = batches.groupBy("bus_id").agg(F.max(F.struct("batch_id", *cols)).alias("r"))
    return last.select("bus_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def q_bus_aboard_stream(spark, sf_dir):
    """Closing aboard count per vehicle from the streaming aggregation."""
    return _latest_per_bus(_crowd_batches(spark, sf_dir)).select("bus_id", "pending_count")


def q_crowd_flags_stream(spark, sf_dir):
    """Flags from the streaming counters, one per vehicle per micro-batch
    in which it is above the threshold."""
    flags = crowd_flags_from_counts(_crowd_batches(spark, sf_dir))
    return _ntz(flags, ["flagged_at"])


# --- replays in event-time order over several micro-batches -----------------

_AT_ONCE = {"processingTime": "0 seconds"}
CLOSING = "closing"
FEW_SLICES = 4                # several micro-batches, where time order is not the point


def _stamped(df: DataFrame) -> DataFrame:
    """Times as TIMESTAMP, which watermarks need."""
    return df.withColumn("event_time", F.timestamp_micros(epoch_micros(df, "event_time")))


def _closing_row(rows: DataFrame, of: str) -> DataFrame:
    """A tap of a card and vehicle of its own, a day after the last of ``of``:
    it moves the watermark past every row of a bounded replay."""
    end = rows.agg(F.max(of).alias("t")).where("t IS NOT NULL")
    own = {"transaction_id": F.lit(CLOSING), "card_id": F.lit(CLOSING), "bus_id": F.lit(CLOSING),
           "event_type": F.lit("tap_out"), "event_time": F.col("t") + F.expr("INTERVAL 1 DAY"),
           "latitude": F.lit(0.0), "longitude": F.lit(0.0)}
    return end.select(*[own[c].alias(c) for c in TAP_FIELDS])


def _replay_rows(spark, sf_dir, closing: bool = True) -> DataFrame:
    """Valid taps, copies included, and the closing tap."""
    rows = _stamped(valid_taps(taps(spark, sf_dir)).select(*TAP_FIELDS))
    return rows.unionByName(_closing_row(rows, "event_time")) if closing else rows


def _replayed(spark, sf_dir, build, name: str, slices: int = FEW_SLICES, closing: bool = True) -> tuple[DataFrame, str]:
    """The table that ``build(good taps)`` appends to in a replay, and the
    query's checkpoint."""
    replay = Replay(_replay_rows(spark, sf_dir, closing), slices)
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    stream = build(select_tap_fields(dedup_taps_stream(replay.stream)))
    replay.run(lambda: start_file_sink(stream, out, ckpt, trigger=_AT_ONCE))
    return spark.read.schema(stream.schema).parquet(out), ckpt


def q_occupancy_idle_reset_stream(spark, sf_dir):
    """The count after each tap, idle vehicles forgotten on the way."""
    out, _ = _replayed(spark, sf_dir, occupancy_idle_reset_stream, "idle")
    out = out.where(F.col("bus_id") != CLOSING)
    # the number of a session among its vehicle's: a row per session
    number = F.row_number().over(Window.partitionBy("bus_id").orderBy("session_start")).cast("long")
    sessions = out.select("bus_id", "session_start").distinct().withColumn("session_no", number)
    return _ntz(out.join(sessions, ["bus_id", "session_start"]).select(
        "transaction_id", "bus_id", "event_time", "session_no", "pending"), ["event_time"])


def q_crowd_sessions_stream(spark, sf_dir):
    """W6 in native session windows: closed sessions."""
    out, _ = _replayed(spark, sf_dir, crowd_sessions_stream, "sessions")
    return _ntz(out.where(F.col("bus_id") != CLOSING), ["session_start", "last_event_time"])


def q_crowd_flags_windowed_stream(spark, sf_dir):
    """One flag per vehicle and interval, over two chained queries."""
    replay = Replay(_replay_rows(spark, sf_dir), FEW_SLICES)
    names = [scratch_path(spark, f"windows-{k}") for k in ("closed", "closed-ckpt", "flags", "flags-ckpt")]
    make_folder(spark, names[0])
    closed = closed_intervals_stream(select_tap_fields(dedup_taps_stream(replay.stream)))
    flags = crowd_flags_windowed_stream(spark.readStream.schema(INTERVAL_SCHEMA).parquet(names[0]))
    replay.run(lambda: start_file_sink(closed, names[0], names[1], trigger=_AT_ONCE),
               lambda: start_file_sink(flags, names[2], names[3], trigger=_AT_ONCE))
    out = spark.read.schema(flags.schema).parquet(names[2])
    return _ntz(out, ["window_start", "window_end", "flagged_at"])


def q_trips_ordered_stream(spark, sf_dir):
    """Pairing in event-time order.  A row is paired once the watermark
    has passed it; a call holds one time slice of a card."""
    out, _ = _replayed(spark, sf_dir, pair_taps_stream, "ordered", SLICES)
    return _ntz(out.where("record_type = 'trip'").select(*TRIP_COLUMNS), ["tap_in_time", "tap_out_time"])


def q_expired_taps_stream(spark, sf_dir):
    """tap_ins that waited too long, as the watermark shows it.  No closing
    tap: what is open at the end of the table stays open."""
    out, _ = _replayed(spark, sf_dir, lambda good: pair_taps_stream(good, PAIRING_TIMEOUT_SECONDS, ordered=False),
                       "expired", SLICES, closing=False)
    return _ntz(out.where("record_type = 'expired'").select(
        "card_id", "tap_in_tx_id", "bus_id", "tap_in_time", "tap_in_lat", "tap_in_lon"), ["tap_in_time"])


def q_open_taps_state(spark, sf_dir):
    """D2 read out of the pairing state's checkpoint after a replay."""
    _, ckpt = _replayed(spark, sf_dir, pair_taps_stream, "open-state")
    return _ntz(waiting_taps(spark, ckpt), ["tap_in_time"])


def trips_resumed(spark, sf_dir, cut_us: int, slices: int = FEW_SLICES) -> DataFrame:
    """Trips of the batch up to the cut, and of a fresh query that reads
    only rows from the cut on behind a handover."""
    rows = _stamped(valid_taps(taps(spark, sf_dir)).select(*TAP_FIELDS))
    at = epoch_micros(rows, "event_time")
    before = dedup_taps(rows.where(at < cut_us))
    handover = write_handover(before, scratch_path(spark, "handover"), cut_us)
    live = rows.where(at >= cut_us)
    replay = Replay(live.unionByName(_closing_row(rows, "event_time")), slices)
    out, ckpt = scratch_path(spark, "resumed-out"), scratch_path(spark, "resumed-ckpt")
    pairs = resumed_pairs(handover, replay.stream)
    replay.run(lambda: start_file_sink(pairs, out, ckpt, trigger=_AT_ONCE))
    resumed = spark.read.schema(pairs.schema).parquet(out).where("record_type = 'trip'").select(*TRIP_COLUMNS)
    return _ntz(tr.trips(before).unionByName(resumed), ["tap_in_time", "tap_out_time"])


def q_trips_resumed_stream(spark, sf_dir):
    """The cut lies in the middle of the table's time."""
    rows = valid_taps(taps(spark, sf_dir))
    us = epoch_micros(rows, "event_time")
    lo, hi = rows.agg(F.min(us), F.max(us)).first()
    return trips_resumed(spark, sf_dir, ((lo or 0) + (hi or 0)) // 2)


class _Crash(RuntimeError):
    pass


def exactly_once(spark, stream: DataFrame, replay: Replay, base: str, ckpt: str) -> DataFrame:
    """Append ``stream`` to a committed table while the writer fails once
    before a commit and once behind one; the query starts again each time."""
    failed = set()

    def crash(when):
        def hook(name, batch_id):
            if batch_id >= 1 and when not in failed:
                failed.add(when)
                raise _Crash(f"{when} {name}")
        return hook

    table = CommittedTable(base, ckpt, before_commit=crash("before"), after_commit=crash("after"))

    def start():
        return start_foreach_batch(stream, fan_out({"raw": table}), ckpt, trigger=_AT_ONCE)

    query = start()
    try:
        for folder in replay.folders:
            replay.admit(folder)
            for _ in range(3):
                try:
                    query.processAllAvailable()
                    break
                except StreamingQueryException:
                    query = start()
    finally:
        query.stop()
    if failed != {"before", "after"}:
        raise RuntimeError("the writer was to fail twice")
    return read_committed(spark, base, stream.schema)


def q_sink_raw_exactly_once(spark, sf_dir):
    """K1 with staged, committed batches, read back after two crashes."""
    replay = Replay(_replay_rows(spark, sf_dir), FEW_SLICES)
    stream = select_tap_fields(dedup_taps_stream(replay.stream))
    out = exactly_once(spark, stream, replay, scratch_path(spark, "raw-once"), scratch_path(spark, "raw-once-ckpt"))
    return _ntz(out.where(F.col("transaction_id") != CLOSING), ["event_time"])


def q_tap_dedup_unbounded_stream(spark, sf_dir):
    """W2, no key forgotten: all copies but the earliest arrive a month late."""
    rows = _replay_rows(spark, sf_dir, closing=False)
    copy = F.row_number().over(Window.partitionBy("transaction_id").orderBy("event_time", F.xxhash64(*TAP_FIELDS)))
    late = F.when(copy > 1, F.expr("INTERVAL 30 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    replay = Replay(rows.withColumn("arrival", F.col("event_time") + late), FEW_SLICES, time_col="arrival")
    ckpt = scratch_path(spark, "key-store-ckpt")
    store = KeyStore(scratch_path(spark, "key-store"), ckpt)
    replay.run(lambda: start_foreach_batch(replay.stream.select(*TAP_FIELDS), store.writer(), ckpt, trigger=_AT_ONCE))
    return _ntz(read_committed(spark, store.rows.base, rows.schema), ["event_time"])


LATE_ENDING = "7"


def q_late_tap_counts(spark, sf_dir):
    """What became of the rows of a replay in which the taps of the first
    quarter of the time whose id ends in 7 arrive behind all others."""
    rows = _stamped(taps(spark, sf_dir).select(*TAP_FIELDS))
    us = epoch_micros(rows, "event_time")
    lo, hi = valid_taps(rows).agg(F.min(us), F.max(us)).first()
    lo, hi = lo or 0, hi or 0
    late = F.col("transaction_id").endswith(LATE_ENDING) & (us < lo + (hi - lo) // 4)
    arrival = F.when(late, F.col("event_time") + F.expr("INTERVAL 1000 DAYS")).otherwise(F.col("event_time"))
    replay = Replay(rows.withColumn("arrival", arrival), SLICES, time_col="arrival")
    out, ckpt = scratch_path(spark, "account-out"), scratch_path(spark, "account-ckpt")
    name = out.rsplit("/", 1)[1]
    account = RowAccount(name)
    spark.streams.addListener(account)
    try:
        replay.run(lambda: start_file_sink(accounted_taps(replay.stream).select(*TAP_FIELDS), out, ckpt,
                                           trigger=_AT_ONCE, name=name))
        totals = account.totals() if replay.folders else dict.fromkeys(FIELDS, 0)
    finally:
        spark.streams.removeListener(account)
    return spark.createDataFrame([tuple(totals[f] for f in FIELDS)], ", ".join(f"{f} long" for f in FIELDS))


STREAM_QUERIES = {
    "tap_dedup_stream": q_tap_dedup_stream,
    "trips_stream": q_trips_stream,
    "trips_ordered_stream": q_trips_ordered_stream,
    "trips_max_open_stream": q_trips_max_open_stream,
    "expired_taps_stream": q_expired_taps_stream,
    "bus_aboard_stream": q_bus_aboard_stream,
    "crowd_flags_stream": q_crowd_flags_stream,
    "occupancy_idle_reset_stream": q_occupancy_idle_reset_stream,
    "crowd_sessions_stream": q_crowd_sessions_stream,
    "crowd_flags_windowed_stream": q_crowd_flags_windowed_stream,
    "open_taps_state": q_open_taps_state,
    "trips_resumed_stream": q_trips_resumed_stream,
    "sink_raw_exactly_once": q_sink_raw_exactly_once,
    "tap_dedup_unbounded_stream": q_tap_dedup_unbounded_stream,
    "late_tap_counts": q_late_tap_counts,
}
