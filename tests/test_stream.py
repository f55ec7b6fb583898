"""Streams: several micro-batches, restart from the checkpoint, expiry."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MEDIUM, SF_SMALL
from tapflow.operators import trips as tr
from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.occupancy import bus_aboard
from tapflow.operators.validate import select_tap_fields, valid_taps
from tapflow.plans.batch import good_taps
from tapflow.sources.fixtures import taps
from tapflow.streaming.crowd import crowd_counts_stream
from tapflow.streaming.pairing import pair_taps_stream
from tapflow.streaming.run import drain, start_file_sink, start_foreach_batch
from tapflow.streaming.sources import tap_files_stream
from tapflow.sinks.tables import parquet_batch_writer


def _write_slices(spark, sf_dir, folder, n):
    """Taps split by event_id range into ``n`` files, written one after the
    other so the file stream sees them in event-time order."""
    t = taps(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    hi = t.agg(F.max("event_id")).first()[0] + 1
    bounds = [hi * i // n for i in range(n + 1)]
    for i in range(n):
        (t.where((F.col("event_id") >= bounds[i]) & (F.col("event_id") < bounds[i + 1]))
          .coalesce(1).write.mode("append").parquet(folder))


def _good_stream(spark, folder):
    return select_tap_fields(dedup_taps_stream(valid_taps(tap_files_stream(spark, folder))))


def _trip_keys(rows):
    return sorted((r.card_id, r.tap_in_tx_id, r.tap_out_tx_id) for r in rows)


@pytest.mark.parametrize("n_files", [1, 5])
def test_stream_trips_equal_batch(spark, workdir, n_files):
    src = os.path.join(workdir, "src")
    _write_slices(spark, SF_MEDIUM, src, n_files)
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    q = drain(start_file_sink(pair_taps_stream(_good_stream(spark, src), ordered=False), out, ck))
    assert len(q.recentProgress) >= n_files
    got = spark.read.parquet(out).where("record_type = 'trip'")
    want = tr.trips(good_taps(spark, SF_MEDIUM))
    assert _trip_keys(got.collect()) == _trip_keys(want.collect())


def test_restart_carries_state(spark, workdir):
    """Batch 1 holds a tap_in, batch 2 (after a restart) its tap_out."""
    src = os.path.join(workdir, "src")
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    schema = ("event_id long, transaction_id string, card_id string, bus_id string, "
              "event_type string, event_time timestamp, latitude double, longitude double")
    t = dt.datetime(2024, 1, 1, 8)
    spark.createDataFrame([(1, "0" * 35 + "1", "C1", "BUS-01", "tap_in", t, -6.2, 106.8)],
                          schema).coalesce(1).write.mode("append").parquet(src)
    drain(start_file_sink(pair_taps_stream(_good_stream(spark, src), ordered=False), out, ck))
    assert spark.read.parquet(out).count() == 0
    spark.createDataFrame([(2, "0" * 35 + "2", "C1", "BUS-03", "tap_out",
                            t + dt.timedelta(minutes=20), -6.21, 106.81)],
                          schema).coalesce(1).write.mode("append").parquet(src)
    drain(start_file_sink(pair_taps_stream(_good_stream(spark, src), ordered=False), out, ck))
    rows = spark.read.parquet(out).collect()
    assert [(r.record_type, r.bus_id, r.tap_in_tx_id[-1], r.tap_out_tx_id[-1])
            for r in rows] == [("trip", "BUS-01", "1", "2")]


def test_event_time_expiry_across_batches(spark, workdir):
    src = os.path.join(workdir, "src")
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    schema = ("event_id long, transaction_id string, card_id string, bus_id string, "
              "event_type string, event_time timestamp, latitude double, longitude double")
    t = dt.datetime(2024, 1, 1, 8)
    h = dt.timedelta(hours=1)
    batches = [
        [(1, "0" * 35 + "1", "C1", "BUS-01", "tap_in", t, -6.2, 106.8)],
        [(2, "0" * 35 + "2", "C9", "BUS-01", "tap_in", t + 3 * h, -6.2, 106.8)],   # clock moves
        [(3, "0" * 35 + "3", "C1", "BUS-01", "tap_out", t + 3 * h + h / 2, -6.2, 106.8)],
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    drain(start_file_sink(pair_taps_stream(_good_stream(spark, src), max_open_seconds=7200, ordered=False),
                          out, ck))
    rows = spark.read.parquet(out).collect()
    assert sorted((r.record_type, r.card_id) for r in rows) == [("expired", "C1")]


def test_duplicates_across_batches_dropped(spark, workdir):
    src = os.path.join(workdir, "src")
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    schema = ("event_id long, transaction_id string, card_id string, bus_id string, "
              "event_type string, event_time timestamp, latitude double, longitude double")
    t = dt.datetime(2024, 1, 1, 8)
    row = (1, "0" * 35 + "1", "C1", "BUS-01", "tap_in", t, -6.2, 106.8)
    later = (2, "0" * 35 + "2", "C1", "BUS-01", "tap_in", t + dt.timedelta(minutes=1), -6.2, 106.8)
    for b in ([row], [row, later]):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    drain(start_file_sink(_good_stream(spark, src), out, ck))
    assert spark.read.parquet(out).count() == 2


def test_stream_counts_end_at_batch_counts(spark, workdir):
    src = os.path.join(workdir, "src")
    _write_slices(spark, SF_SMALL, src, 4)
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    drain(start_foreach_batch(crowd_counts_stream(_good_stream(spark, src)),
                              parquet_batch_writer(out), ck, output_mode="update"))
    b = spark.read.parquet(out)
    last = b.groupBy("bus_id").agg(F.max(F.struct("batch_id", "pending_count")).alias("r"))
    got = sorted((r.bus_id, r.r.pending_count) for r in last.collect())
    want = sorted((r.bus_id, r.pending_count) for r in bus_aboard(good_taps(spark, SF_SMALL)).collect())
    assert got == want


def test_late_rows_dropped(spark, workdir):
    """A row older than the watermark (latest event time - 5 min) is dropped;
    an on-time one is kept.  Spark filters late rows of batch N with the
    watermark batch N-1 started with (SURVEY M8), so lateness applies from
    the second batch after the clock moved."""
    src = os.path.join(workdir, "src")
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    schema = ("event_id long, transaction_id string, card_id string, bus_id string, "
              "event_type string, event_time timestamp, latitude double, longitude double")
    t = dt.datetime(2024, 1, 1, 10)
    m = dt.timedelta(minutes=1)
    batches = [
        [(1, "0" * 35 + "1", "C1", "BUS-01", "tap_in", t, -6.2, 106.8)],
        [(4, "0" * 35 + "4", "C4", "BUS-01", "tap_in", t + m, -6.2, 106.8)],
        [(2, "0" * 35 + "2", "C2", "BUS-01", "tap_in", t - 60 * m, -6.2, 106.8),    # late
         (3, "0" * 35 + "3", "C3", "BUS-01", "tap_in", t - 2 * m, -6.2, 106.8)],    # on time
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    drain(start_file_sink(_good_stream(spark, src), out, ck))
    got = sorted(r.transaction_id[-1] for r in spark.read.parquet(out).collect())
    assert got == ["1", "3", "4"]


def test_batch_writer_reports_rows_once(spark, workdir):
    counts = {}
    df = spark.range(7).withColumnRenamed("id", "x")
    parquet_batch_writer(os.path.join(workdir, "o"), counts=counts)(df, 3)
    assert counts == {3: 7}
    assert spark.read.parquet(os.path.join(workdir, "o")).count() == 7


def test_pairing_function_empty_batch():
    """A group called with no rows and no state yields an empty frame."""
    from tapflow.streaming.pairing import make_pairing_function

    class NoState:
        exists = False
        hasTimedOut = False

    out = list(make_pairing_function(None, ordered=False)(("C1",), iter([]), NoState()))
    assert len(out) == 1 and out[0].empty


def test_ordered_mode_pairs_out_of_order_arrivals(spark, workdir):
    """A tap_out that arrives one batch after a newer tap_in of the same card
    (but within the watermark delay) pairs as in the batch form only when
    rows are held until the watermark passes them."""
    schema = ("event_id long, transaction_id string, card_id string, bus_id string, "
              "event_type string, event_time timestamp, latitude double, longitude double")
    t = dt.datetime(2024, 1, 1, 8)
    m = dt.timedelta(minutes=1)
    tx = lambda i: "0" * 35 + str(i)
    batches = [
        [(1, tx(1), "C1", "BUS-01", "tap_in", t, -6.2, 106.8),
         (3, tx(3), "C1", "BUS-01", "tap_in", t + 3 * m, -6.2, 106.8)],
        [(2, tx(2), "C1", "BUS-01", "tap_out", t + 2 * m, -6.2, 106.8)],      # arrives late
        [(4, tx(4), "C1", "BUS-01", "tap_out", t + 4 * m, -6.2, 106.8)],
        [(9, tx(9), "C9", "BUS-01", "tap_in", t + 60 * m, -6.2, 106.8)],     # moves the clock
        [(8, tx(8), "C8", "BUS-01", "tap_in", t + 120 * m, -6.2, 106.8)],
    ]
    rows = [r for b in batches for r in b]
    want_df = spark.createDataFrame(rows, schema).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz"))
    want = _trip_keys(tr.trips(select_tap_fields(want_df)).collect())
    assert [(w[1][-1], w[2][-1]) for w in want] == [("1", "2"), ("3", "4")]

    results = {}
    for ordered in (False, True):
        src = os.path.join(workdir, f"src{ordered}")
        out, ck = os.path.join(workdir, f"out{ordered}"), os.path.join(workdir, f"ck{ordered}")
        for b in batches:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
        drain(start_file_sink(pair_taps_stream(_good_stream(spark, src), ordered=ordered), out, ck))
        results[ordered] = _trip_keys(spark.read.parquet(out).where("record_type = 'trip'").collect())
    assert results[True] == want
    # in arrival order the late tap_out finds the newer tap_in, before which it lies
    assert [(w[1][-1], w[2][-1]) for w in results[False]] != [("1", "2"), ("3", "4")]
    assert ("3", "2") not in [(w[1][-1], w[2][-1]) for w in results[False]]


@pytest.mark.parametrize("name", ["tap_dedup_stream", "trips_ordered_stream"])
def test_streams_read_folders_of_files_in_any_order(spark, workdir, name):
    """A table of part files whose times run backwards gives the batch rows."""
    from tapflow.plans.registry import all_queries
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for part in (3, 1, 2, 0):
        ev.where(F.floor(F.col("event_id") / 250) == part).coalesce(1).write.mode("append").parquet(
            os.path.join(workdir, "events.parquet"))
    q = all_queries()
    batch = {"tap_dedup_stream": "good_taps", "trips_ordered_stream": "trips"}[name]
    key = {"tap_dedup_stream": "transaction_id", "trips_ordered_stream": "trip_id"}[name]
    got = sorted(r[0] for r in q[name](spark, workdir).select(key).collect())
    assert got == sorted(r[0] for r in q[batch](spark, SF_SMALL).select(key).collect())


def test_drain_raises_on_timeout(spark, workdir):
    rate = spark.readStream.format("rate").load()
    q = start_file_sink(rate, os.path.join(workdir, "o"), os.path.join(workdir, "c"),
                        trigger={"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        drain(q, timeout_s=2)
    assert not q.isActive


def test_fresh_checkpoint_keeps_earlier_output(spark, workdir):
    from tapflow.streaming.run import start_foreach_batch
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    for k in (1, 5):
        spark.createDataFrame([(k,)], "x long").coalesce(1).write.mode("overwrite").parquet(src)
        ck = os.path.join(workdir, f"ck{k}")
        stream = spark.readStream.schema("x long").parquet(src)
        drain(start_foreach_batch(stream, parquet_batch_writer(out, checkpoint=ck), ck))
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [1, 5]


def test_empty_batches_write_nothing(spark, workdir):
    counts = {}
    write = parquet_batch_writer(os.path.join(workdir, "o"), counts=counts)
    write(spark.range(0), 0)
    write(spark.range(2), 1)
    assert counts == {0: 0, 1: 2} and not os.path.exists(os.path.join(workdir, "o", "batch_id=0"))
