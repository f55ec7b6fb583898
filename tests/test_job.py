"""The four-output streaming job on an envelope stream from files."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tapflow.operators import trips as tr
from tapflow.operators.dedup import dedup_taps
from tapflow.operators.validate import dead_letter, select_tap_fields, valid_taps
from tapflow.plans.batch import decoded_envelope, good_taps
from tapflow.schemas import ENVELOPE_SCHEMA
from tapflow.sources.envelope import envelope_taps
from tapflow.sources.fixtures import tap_envelope_source
from tapflow.streaming.job import JobConfig, start_job
from tapflow.streaming.run import drain


def test_job_outputs(spark, workdir):
    src = os.path.join(workdir, "envelopes")
    env = tap_envelope_source(spark, SF_SMALL).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    env.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(src)
    taps = envelope_taps(stream, ntz_event_time=False)
    cfg = JobConfig(checkpoint_base=os.path.join(workdir, "ck"),
                    output_base=os.path.join(workdir, "out"), max_open_seconds=None,
                    ordered_pairing=False)
    queries = start_job(taps, cfg, trigger_override={"availableNow": True})
    for q in queries.values():
        drain(q)
    out = os.path.join(workdir, "out")
    raw = spark.read.parquet(f"{out}/raw_events")
    trips = spark.read.parquet(f"{out}/trips")
    dlq = spark.read.parquet(f"{out}/dlq/raw_bad")
    good = dedup_taps(select_tap_fields(valid_taps(decoded_envelope(spark, SF_SMALL))))
    assert good_taps(spark, SF_SMALL).count() == 750
    assert raw.count() == good.count() == 747       # three carry an unreadable time
    want = tr.trips(good)
    key = ["card_id", "tap_in_tx_id", "tap_out_tx_id"]
    assert sorted(trips.select(*key).collect()) == sorted(want.select(*key).collect())
    assert dlq.count() == dead_letter(decoded_envelope(spark, SF_SMALL)).count()
    assert set(r.error_reason for r in dlq.select("error_reason").distinct().collect()) >= {
        "invalid_event_type", "missing_timestamp", "invalid_timestamp_parse"}
    # nobody is crowded in so few taps: the empty batch leaves no files
    assert not [f for _, _, files in os.walk(f"{out}/crowd_flags") for f in files if f.endswith(".parquet")]


def test_job_strict_and_ordered(spark, workdir):
    src = os.path.join(workdir, "envelopes")
    env = tap_envelope_source(spark, SF_SMALL).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    env.coalesce(1).write.parquet(src)
    taps = envelope_taps(spark.readStream.schema(ENVELOPE_SCHEMA).parquet(src),
                         ntz_event_time=False)
    cfg = JobConfig(checkpoint_base=os.path.join(workdir, "ck"),
                    output_base=os.path.join(workdir, "out"), max_open_seconds=None,
                    strict_reference=True, ordered_pairing=True)
    for q in start_job(taps, cfg, trigger_override={"availableNow": True}).values():
        drain(q)
    out = os.path.join(workdir, "out")
    reasons = {r.error_reason for r in spark.read.parquet(f"{out}/dlq/raw_bad")
               .select("error_reason").distinct().collect()}
    assert reasons and reasons <= {"missing_timestamp", "invalid_timestamp_parse", "invalid_latitude",
                                   "invalid_longitude"}
    key = ["card_id", "tap_in_tx_id", "tap_out_tx_id"]
    got = {tuple(r) for r in spark.read.parquet(f"{out}/trips").select(*key).collect()}
    good = dedup_taps(select_tap_fields(valid_taps(decoded_envelope(spark, SF_SMALL))))
    want = {tuple(r) for r in tr.trips(good).select(*key).collect()}
    assert got and got <= want


def test_jdbc_outputs_of_the_job(spark, workdir):
    """No database may run here: the writes are handed to a stub."""
    from tapflow.sinks.tables import jdbc_properties
    from tapflow.streaming.job import default_sinks
    calls = []

    def append(df, url, table, properties):
        rows = [r[0] for r in df.collect()]
        if rows:
            calls.append((url, table, properties, df.columns, rows))

    props = jdbc_properties("u", "p", sslmode="disable")
    assert {k: props[k] for k in ("batchsize", "isolationLevel", "stringtype", "options", "sslmode")} == {
        "batchsize": "500", "isolationLevel": "READ_COMMITTED", "stringtype": "unspecified",
        "options": "-c TimeZone=UTC", "sslmode": "disable"}
    cfg = JobConfig(checkpoint_base=workdir, output_base=workdir,
                    jdbc={"url": "jdbc:x", "properties": props, "append": append})
    sinks = default_sinks(cfg)
    trips = tr.trips(good_taps(spark, SF_SMALL)).limit(2)
    both = trips.selectExpr("'trip' AS record_type", "*").unionByName(
        trips.selectExpr("'expired' AS record_type", "*"))
    sinks["trips"](both, 0)
    sinks["raw"](good_taps(spark, SF_SMALL).limit(0), 0)        # an empty batch appends nothing
    assert [(c[0], c[1], len(c[4])) for c in calls] == [("jdbc:x", "trips", 2)]
    assert calls[0][3] == trips.columns
    cfg.jdbc["tap_ids"] = False
    default_sinks(cfg)["trips"](both, 1)
    assert calls[1][3] == ["trip_id", "card_id", "bus_id", "tap_in_time", "tap_out_time", "tap_in_lat", "tap_in_lon",
                           "tap_out_lat", "tap_out_lon"]


def test_flags_of_idle_reset_counts(spark, workdir):
    """Twenty aboard, a long break, five aboard: flags before the break only."""
    import datetime as dt
    from tapflow.streaming.job import build_outputs, output_mode
    from tapflow.streaming.run import start_file_sink
    t0, src = dt.datetime(2024, 1, 1, 8), os.path.join(workdir, "taps")
    rows = [(f"{i:036d}", f"C{i}", "BUS-1" if i < 25 else "BUS-2", "tap_in",
             t0 + dt.timedelta(minutes=i if i < 20 else i + 100 if i < 25 else 1000), -6.2, 106.82) for i in range(26)]
    taps = spark.createDataFrame(rows, "transaction_id string, card_id string, bus_id string, event_type string, "
                                       "event_time timestamp, latitude double, longitude double")
    taps.coalesce(1).write.parquet(src)
    cfg = JobConfig(checkpoint_base=workdir, output_base=workdir, crowd_idle_seconds=3600)
    flags = build_outputs(spark.readStream.schema(taps.schema).parquet(src), cfg)["flags"]
    assert output_mode(cfg, "flags") == "append" and output_mode(cfg, "raw") == "append"
    out = os.path.join(workdir, "out")
    drain(start_file_sink(flags, out, os.path.join(workdir, "ck")))
    got = sorted((r.flagged_at, r.pending_count, r.message[:12]) for r in spark.read.parquet(out).collect())
    assert [(g[0], g[1]) for g in got] == [(t0 + dt.timedelta(minutes=m), m + 1) for m in range(15, 20)]
    assert all(g[2] == "[CROWD FLAG]" for g in got)
