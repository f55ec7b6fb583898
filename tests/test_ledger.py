"""Batches committed once; the job on one read of its source."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tapflow.operators import trips as tr
from tapflow.operators.dedup import dedup_taps
from tapflow.operators.validate import dead_letter, select_tap_fields, valid_taps
from tapflow.plans.batch import decoded_envelope
from tapflow.schemas import ENVELOPE_SCHEMA
from tapflow.sinks.ledger import CommittedTable, fan_out, follow_committed, read_committed, upsert_sql
from tapflow.sources.envelope import envelope_taps
from tapflow.sources.fixtures import tap_envelope_source
from tapflow.streaming.job import JobConfig, start_shared_job
from tapflow.streaming.run import drain, start_foreach_batch


class Crash(RuntimeError):
    pass


def _numbers(spark, folder, values):
    spark.createDataFrame([(v,) for v in values], "x long").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("x long").option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("when", ["before_commit", "after_commit"])
def test_a_failure_between_two_sinks(spark, workdir, when):
    """The second sink fails; the retry writes it, and the first not again."""
    src, ck = os.path.join(workdir, "src"), os.path.join(workdir, "ck")
    a, b = os.path.join(workdir, "a"), os.path.join(workdir, "b")
    _numbers(spark, src, [1, 2])
    stream = _numbers(spark, src, [3])
    left = [1]

    def fail(name, batch_id):
        if left:
            left.pop()
            raise Crash(name)

    def run():
        sinks = {"a": CommittedTable(a, ck, lambda d: d.where("x > 1")), "b": CommittedTable(b, ck, **{when: fail})}
        return drain(start_foreach_batch(stream, fan_out(sinks), ck))

    with pytest.raises(Exception):
        run()
    first = {f: os.listdir(os.path.join(a, f)) for f in os.listdir(a) if f.startswith("run-")}
    assert len(first) == 1
    if when == "before_commit":
        assert read_committed(spark, b, "x long").count() == 0      # staged rows are not seen
    run()
    assert all(os.listdir(os.path.join(a, f)) == files for f, files in first.items())
    assert sorted(r.x for r in read_committed(spark, a, "x long").collect()) == [2, 3]
    assert sorted(r.x for r in read_committed(spark, b, "x long").collect()) == [1, 2, 3]
    followed = os.path.join(workdir, "followed")
    drain(follow_committed(spark, b, "x long").writeStream.format("parquet").option("path", followed)
          .option("checkpointLocation", os.path.join(workdir, "ck2")).trigger(availableNow=True).start())
    assert sorted(r.x for r in spark.read.parquet(followed).collect()) == [1, 2, 3]


def test_upsert_text():
    assert upsert_sql("trips", "trips_new", ["trip_id", "card_id"], ["trip_id"]) == (
        "INSERT INTO trips (trip_id, card_id) SELECT trip_id, card_id FROM trips_new ON CONFLICT (trip_id) DO NOTHING")


def test_job_reads_its_source_once(spark, workdir):
    """Four outputs, one query on the source, a crash between its sinks."""
    src, out = os.path.join(workdir, "envelopes"), os.path.join(workdir, "out")
    env = tap_envelope_source(spark, SF_SMALL).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    env.coalesce(1).write.parquet(src)
    taps = envelope_taps(spark.readStream.schema(ENVELOPE_SCHEMA).parquet(src), ntz_event_time=False)
    cfg = JobConfig(checkpoint_base=os.path.join(workdir, "ck"), output_base=out, max_open_seconds=None, ordered_pairing=False)
    left = [1]

    def fail(name, batch_id):
        if left:
            left.pop()
            raise Crash(name)

    with pytest.raises(Exception):
        start_shared_job(taps, cfg, {"availableNow": True}, hooks={"valid": {"before_commit": fail}})
    queries = start_shared_job(taps, cfg, {"availableNow": True})
    for q in queries.values():
        drain(q)
    reading = [n for n, q in queries.items() if any(src in s["description"] for p in q.recentProgress for s in p["sources"])]
    assert reading == ["shared"] and set(queries) == {"shared", "raw", "trips", "flags"}
    good = dedup_taps(select_tap_fields(valid_taps(decoded_envelope(spark, SF_SMALL))))
    assert spark.read.parquet(f"{out}/raw_events").count() == good.count() == 747
    key = ["card_id", "tap_in_tx_id", "tap_out_tx_id"]
    assert sorted(spark.read.parquet(f"{out}/trips").select(*key).collect()) == sorted(tr.trips(good).select(*key).collect())
    bad = dead_letter(decoded_envelope(spark, SF_SMALL))
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/dlq/raw_bad").count() == bad.count()
