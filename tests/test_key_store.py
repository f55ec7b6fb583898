"""De-duplication against written keys; the account of a stream's rows."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tapflow.operators.dedup import dedup_taps
from tapflow.sinks.ledger import read_committed
from tapflow.streaming.account import FIELDS, RowAccount, accounted_taps
from tapflow.streaming.key_store import KeyStore
from tapflow.streaming.run import drain, start_file_sink, start_foreach_batch
from tapflow.plans import stream as plans

SCHEMA = "transaction_id string, event_time timestamp, n int"


def _batch(spark, rows):
    return spark.createDataFrame([(k, t, n) for k, t, n in rows], "k string, t string, n int").select(
        F.col("k").alias("transaction_id"), F.to_timestamp("t").alias("event_time"), "n")


def _kept(spark, store):
    return sorted((r.transaction_id, r.n) for r in read_committed(spark, store.rows.base, SCHEMA).collect())


@pytest.mark.parametrize("words", [1, 1 << 21])
def test_a_copy_of_any_age_is_dropped(spark, workdir, words):
    """Whatever the filter lets through: with one word it lets all through."""
    src, ck = os.path.join(workdir, "src"), os.path.join(workdir, "ck")
    store = KeyStore(os.path.join(workdir, "store"), ck, words=words)
    batches = [[("a", "2024-01-01 00:00:00", 1), ("b", "2024-01-01 00:00:05", 2), ("b", "2024-01-01 00:00:04", 3)],
               [("a", "2024-02-01 00:00:00", 4), ("c", "2024-01-01 00:00:00", 5)],
               [("c", "2023-01-01 00:00:00", 6), ("b", "2025-01-01 00:00:00", 7), ("d", "2025-01-01 00:00:00", 8)], []]
    for rows in batches:
        _batch(spark, rows).coalesce(1).write.mode("append").parquet(src)
        drain(start_foreach_batch(spark.readStream.schema(SCHEMA).parquet(src), store.writer(), ck))
    assert _kept(spark, store) == [("a", 1), ("b", 3), ("c", 5), ("d", 8)]


def test_a_batch_run_again_after_a_failure_decides_alike(spark, workdir):
    """The keys of the batch are written, its filter is not: the retry neither
    loses its rows nor writes them twice."""
    ck = os.path.join(workdir, "ck")
    os.makedirs(ck)
    with open(os.path.join(ck, "metadata"), "w") as f:      # as a started query leaves it
        f.write('{"id":"00000000-0000-0000-0000-000000000001"}')
    store = KeyStore(os.path.join(workdir, "store"), ck)
    write = store.writer()
    write(_batch(spark, [("a", "2024-01-01 00:00:00", 1)]), 0)
    second = _batch(spark, [("a", "2024-01-01 00:00:00", 2), ("b", "2024-01-01 00:00:00", 3)])

    def fail(name, batch_id):
        raise RuntimeError(name)

    store.filters.before_commit = fail
    with pytest.raises(RuntimeError):
        write(second, 1)
    assert len(store.keys.folders(spark)) == 2 and len(store.filters.folders(spark)) == 1
    store.filters.before_commit = None
    write(second, 1)
    write(second, 1)
    write(_batch(spark, [("b", "2024-03-01 00:00:00", 4)]), 2)
    assert _kept(spark, store) == [("a", 1), ("b", 3)]


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no test data")
def test_late_rows_are_accounted_for(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    n = plans.q_late_tap_counts(spark, SF_SMALL).first().asDict()
    assert n["rows_in"] == sum(n[f] for f in FIELDS if f != "rows_in")
    assert all(n[f] > 0 for f in FIELDS)


def test_an_account_of_a_restarted_query(spark, workdir):
    """Both runs count, and a stream without rows counts nothing."""
    src, out, ck = (os.path.join(workdir, d) for d in ("src", "out", "ck"))
    taps = plans._stamped(plans.taps(spark, SF_SMALL).select(*plans.TAP_FIELDS))
    name = "account-of-two-runs"
    account = RowAccount(name)
    spark.streams.addListener(account)
    try:
        for part in (taps.where("transaction_id IS NULL"), dedup_taps(taps.where("card_id = 'C001'")), taps.limit(0)):
            part.coalesce(1).write.mode("append").parquet(src)
            stream = accounted_taps(spark.readStream.schema(taps.schema).parquet(src))
            drain(start_file_sink(stream, out, ck, name=name))
            account.totals()
    finally:
        spark.streams.removeListener(account)
    total = account.totals()
    read = spark.read.parquet(src)
    assert total["rows_in"] == read.count() and total["late"] == 0
    assert total["kept"] == spark.read.parquet(out).count()
    assert total["dead_lettered"] + total["duplicate"] + total["kept"] == total["rows_in"]
