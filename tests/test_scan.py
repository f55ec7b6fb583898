"""The sliced scans equal the single-window forms, including a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapflow.operators.scan import prefix_sums, with_neighbor


def _rows(seed, n=600):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "HOT" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}"
        # repeated timestamps on purpose: the id breaks the tie
        ts = t0 + dt.timedelta(seconds=rnd.randint(0, 4 * 3600) // 30 * 30)
        rows.append((key, ts, f"id{i:05d}", rnd.choice([1, -1]), rnd.random()))
    return rows


@pytest.fixture(params=[1, 2, 3])
def frame(spark, request):
    df = spark.createDataFrame(_rows(request.param),
                               "k string, event_time timestamp_ntz, id string, d int, x double")
    return df


# (hot_key_rows, sample_every): slice every key / only hot keys found on all
# rows / only hot keys found on a 1-in-3 hash sample / no key hot (defaults)
HOT_MODES = [(None, 1), (50, 1), (50, 3), (2_000_000, 1000)]


@pytest.mark.parametrize("hot", HOT_MODES)
@pytest.mark.parametrize("bucket", [60, 600, 3600])
def test_prefix_sums_equal_plain_window(frame, bucket, hot):
    w = Window.partitionBy("k").orderBy("event_time", "id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    want = frame.withColumn("s", F.sum("d").over(w)).select("id", "s")
    got = prefix_sums(frame, ["k"], ["event_time", "id"], {"s": F.col("d")},
                      bucket_seconds=bucket, hot_key_rows=hot[0],
                      sample_every=hot[1]).select("id", "s")
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("hot", HOT_MODES)
@pytest.mark.parametrize("direction", ["previous", "next"])
@pytest.mark.parametrize("bucket", [60, 900])
def test_neighbor_equals_lag_lead(frame, bucket, direction, hot):
    w = Window.partitionBy("k").orderBy("event_time", "id")
    fn = F.lag if direction == "previous" else F.lead
    want = frame.select("id", fn("id").over(w).alias("n"), fn("x").over(w).alias("nx"))
    got = with_neighbor(frame, ["k"], ["event_time", "id"], ["x"], "nb",
                        direction=direction, bucket_seconds=bucket,
                        hot_key_rows=hot[0], sample_every=hot[1])
    got = got.select("id", F.col("nb.id").alias("n"), F.col("nb.x").alias("nx"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_null_keys_are_scanned_together(spark):
    df = spark.createDataFrame(
        [(None, dt.datetime(2024, 1, 1, 0, 0, s), f"i{s}", 1, 0.0) for s in range(5)],
        "k string, event_time timestamp_ntz, id string, d int, x double")
    for hot in HOT_MODES:
        got = prefix_sums(df, ["k"], ["event_time", "id"], {"s": F.col("d")}, bucket_seconds=2,
                          hot_key_rows=hot[0] and 2, sample_every=hot[1])
        assert sorted(r.s for r in got.collect()) == [1, 2, 3, 4, 5]


def test_only_hot_key_is_sliced(frame):
    """The hot key is split into slices; the others stay one group each."""
    from tapflow.operators.scan import _hot_slices
    d = _hot_slices(frame, ["k"], ["event_time", "id"], "event_time", 600, 100, 1)
    per_key = {r.k: r.n for r in d.groupBy("k").agg(
        F.count_distinct("_scan_bucket").alias("n")).collect()}
    assert per_key["HOT"] > 1
    assert all(n == 0 for k, n in per_key.items() if k != "HOT")


def test_slices_follow_the_times(spark):
    """One early row does not undo the split of a key that is busy later."""
    from tapflow.operators.scan import _hot_slices
    t = dt.datetime(2024, 1, 1)
    rows = [("HOT", t - dt.timedelta(days=365), "first", 1, 0.0)] + [
        ("HOT", t + dt.timedelta(milliseconds=600 * i), f"i{i:04d}", 1, 0.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, event_time timestamp_ntz, id string, d int, x double")
    d = _hot_slices(df, ["k"], ["event_time", "id"], "event_time", 3600, 100, 1)
    sizes = [r["count"] for r in d.groupBy("_scan_bucket").count().collect()]
    assert max(sizes) <= 60 and sum(sizes) == 1001


@pytest.mark.parametrize("hot", HOT_MODES)
def test_rows_without_a_time(spark, hot):
    rows = _rows(7, 200) + [("HOT", None, f"n{i}", 1, 0.5) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, event_time timestamp_ntz, id string, d int, x double")
    w = Window.partitionBy("k").orderBy("event_time", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("id", F.sum("d").over(upto).alias("s"), F.max("x").over(upto).alias("m"),
                     F.lag("id").over(w).alias("p"))
    kw = {"bucket_seconds": 600, "hot_key_rows": hot[0], "sample_every": hot[1]}
    got = prefix_sums(df, ["k"], ["event_time", "id"], {"s": F.col("d")}, {"m": F.col("x")}, **kw)
    got = with_neighbor(got, ["k"], ["event_time", "id"], [], "nb", **kw)
    got = got.select("id", "s", "m", F.col("nb.id").alias("p"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_no_hot_key_is_the_plain_window(frame):
    plan = prefix_sums(frame, ["k"], ["event_time", "id"], {"s": F.col("d")})._jdf.queryExecution().executedPlan().toString()
    assert "_scan_bucket" not in plan and "Join" not in plan


def test_plan_splits_hot_key_by_slice(frame):
    """The main window is partitioned by (key, slice), not by key alone."""
    got = prefix_sums(frame, ["k"], ["event_time", "id"], {"s": F.col("d")}, bucket_seconds=60,
                      hot_key_rows=50, sample_every=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_scan_bucket" in plan
