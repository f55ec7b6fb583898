"""Ids are never cut, and copies that differ resolve by one rule."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tapflow.operators.dedup import dedup_taps
from tapflow.plans.batch import good_taps
from tapflow.sources.fixtures import taps, taps_base

SF_LARGE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.exists(SF_LARGE), reason="test data missing")
def test_every_user_has_a_card(spark):
    users = spark.read.parquet(f"{SF_LARGE}/events.parquet").select("user_id").distinct().count()
    cards = taps(spark, SF_LARGE).where("card_id RLIKE '^C[0-9]+$'").select("card_id").distinct().count()
    assert users == cards == 1500


def test_long_ids_stay_apart(spark):
    ev = spark.range(10 ** 12 + 1, 10 ** 12 + 21).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-01' AS ts", "id AS user_id", "'view' AS event_type",
        "1D AS value", "'{\"k\": 3}' AS props")
    t = taps_base(ev).where("transaction_id IS NOT NULL")
    assert t.select("transaction_id").distinct().count() == t.count()
    assert t.select("card_id").distinct().count() == t.count()


def test_earliest_copy_stays(spark):
    t = dt.datetime(2024, 1, 1, 8)
    rows = [("x", "C9", t, 1.0), ("x", "C1", t + dt.timedelta(minutes=1), 2.0), ("y", "C2", t, 3.0), ("y", "C2", t, 3.0)]
    df = spark.createDataFrame(rows, "transaction_id string, card_id string, event_time timestamp_ntz, latitude double")
    for data in (df, df.orderBy(F.desc("event_time")), df.repartition(3)):
        assert sorted(tuple(r) for r in dedup_taps(data).collect()) == [("x", "C9", t, 1.0), ("y", "C2", t, 3.0)]
        assert sorted(tuple(r) for r in dedup_taps(data, columns=["card_id"]).collect()) == [("x", "C9"), ("y", "C2")]


def test_only_needed_columns_are_shuffled(spark):
    """Beside the id, a time, a hash of the row and the wanted column travel."""
    plan = good_taps(spark, "/root/testdata/sf0.001", columns=["bus_id"])._jdf.queryExecution().executedPlan().toString()
    aggregate = re.sub(r"xxhash64\([^)]*\)", "hash", plan[:plan.index("Exchange")])
    assert "min(struct(_t" in aggregate and "hash" in aggregate
    assert "latitude" not in aggregate and "card_id" not in aggregate
