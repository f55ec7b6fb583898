"""Physical-plan guards for every registered batch plan: no cross joins,
no nested-loop joins, and only the needed columns read from the source."""

import uuid

import pytest

from tests.conftest import SF_SMALL
from tapflow.plans.batch import BATCH_QUERIES
from tapflow.plans.registry import all_queries

QUERIES = all_queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_cross_join_and_pruned_scan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # events.value is used by no query: it must never be read
    assert "value:double" not in plan


def _jobs_of(spark, build):
    """Jobs that run while ``build`` makes a plan."""
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "test")
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


SCANS = ["trips", "trips_max_open", "expired_taps", "trip_rule_violations", "occupancy", "crowd_flags", "occupancy_idle_reset",
         "timetable", "timetable_head", "direction_legs", "leg_stops", "leg_direction_counts"]


@pytest.mark.parametrize("name", SCANS)
def test_no_job_while_a_plan_is_built(spark, name):
    """Reading a file's schema is a job of its own (the table is opened for the
    taps and for their hot keys); beyond it there is none."""
    schema_jobs = _jobs_of(spark, lambda: QUERIES["good_taps"](spark, SF_SMALL))
    assert _jobs_of(spark, lambda: QUERIES[name](spark, SF_SMALL)) <= 2 * schema_jobs


@pytest.mark.parametrize("name", ["timetable", "occupancy_idle_reset", "trip_rule_violations"])
def test_one_sample_per_plan(spark, monkeypatch, name):
    """With a hot key possible, a plan samples once, on rows that no shuffle
    has moved, however many scans it chains."""
    from tapflow import config
    from tapflow.operators import scan
    monkeypatch.setattr(config, "DEFAULT_HOT_KEY_ROWS", 1000)
    seen = []
    real = scan._hot_cuts
    monkeypatch.setattr(scan, "_hot_cuts", lambda rows, *a: (seen.append(rows), real(rows, *a))[1])
    QUERIES[name](spark, SF_SMALL)
    assert len(seen) == 1 and "Exchange" not in _plan(seen[0])
