"""Every scan-based plan still equals its reference SQL when slicing is
forced on (every card and vehicle with 10+ taps counts as hot)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck_connection

from tapflow import config
from tapflow.plans.registry import all_oracle_sql, all_queries

SCAN_PLANS = ["trips", "trips_max_open", "expired_taps", "trip_rule_violations",
              "occupancy", "crowd_flags", "occupancy_idle_reset"]


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("bucket", [600, 86400])
@pytest.mark.parametrize("name", SCAN_PLANS)
def test_forced_slicing_matches_reference(spark, duck, monkeypatch, name, bucket):
    monkeypatch.setattr(config, "DEFAULT_HOT_KEY_ROWS", 10)
    monkeypatch.setattr(config, "DEFAULT_HOT_KEY_SAMPLE_EVERY", 1)
    monkeypatch.setattr(config, "DEFAULT_SCAN_BUCKET_SECONDS", bucket)
    ok, n, _, detail = compare(spark, duck, name, all_queries()[name], all_oracle_sql()[name],
                               SF_SMALL)
    assert ok, detail
