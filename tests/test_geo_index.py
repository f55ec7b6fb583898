"""The grid index against the literal form and brute force."""

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tapflow.operators.geo import segment
from tapflow.operators.geo_index import cell_candidates, nearest_segment_join
from tapflow.plans.batch import good_taps, stop_table
from pyspark.sql import functions as F


def brute_force(points, stops):
    """Two nearest by squared degrees, ties to the lower index."""
    idx = np.array([s[0] for s in stops])
    lat, lon = (np.array([s[k] for s in stops], float) for k in (2, 3))
    out = {}
    for tx, y, x in points:
        d = (lat - y) * (lat - y) + (lon - x) * (lon - x)
        two = sorted(np.lexsort((idx, d))[:2], key=lambda k: idx[k])
        out[tx] = " -> ".join(stops[k][1] for k in two)
    return out


def joined(spark, points, stops, **kw):
    taps = spark.createDataFrame([(t, y, x, "c") for t, y, x in points], "t string, latitude double, longitude double, near string")
    table = spark.createDataFrame(stops, "idx int, stop_id string, lat double, lon double")
    return {r.t: r.segment for r in nearest_segment_join(taps, table, **kw).collect()}


def test_ten_stops_equal_the_literal_form(spark):
    good = good_taps(spark, SF_SMALL)
    got = {r.transaction_id: r.segment for r in nearest_segment_join(good, stop_table(spark)).collect()}
    want = {r.transaction_id: r.segment for r in good.select("transaction_id", segment().alias("segment")).collect()}
    assert got == want and len(got) == 750


@pytest.mark.parametrize("cell", [None, 0.5])
def test_random_stops(spark, cell):
    """10,000 stops: a dense city, a line, a coarse lattice full of ties; taps
    in them, between them and on the far side of the world."""
    rnd = np.random.default_rng(4)
    places = [*(rnd.normal([-6.2, 106.8], 0.05, (6000, 2))), *np.c_[np.linspace(-7, -5, 2000), np.linspace(106, 108, 2000)],
              *[(-10 + i * 0.25, 100 + j * 0.25) for i in range(45) for j in range(44)], *[(-6.2, 106.8)] * 20]
    stops = [(i, f"s{i}", float(y), float(x)) for i, (y, x) in enumerate(places)]
    taps = [*rnd.normal([-6.2, 106.8], 0.2, (400, 2)), *rnd.uniform([-90, -180], [90, 180], (150, 2)),
            *[(-10 + i * 0.125, 100 + i * 0.125) for i in range(80)], (90, 180), (-90, -180), (-6.2, 106.8)]
    points = [(f"t{i}", float(y), float(x)) for i, (y, x) in enumerate(taps)]
    assert joined(spark, points, stops, cell=cell) == brute_force(points, stops)


def test_cell_lists_are_short(spark):
    """A far cell does not list the whole city (4,000 stops)."""
    rnd = np.random.default_rng(6)
    stops = spark.createDataFrame([(i, f"s{i}", float(y), float(x)) for i, (y, x) in enumerate(rnd.uniform(0, 1, (4000, 2)))],
                                  "idx int, stop_id string, lat double, lon double")
    cells = spark.createDataFrame([(900, 900), (5, 5), (-2000, 40)], "ci long, cj long")
    near, width = cell_candidates(cells, stops)
    assert width < 0.05 and max(r.n for r in near.select(F.size("near").alias("n")).collect()) < 100


@pytest.mark.parametrize("stops, want", [([], None), ([(0, "a", 1.0, 1.0)], "a"), ([(0, "a", 1.0, 1.0)] * 3, "a"),
                                         ([(0, "a", 1.0, 1.0), (1, "b", 1.0, 1.0), (2, "c", 1.0, 1.0)], "a -> b")])
def test_small_tables(spark, stops, want):
    assert joined(spark, [("t", 5.0, 5.0)], stops) == {"t": want}


def test_positions_without_a_segment(spark):
    points = [("null", None, 1.0), ("nan", float("nan"), 1.0), ("inf", 1.0, float("inf")), ("ok", 1.0, 1.0)]
    got = joined(spark, points, [(0, "a", 1.0, 1.0), (1, "b", 2.0, 2.0)])
    assert got == {"null": None, "nan": None, "inf": None, "ok": "a -> b"}


def test_no_pairs_with_all_stops(spark):
    plan = nearest_segment_join(good_taps(spark, SF_SMALL), stop_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
