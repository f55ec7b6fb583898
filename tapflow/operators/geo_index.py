"""Nearest segment from a stop table of any size (J1), by a grid index.

Space is cut into square cells; a cell of level L is 2**L finest cells wide.
Every stop is listed under the nine cells around it on every level, so a
cell's list holds the stops of its 3 x 3 block.  Three equi-joins on the cell
find each tap's two nearest stops:

1. a finest cell looks for the smallest level at which its block holds two
   stops; both are within 2 sqrt(2) cells of that level from any point of the
   cell, so the block two levels up holds the two nearest of every point;
2. of that block's stops only those stay that can be among the two nearest for
   some point of the cell: their least distance to the cell is no more than
   the second smallest greatest distance of any stop;
3. a tap joins its cell's list and ranks it as the literal form ranks the
   stop list.

The work of steps 1 and 2 grows with stops and visited cells, not with taps.
No step pairs taps with all stops.  A cell's list is short: stops at one place
are first cut to the two that can win (the lowest in order), and step 2 keeps
what is about as near as the second nearest.  Taps are salted against a cell
with a third of all taps.

Defined results: ties in distance go to the earlier stop; a position that is
null, NaN or infinite has no segment; a table of one stop gives its id alone,
an empty one no segment; repeated stop rows are one stop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.config import SEGMENT_SEPARATOR

SALTS = 8
SPAN = 2 * 360.0              # no two valid positions are farther apart on one axis
MIN_CELL = 1e-6               # degrees, about 10 cm


def _grid(stops: DataFrame, cell: float | None) -> tuple[float, int, int]:
    """Cell width, number of levels and of stops needed, from one pass over the
    stop table (a row of figures reaches the driver)."""
    n, la, lb, oa, ob = stops.agg(F.count(F.lit(1)), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    if cell is None:
        extent = max(lb - la, ob - oa) if n else 0.0
        cell = max(MIN_CELL, extent / max(1.0, math.sqrt(n))) if extent else 1.0
    return cell, max(1, math.ceil(math.log2(SPAN / cell)) + 3), min(n, 2)


def _square(x: Column) -> Column:
    return x * x


def _outside(low: Column, width: float, x: Column) -> Column:
    """Distance on one axis from ``x`` to the nearest point of a cell."""
    return F.greatest(low - x, x - (low + width), F.lit(0.0))


def _farthest(low: Column, width: float, x: Column) -> Column:
    return F.greatest(F.abs(x - low), F.abs(low + width - x))


def cell_candidates(cells: DataFrame, stops: DataFrame, cell: float | None = None) -> tuple[DataFrame, float]:
    """(ci, cj, near) for finest cells (ci, cj): the stops that can be among
    the two nearest of a point in the cell, as (idx, stop_id, lat, lon)."""
    at_place = Window.partitionBy("lat", "lon").orderBy("idx", "stop_id")
    stops = stops.select(F.col("idx").cast("long").alias("idx"), "stop_id", F.col("lat").cast("double").alias("lat"),
                         F.col("lon").cast("double").alias("lon")).distinct()
    stops = stops.withColumn("_k", F.row_number().over(at_place)).where("_k <= 2").drop("_k")
    width, levels, needed = _grid(stops, cell)
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    listed = (stops.withColumns({"_i": F.floor(F.col("lat") / width), "_j": F.floor(F.col("lon") / width)})
              .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumn("_d", around)
              .withColumns({"li": F.expr("shiftright(_i, level)") + F.col("_d.a"), "lj": F.expr("shiftright(_j, level)") + F.col("_d.b")})
              .select("level", "li", "lj", "idx", "stop_id", "lat", "lon"))
    full = listed.groupBy("level", "li", "lj").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= needed).drop("n")
    up = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumns(
        {"li": F.expr("shiftright(ci, level)"), "lj": F.expr("shiftright(cj, level)")})
    level = up.join(full, ["level", "li", "lj"]).groupBy("ci", "cj").agg(F.min("level").alias("_least"))
    block = level.withColumn("level", F.least(F.col("_least") + 2, F.lit(levels - 1))).withColumns(
        {"li": F.expr("shiftright(ci, level)"), "lj": F.expr("shiftright(cj, level)")})
    lat0, lon0 = F.col("ci") * width, F.col("cj") * width
    # a hair of slack, so that rounding never drops a stop at the edge
    slack = 1 + 1e-9
    found = block.join(listed, ["level", "li", "lj"]).select(
        "ci", "cj", "idx", "stop_id", "lat", "lon",
        (_square(_outside(lat0, width, F.col("lat"))) + _square(_outside(lon0, width, F.col("lon")))).alias("least"),
        (_square(_farthest(lat0, width, F.col("lat"))) + _square(_farthest(lon0, width, F.col("lon")))).alias("most"))
    by_reach = Window.partitionBy("ci", "cj").orderBy("most", "idx", "stop_id")
    bound = (found.withColumn("_k", F.row_number().over(by_reach)).where("_k <= 2")
             .groupBy(F.col("ci").alias("_ci"), F.col("cj").alias("_cj")).agg(F.max("most").alias("_bound")))
    kept = found.join(bound, (F.col("ci") == F.col("_ci")) & (F.col("cj") == F.col("_cj"))).where(
        F.col("least") <= F.col("_bound") * slack)
    return kept.groupBy("ci", "cj").agg(F.collect_list(F.struct("idx", "stop_id", "lat", "lon")).alias("near")), width


def nearest_segment_join(taps: DataFrame, stops: DataFrame, cell: float | None = None) -> DataFrame:
    """``taps`` (latitude, longitude and any other columns) plus ``segment``.
    ``stops``: idx (order), stop_id, lat, lon."""
    columns = taps.columns
    finite = (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
              & (F.abs("latitude") < F.lit(float("inf"))) & (F.abs("longitude") < F.lit(float("inf"))))
    # the grid is known once the candidates are declared; both sides use it
    width_of = _grid(stops.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).distinct(), cell)[0]
    at = taps.withColumns({"_ci": F.when(finite, F.floor(F.col("latitude") / width_of)),
                           "_cj": F.when(finite, F.floor(F.col("longitude") / width_of)),
                           "_salt": F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(SALTS)).cast("int")})
    cells = at.where("_ci IS NOT NULL").select(F.col("_ci").alias("ci"), F.col("_cj").alias("cj")).distinct()
    near, _ = cell_candidates(cells, stops, width_of)
    near = near.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = at.join(near, (at["_ci"] == near["ci"]) & (at["_cj"] == near["cj"]) & (at["_salt"] == near["salt"]), "left")
    ranked = F.array_sort(F.transform(near["near"], lambda s: F.struct(
        (_square(s["lat"] - at["latitude"]) + _square(s["lon"] - at["longitude"])).alias("d"),
        s["idx"].alias("idx"), s["stop_id"].alias("stop_id"))))
    first = F.array_sort(F.transform(F.slice(ranked, 1, 2), lambda x: F.struct(x["idx"].alias("idx"), x["stop_id"].alias("stop_id"))))
    return joined.select(*[at[c] for c in columns],
                         F.array_join(F.transform(first, lambda x: x["stop_id"]), SEGMENT_SEPARATOR).alias("segment"))
