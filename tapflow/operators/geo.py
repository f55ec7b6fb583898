"""Nearest route segment of a position.

The stop list is a constant of 10 entries, so it is inlined as a literal
``array<struct>``: each row ranks the stops by squared degree distance with
``transform`` + ``array_sort`` and keeps the first two - no join, no
shuffle, no Python, and it stays inside whole-stage codegen.  Ties in
distance go to the earlier stop in list order; the two stops are printed in
list (north to south) order and need not be adjacent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapflow.config import SEGMENT_SEPARATOR, STOPS


def stops_literal_sql(stops=STOPS) -> str:
    """The stop list as an ``array<struct<idx, stop_id, lat, lon>>`` literal."""
    return "array(" + ", ".join(
        f"named_struct('idx', {i}, 'stop_id', '{sid}', 'lat', {float(lat)!r}D, "
        f"'lon', {float(lon)!r}D)"
        for i, (sid, lat, lon) in enumerate(stops)) + ")"


def nearest_stops_sql(lat: str, lon: str, n: int = 2, stops=STOPS) -> str:
    """SQL for the ``n`` nearest stops as ``array<struct<idx, stop_id>>`` in
    list order; ``lat`` / ``lon`` are column names or SQL expressions."""
    dist = f"(s.lat - ({lat})) * (s.lat - ({lat})) + (s.lon - ({lon})) * (s.lon - ({lon}))"
    ranked = (f"array_sort(transform({stops_literal_sql(stops)}, "
              f"s -> named_struct('d', {dist}, 'idx', s.idx, 'stop_id', s.stop_id)))")
    return (f"array_sort(transform(slice({ranked}, 1, {n}), "
            f"x -> named_struct('idx', x.idx, 'stop_id', x.stop_id)))")


def segment_sql(lat: str, lon: str, stops=STOPS) -> str:
    name = (f"array_join(transform({nearest_stops_sql(lat, lon, 2, stops)}, x -> x.stop_id), "
            f"'{SEGMENT_SEPARATOR}')")
    return f"CASE WHEN ({lat}) IS NULL OR ({lon}) IS NULL THEN CAST(NULL AS STRING) ELSE {name} END"


def segment(lat: str = "latitude", lon: str = "longitude", stops=STOPS) -> Column:
    """``'H-X -> H-Y'`` for the two nearest stops; null without a position.
    ``lat`` / ``lon`` name the coordinate columns (or SQL expressions)."""
    return F.expr(segment_sql(lat, lon, stops))
