"""Gapless ranks inside groups of any size, without one task per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapflow.llm.common import drop_written, written


def same(a: DataFrame, b: DataFrame, columns: dict[str, str]):
    """Null-safe equality of columns of ``a`` and of ``b``."""
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[v]) for k, v in columns.items()), F.lit(True))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``group_rank`` (of the group among all groups, nulls first),
    ``group_size`` and ``rank`` (of the row in its group by ``order``, from 0).

    Rows are sorted by range over the whole table, ties split by their place in
    the input, so a group that holds a third of all rows (or a third of rows
    that are all alike) lies in many partitions.  Each partition's first row
    and row count of a group place its rows; those tables have a row per group
    and partition.  ``rows`` should be a written table: the sort samples it.
    """
    row, at, part = "_rank_row", "_rank_at", F.shiftright("_rank_at", 33)
    keys = [group, *order, row]
    lined = written(rows.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*keys)
                    .sortWithinPartitions(*keys).drop(row).withColumn(at, F.monotonically_increasing_id()),
                    "ranked-rows")
    pieces = lined.groupBy(F.col(group).alias("_g"), part.alias("_part")).agg(
        F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
    pieces = written(pieces, "ranked-pieces")
    earlier = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select("_g", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    groups = pieces.groupBy(F.col("_g").alias("_h")).agg(F.min("_first").alias("_first"), F.sum("_n").alias("group_size"))
    groups = groups.withColumn("_home", F.shiftright("_first", 33))
    inside = F.row_number().over(Window.partitionBy("_home").orderBy("_first")) - 1
    homes = groups.groupBy(F.col("_home").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))       # a row per partition
    homes = homes.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    groups = groups.withColumn("_k", inside).join(homes, F.col("_home") == F.col("_p")).select(
        "_h", "group_size", (F.col("_before") + F.col("_k")).alias("group_rank"))
    places = shifts.join(groups, same(shifts, groups, {"_g": "_h"})).drop("_h")
    lined_part = lined.withColumn("_row_part", part)
    placed = lined_part.join(places, same(lined_part, places, {group: "_g", "_row_part": "_part"}))
    out = written(placed.select(*rows.columns, "group_rank", "group_size",
                                (F.col(at) + F.col("_shift")).alias("rank")), "ranked")
    drop_written(lined, pieces)
    return out
