"""A stored table replayed in event-time order over several micro-batches.

The table is written once, range-partitioned by event time, a folder per time
slice.  The stream watches another folder; slices are moved into it one by one
and each is processed before the next comes in.  So a micro-batch holds one
time range, the watermark follows the event times, no row is late, and one
call of a state function gets a time range of its key, never the key's whole
table.  The order does not depend on how a file system stamps its files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapflow.session import scratch_path

SLICES = 10


def _hadoop(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_folder(spark, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.mkdirs(p)


def write_time_slices(rows: DataFrame, path: str, slices: int = SLICES, files_per_slice: int = 1,
                      time_col: str = "event_time") -> list[str]:
    """``rows`` under ``path``, a folder per slice, and the folders in time
    order.  Rows without a time come first.  A slice is written by
    ``files_per_slice`` tasks."""
    ranges = rows.repartitionByRange(slices * files_per_slice, time_col)
    number = F.floor(F.spark_partition_id() / F.lit(files_per_slice)).cast("int")
    ranges.withColumn("_slice", number).write.partitionBy("_slice").parquet(path)
    root, fs = _hadoop(rows.sparkSession, path)
    found = [str(s.getPath()) for s in fs.listStatus(root) if "_slice=" in str(s.getPath())]
    return sorted(found, key=lambda p: int(p.rsplit("=", 1)[1]))


class Replay:
    """``stream`` reads what ``run`` admits slice by slice."""

    def __init__(self, rows: DataFrame, slices: int = SLICES, files_per_slice: int = 1, time_col: str = "event_time"):
        spark = self.spark = rows.sparkSession
        self.folders = write_time_slices(rows, scratch_path(spark, "replay-slices"), slices, files_per_slice, time_col)
        self.watched = scratch_path(spark, "replay-watched")
        make_folder(spark, self.watched)
        self.stream = (spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(self.watched))

    def admit(self, folder: str) -> None:
        source, fs = _hadoop(self.spark, folder)
        target, _ = _hadoop(self.spark, f"{self.watched}/{folder.rsplit('/', 1)[1]}")
        if not fs.rename(source, target):
            raise OSError(f"could not admit {folder}")

    def run(self, *starts: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
        """Start the queries (a later one may stream what an earlier one
        writes), admit and process every slice, stop them."""
        queries = []
        try:
            for start in starts:
                queries.append(start())
            for folder in self.folders:
                self.admit(folder)
                for query in queries:
                    query.processAllAvailable()
        finally:
            for query in queries:
                query.stop()
        return queries
