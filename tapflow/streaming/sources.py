"""Streaming sources of taps.

File streams need an explicit schema; ``ts`` is read as ``TIMESTAMP`` (the
stored microseconds are kept, i.e. UTC), because a watermark needs that
type.  A table is one file or a folder of part files; a file stream cannot
name a single file, so that one is picked out of its directory with
``pathGlobFilter``.  A stored table is replayed as one micro-batch unless
``max_files_per_trigger`` is set: the watermark then moves only after all rows
have been seen, so no row of a bounded replay is late, whatever the order of
the files.  With several micro-batches, rows older than the watermark of the
batch before are dropped as late, as on a live stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

from tapflow.sources.fixtures import taps_base, with_redeliveries

EVENTS_STREAM_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])


def is_folder(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, whichever that is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def events_stream(spark: SparkSession, directory: str, name: str = "events.parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    path = f"{directory.rstrip('/')}/{name}"
    r = spark.readStream.schema(EVENTS_STREAM_SCHEMA)
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):
        return r.parquet(path)
    return r.option("pathGlobFilter", name).parquet(directory)


def taps_stream(spark: SparkSession, directory: str, name: str = "events.parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The tap table as a stream (same projection as the batch fixture)."""
    ev = events_stream(spark, directory, name, max_files_per_trigger)
    return with_redeliveries(taps_base(ev)).drop("copy_no")


TAPS_STREAM_SCHEMA = StructType([
    StructField("event_id", LongType()),
    StructField("transaction_id", StringType()),
    StructField("card_id", StringType()),
    StructField("bus_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_time", TimestampType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])


def tap_files_stream(spark: SparkSession, directory: str,
                     max_files_per_trigger: int = 1) -> DataFrame:
    """Taps already in tap layout (e.g. split into ordered files)."""
    return (spark.readStream.schema(TAPS_STREAM_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(directory))
