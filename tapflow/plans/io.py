"""Sink round trips and scalar-function plans.

Round trips write through the sink functions to a fresh folder under the
shared checkpoint directory and read the result back.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, StringType, StructField, StructType, TimestampNTZType,
)

from tapflow.functions import scalars
from tapflow.operators import trips as tr
from tapflow.operators.validate import dead_letter
from tapflow.plans.batch import decoded_envelope, good_taps
from tapflow.session import scratch_path
from tapflow.sinks.tables import (
    JSON_TIME_OPTIONS, export_json, write_dead_letters, write_raw, write_trips,
)
from tapflow.sources.fixtures import taps

GOOD_JSON_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("card_id", StringType()),
    StructField("bus_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_time", TimestampNTZType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])


def q_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "json")
    export_json(good_taps(spark, sf_dir), path)
    return spark.read.schema(GOOD_JSON_SCHEMA).options(**JSON_TIME_OPTIONS).json(path)


def q_sink_raw_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw")
    write_raw(good_taps(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_sink_trips_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "trips")
    write_trips(tr.trips(good_taps(spark, sf_dir)), path)
    return spark.read.parquet(path)


def q_sink_dlq_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "dlq")
    write_dead_letters(dead_letter(decoded_envelope(spark, sf_dir)), base, 0)
    return spark.read.parquet(f"{base}/raw_bad").drop("batch_id")


def q_scalar_strings(spark, sf_dir):
    return scalars.string_functions(taps(spark, sf_dir))


def q_scalar_times(spark, sf_dir):
    return scalars.time_functions(tr.trips(good_taps(spark, sf_dir)))


def q_scalar_json(spark, sf_dir):
    return scalars.json_record_roundtrip(good_taps(spark, sf_dir))


IO_QUERIES = {
    "json_roundtrip": q_json_roundtrip,
    "sink_raw_roundtrip": q_sink_raw_roundtrip,
    "sink_trips_roundtrip": q_sink_trips_roundtrip,
    "sink_dlq_roundtrip": q_sink_dlq_roundtrip,
    "scalar_strings": q_scalar_strings,
    "scalar_times": q_scalar_times,
    "scalar_json": q_scalar_json,
}
