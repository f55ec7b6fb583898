"""Message-bus sources: read, project the envelope, decode the payload.

``read_kafka`` needs the spark-sql-kafka package on the classpath and
``decode_avro`` needs spark-avro; neither is bundled with pyspark, so tests
feed the same envelope shape from files and decode JSON payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from tapflow.functions.times import as_ntz, ntz_from_epoch_millis
from tapflow.schemas import TAP_AVRO_SCHEMA, TAP_FIELDS, TAP_RECORD_SCHEMA

# Header of the schema-registry wire format: magic byte + 4-byte schema id.
WIRE_HEADER_BYTES = 5

# Years 1 to 9999, what a timestamp shows.
MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS = -62135596800000, 253402300799999


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               max_offsets_per_trigger: int | None = None, starting_offsets: str = "earliest",
               **kafka_options) -> DataFrame:
    """Streaming Kafka source (S1) with an optional per-trigger limit.

    Unset, a trigger takes all there is.  A limit also bounds how many rows a
    key can bring into one micro-batch of a stateful operator; size it from
    the cluster's throughput times the trigger interval.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger is not None:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for k, v in kafka_options.items():
        r = r.option(k if k.startswith("kafka.") else f"kafka.{k}", v)
    return r.load()


def project_envelope(raw: DataFrame) -> DataFrame:
    """S3: keep the payload and the envelope columns under stable names."""
    return raw.select(
        F.col("value"),
        F.col("value").cast("string").alias("value_raw"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


CORRUPT_FIELD = "_corrupt_record"
_JSON_SCHEMA = StructType(TAP_RECORD_SCHEMA.fields + [StructField(CORRUPT_FIELD, StringType())])


def decode_json(value: Column) -> Column:
    """Payload decoder for JSON text; malformed text keeps the raw text in
    ``_corrupt_record`` (PERMISSIVE mode) instead of failing the query."""
    return F.from_json(value.cast("string"), _JSON_SCHEMA,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_FIELD})


def decode_avro(value: Column, avro_schema: str = TAP_AVRO_SCHEMA,
                strip_header: bool = True) -> Column:
    """Payload decoder for registry-framed Avro.

    The wire header is cut off; PERMISSIVE mode turns an undecodable payload
    into a struct of nulls (reason ``unknown_parse_error``) instead of failing
    the query.
    """
    from pyspark.sql.avro.functions import from_avro

    body = value
    if strip_header:
        body = F.expr(f"substring(value, {WIRE_HEADER_BYTES + 1}, "
                      f"length(value) - {WIRE_HEADER_BYTES})")
    return from_avro(body, avro_schema, {"mode": "PERMISSIVE"})


def decode_taps(envelope: DataFrame, decoder=decode_json,
                ntz_event_time: bool = True) -> DataFrame:
    """S4 + S5: decode the payload, expand the record, derive event_time.

    Batch keeps event_time as UTC ``TIMESTAMP_NTZ``; a stream needs
    ``ntz_event_time=False`` (``TIMESTAMP``) for watermarks.  The record's
    time is epoch milliseconds (JSON) or a timestamp (Avro's logical type).
    ``parsed`` is false for an undecodable payload and ``time_parsed`` for a
    time that no timestamp can hold, so that such rows reach the dead-letter
    table with their reason instead of failing the query.
    """
    decoded = envelope.withColumn("data", decoder(F.col("value")))
    fields = decoded.schema["data"].dataType
    raw = F.col("data.timestamp")
    if isinstance(fields["timestamp"].dataType, (TimestampType, TimestampNTZType)):
        decoded = decoded.withColumn("_time", raw)
        event_time = as_ntz(decoded, "_time") if ntz_event_time else F.col("_time").cast("timestamp")
    else:
        held = F.when(raw.between(MIN_EPOCH_MILLIS, MAX_EPOCH_MILLIS), raw)
        event_time = ntz_from_epoch_millis(held) if ntz_event_time else F.timestamp_millis(held)
    if CORRUPT_FIELD in fields.fieldNames():
        parsed = F.col("data").isNotNull() & F.col(f"data.{CORRUPT_FIELD}").isNull()
    else:
        parsed = F.coalesce(*[F.col(f"data.{f.name}").cast("string") for f in fields]).isNotNull()
    return (decoded
            .select("value_raw", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_timestamp",
                    parsed.alias("parsed"),
                    (raw.isNull() | event_time.isNotNull()).alias("time_parsed"),
                    *[F.col(f"data.{c}").alias(c) for c in TAP_FIELDS if c != "event_time"],
                    event_time.alias("event_time"))
            .select("value_raw", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_timestamp", "parsed", "time_parsed", *TAP_FIELDS))


def envelope_taps(envelope_source: DataFrame, decoder=decode_json,
                  ntz_event_time: bool = True) -> DataFrame:
    """Envelope rows to decoded taps (S3 -> S4 -> S5)."""
    return decode_taps(project_envelope(envelope_source), decoder, ntz_event_time)
