"""Tap events projected from the driver's ``events`` table.

The projection is deterministic (see FIXTURES.md §2): each event becomes one
tap; a few ids are made invalid on purpose so that every reject reason is
exercised, and every tenth event is delivered twice; the second copy of
every thirtieth is stamped a second later, so copies may differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.config import TOPIC_NAME, TOPIC_PARTITIONS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The projection as SQL expressions: one call to the JVM builds the whole
# projection (the plan is the same as with chained Column calls).
_TAPS_BASE_EXPRS = [
    "event_id",
    "CASE WHEN event_id % 107 = 0 THEN CAST(NULL AS STRING) "
    "ELSE concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS STRING), greatest(12, length(CAST(event_id AS STRING))), '0')) "
    "END AS transaction_id",
    "CASE WHEN event_id % 109 = 0 THEN concat('C-', CAST(user_id AS STRING)) "
    "ELSE concat('C', lpad(CAST(user_id AS STRING), greatest(3, length(CAST(user_id AS STRING))), '0')) END AS card_id",
    "CASE WHEN event_id % 113 = 0 THEN 'TRAM-1' "
    "ELSE concat('BUS-0', CAST(event_id % 7 + 1 AS STRING)) END AS bus_id",
    "CASE WHEN event_type IN ('view', 'signup') THEN 'tap_in' "
    "WHEN event_type IN ('click', 'purchase') THEN 'tap_out' ELSE event_type END AS event_type",
    "CASE WHEN event_id % 103 = 0 THEN NULL ELSE ts END AS event_time",
    "CASE WHEN event_id % 97 = 0 THEN 91.0D "
    "ELSE -6.1375D - CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) * 8.9E-4D END AS latitude",
    "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE) "
    "ELSE 106.8135D + CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) * 3.0E-5D END AS longitude",
]


def taps_base(events: DataFrame) -> DataFrame:
    """One tap per event (columns: event_id + the seven tap fields)."""
    return events.selectExpr(*_TAPS_BASE_EXPRS)


def with_redeliveries(base: DataFrame) -> DataFrame:
    """Every tenth event delivered twice (``copy_no`` 0 and 1); copy 1 of
    every thirtieth carries a later time.

    One pass over the input (a generator, not a union of two scans), so it
    works unchanged on a stream.
    """
    both = base.selectExpr(
        "*", "explode(CASE WHEN event_id % 10 = 0 THEN array(0, 1) ELSE array(0) END) AS copy_no")
    return both.withColumn("event_time", F.expr(
        "CASE WHEN copy_no = 1 AND event_id % 30 = 0 THEN event_time + INTERVAL 1 SECOND ELSE event_time END"))


def taps(spark: SparkSession, sf_dir: str, with_copy_no: bool = False) -> DataFrame:
    """The tap table: ``taps_base`` plus redelivered copies."""
    t = with_redeliveries(taps_base(read_table(spark, sf_dir, "events")))
    return t if with_copy_no else t.drop("copy_no")


# Of every 211th tap the bus carries a time that no timestamp can hold.
UNREADABLE_EVERY, UNREADABLE_MILLIS = 211, 9223372036854775807


def encode_tap_json(df: DataFrame, millis=None) -> object:
    """Wire payload of a tap as JSON text; the timestamp in epoch ms.

    Built field by field (rather than ``to_json``) so that null fields are
    written as ``null`` and the text is reproducible in plain SQL.
    """
    from tapflow.functions.times import epoch_millis

    def s(c):
        return F.when(F.col(c).isNull(), F.lit("null")).otherwise(
            F.concat(F.lit('"'), F.col(c), F.lit('"')))

    def n(c):
        return F.coalesce(c.cast("string"), F.lit("null"))

    return F.concat(
        F.lit('{"transaction_id":'), s("transaction_id"),
        F.lit(',"card_id":'), s("card_id"),
        F.lit(',"bus_id":'), s("bus_id"),
        F.lit(',"event_type":'), s("event_type"),
        F.lit(',"timestamp":'), n(epoch_millis(df, "event_time") if millis is None else millis),
        F.lit(',"latitude":'), n(F.col("latitude")),
        F.lit(',"longitude":'), n(F.col("longitude")),
        F.lit("}"),
    )


def tap_envelope_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taps as message-bus envelopes (key, value, topic, partition, offset,
    timestamp), the shape a Kafka source yields.

    The value is the JSON payload; the key is the bus id; the partition
    follows the bus number (same bus, same partition); the offset is unique
    per delivery; the broker timestamp is the event time.
    """
    from tapflow.functions.times import epoch_millis
    t = taps(spark, sf_dir, with_copy_no=True)
    millis = F.when(F.col("event_id") % UNREADABLE_EVERY == 0, F.lit(UNREADABLE_MILLIS)).otherwise(
        epoch_millis(t, "event_time"))
    return t.select(
        F.col("bus_id").cast("binary").alias("key"),
        encode_tap_json(t, millis).cast("binary").alias("value"),
        F.lit(TOPIC_NAME).alias("topic"),
        (F.col("event_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("copy_no")).alias("offset"),
        F.col("event_time").alias("timestamp"),
    )
