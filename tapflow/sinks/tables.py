"""Sinks for raw taps, trips, crowd flags and dead letters (K1-K9).

Batch writers take a DataFrame; ``*_batch_writer`` return ``foreachBatch``
callbacks.  Callbacks write each micro-batch once and count its rows with an
observed metric of that same write, under ``run=<checkpoint id>/batch_id=<n>``
with overwrite: a retried batch replaces its own output instead of appending
a second copy, and a query that starts anew with a fresh checkpoint never
replaces the output of an earlier one.  The folder of an empty micro-batch is
taken away again (``isEmpty`` would run a stateful plan twice).
Output files are left to the plan's partitioning (no ``repartition(1)``:
a large micro-batch would then be written by one task).
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tapflow.config import TOPIC_NAME
from tapflow.functions.scalars import JSON_TIME_OPTIONS   # microsecond timestamp text
from tapflow.functions.times import epoch_millis
from tapflow.schemas import DLQ_COLUMNS, TAP_AVRO_SCHEMA, TAP_FIELDS, TRIP_COLUMNS

BatchFn = Callable[[DataFrame, int], None]
log = logging.getLogger("tapflow.sinks")

RAW_COLUMNS = TAP_FIELDS
FLAG_COLUMNS = ["bus_id", "flagged_at", "pending_count", "segment", "message"]


# Column types at the sinks (P7); names not listed are strings, times keep
# their kind of timestamp.
_SINK_TYPES = {"pending_count": "int", "kafka_partition": "int", "kafka_offset": "long"} | {
    c: "double" for c in ("latitude", "longitude", "tap_in_lat", "tap_in_lon", "tap_out_lat", "tap_out_lon")}
_TIMES = ("event_time", "tap_in_time", "tap_out_time", "flagged_at", "kafka_timestamp")


def typed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The sink's columns in the sink's types."""
    return df.select(*[F.col(c) if c in _TIMES else F.col(c).cast(_SINK_TYPES.get(c, "string")).alias(c)
                       for c in columns])


# --- files -----------------------------------------------------------------

def append_parquet(df: DataFrame, path: str, columns: list[str] | None = None,
                   partition_by: list[str] | None = None) -> None:
    out = typed(df, columns) if columns else df
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_raw(df: DataFrame, path: str) -> None:
    """K1 (files): good taps."""
    append_parquet(df, path, RAW_COLUMNS)


def write_trips(df: DataFrame, path: str) -> None:
    """K2 (files): trips."""
    append_parquet(df, path, TRIP_COLUMNS)


def _dead_letter_base(base: str) -> str:
    return f"{base.rstrip('/')}/raw_bad"


def write_dead_letters(df: DataFrame, base: str, batch_id: int) -> None:
    """K4: rejected rows of one batch under ``raw_bad/batch_id=<n>``."""
    df.select(*DLQ_COLUMNS).write.mode("overwrite").parquet(f"{_dead_letter_base(base)}/batch_id={batch_id}")


def observed_write(batch: DataFrame, write: Callable[[DataFrame], None],
                   name: str, batch_id: int, counts: dict | None = None) -> int:
    """K6: run ``write`` once and report how many rows it wrote.

    The count is an ``Observation`` collected by the write itself, so the
    batch plan is not run a second time for ``count()`` / ``isEmpty()``.
    """
    obs = Observation(f"{name}_{batch_id}")
    write(batch.observe(obs, F.count(F.lit(1)).alias("rows")))
    n = int(obs.get.get("rows", 0))
    log.info("batch %s: %d %s rows", batch_id, n, name)
    if counts is not None:
        counts[batch_id] = n
    return n


def checkpoint_id(spark, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _run_base(batch: DataFrame, base: str, checkpoint: str | None) -> str:
    base = base.rstrip("/")
    return base if checkpoint is None else f"{base}/run={checkpoint_id(batch.sparkSession, checkpoint)}"


def _drop_folder(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def parquet_batch_writer(base: str, columns: list[str] | None = None, counts: dict | None = None,
                         checkpoint: str | None = None) -> BatchFn:
    """foreachBatch callback: one idempotent directory per micro-batch;
    ``checkpoint`` is the query's checkpoint folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = typed(batch, columns) if columns else batch
        path = f"{_run_base(batch, base, checkpoint)}/batch_id={batch_id}"
        n = observed_write(out, lambda d: d.write.mode("overwrite").parquet(path),
                           base.rstrip("/").split("/")[-1], batch_id, counts)
        if not n:
            _drop_folder(batch.sparkSession, path)
    return write


def dlq_batch_writer(base: str, counts: dict | None = None, checkpoint: str | None = None) -> BatchFn:
    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{_run_base(batch, _dead_letter_base(base), checkpoint)}/batch_id={batch_id}"
        n = observed_write(batch.select(*DLQ_COLUMNS), lambda d: d.write.mode("overwrite").parquet(path),
                           "dead_letter", batch_id, counts)
        if not n:
            _drop_folder(batch.sparkSession, path)
    return write



def export_json(df: DataFrame, path: str) -> None:
    """K9: JSON lines (one object per row)."""
    df.write.mode("overwrite").options(**JSON_TIME_OPTIONS).json(path)


# --- JDBC ------------------------------------------------------------------

def jdbc_properties(user: str | None, password: str | None,
                    driver: str = "org.postgresql.Driver", batchsize: int = 500,
                    isolation: str = "READ_COMMITTED", **extra: str) -> dict:
    """K5: connection properties: batch size, isolation level, encrypted
    connection, UTC session, and text sent untyped so that the database
    casts it to the column's type."""
    props = {"driver": driver, "batchsize": str(batchsize), "isolationLevel": isolation,
             "sslmode": "require", "stringtype": "unspecified", "options": "-c TimeZone=UTC"}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    props.update(extra)
    return props


def jdbc_batch_writer(url: str, table: str, columns: list[str], properties: dict,
                      append=None) -> BatchFn:
    """K1-K3 (database): append each micro-batch to ``table``.

    ``append`` replaces the write itself (tests).  Needs the database's JDBC driver on the classpath; not exercised by the
    tests here (no database may be started in this environment).  Appends
    are at-least-once: give the table a unique key (transaction_id, trip_id)
    and an upsert on the database side for exactly-once results.
    """
    append = append or _append_jdbc

    def write(batch: DataFrame, batch_id: int) -> None:
        observed_write(typed(batch, columns), lambda d: append(d, url, table, properties), table, batch_id)
    return write


def _append_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


# --- message bus -----------------------------------------------------------

def tap_record(df: DataFrame):
    """The wire record of a tap (timestamp in epoch ms)."""
    return F.struct(
        "transaction_id", "card_id", "bus_id", "event_type",
        epoch_millis(df, "event_time").alias("timestamp"), "latitude", "longitude")


def wire_header(schema_id: int) -> bytes:
    """Magic byte and the schema's id, as the registry's readers expect."""
    return b"\0" + schema_id.to_bytes(4, "big")


def publish_frame(df: DataFrame, encoding: str = "json", schema_id: int | None = None,
                  encode=None) -> DataFrame:
    """K7 / K8: the (key, value) rows a message-bus writer sends: key =
    bus_id (same bus, same partition), value = the wire record as JSON or
    (with spark-avro) Avro.  The producer partitions by key, so no shuffle
    is needed before the write."""
    rec = tap_record(df)
    if encoding == "avro":
        if schema_id is None:
            raise ValueError("Avro needs the registered schema's id")
        if encode is None:
            from pyspark.sql.avro.functions import to_avro
            encode = lambda r: to_avro(r, TAP_AVRO_SCHEMA)
        value = F.concat(F.lit(wire_header(schema_id)), encode(rec))
    else:
        value = F.to_json(rec)
    return df.select(F.col("bus_id").alias("key"), value.alias("value"))


def publish_taps(df: DataFrame, bootstrap_servers: str, topic: str = TOPIC_NAME,
                 encoding: str = "json", schema_id: int | None = None) -> None:
    """Publish taps to a topic (needs the spark-sql-kafka package)."""
    (publish_frame(df, encoding, schema_id).write.format("kafka")
       .option("kafka.bootstrap.servers", bootstrap_servers)
       .option("kafka.acks", "all")
       .option("kafka.compression.type", "snappy")
       .option("topic", topic)
       .save())
