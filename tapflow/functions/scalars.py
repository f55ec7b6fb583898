"""Scalar string and time functions used around taps, all built-in.

* strings: length, substring of the wire bytes / ids, zero padding, pattern
  tests, formatted text;
* times: epoch milliseconds, a local-time view (Asia/Jakarta), HH:mm,
  service date, whole minutes between two times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.config import BUS_ID_PATTERN
from tapflow.functions.times import epoch_micros, epoch_millis

LOCAL_ZONE = "Asia/Jakarta"


def local_time(c, zone: str = LOCAL_ZONE):
    """Wall-clock time in ``zone`` of a naive-UTC timestamp (stays naive)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c)


def string_functions(taps: DataFrame) -> DataFrame:
    return taps.select(
        "event_id", "transaction_id",
        F.length("transaction_id").alias("tx_len"),
        F.substring("transaction_id", 25, 12).alias("tx_tail"),
        F.lpad("card_id", F.greatest(F.lit(6), F.length("card_id")), F.lit("0")).alias("card_padded"),
        F.col("bus_id").rlike(BUS_ID_PATTERN).alias("bus_ok"),
        F.format_string("%s@%s", F.col("card_id"), F.col("bus_id")).alias("card_at_bus"),
        F.upper(F.substring("bus_id", 1, 3)).alias("vehicle_kind"),
    )


def time_functions(trips: DataFrame) -> DataFrame:
    local_in = local_time(F.col("tap_in_time"))
    return trips.select(
        "trip_id",
        epoch_millis(trips, "tap_in_time").alias("tap_in_ms"),
        local_in.alias("tap_in_local"),
        F.date_format(local_in, "HH:mm").alias("tap_in_hhmm"),
        F.to_date(local_in).alias("service_date_local"),
        ((epoch_micros(trips, "tap_out_time") - epoch_micros(trips, "tap_in_time"))
         / F.lit(60_000_000)).cast("long").alias("duration_min"),
    )


# Full microsecond precision for timestamps in JSON text.
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_record_roundtrip(taps: DataFrame) -> DataFrame:
    """Each tap as a JSON object (``to_json(struct)``) and parsed back
    (``from_json`` with the record's schema)."""
    cols = [c for c in taps.columns]
    text = F.to_json(F.struct(*cols), JSON_TIME_OPTIONS)
    schema = taps.select(*cols).schema
    parsed = F.from_json(text, schema, JSON_TIME_OPTIONS)
    return taps.select(parsed.alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in cols])
