"""Time helpers that behave the same whatever the session time zone is.

Batch tables carry event times as ``TIMESTAMP_NTZ`` holding UTC wall-clock
("naive = UTC"); streams carry ``TIMESTAMP`` (needed for watermarks).  The
helpers below pick a zone-free formula for either type, so bucketing and
epoch arithmetic are monotonic in event time on both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def is_ntz(df: DataFrame, col_name: str) -> bool:
    return isinstance(df.schema[col_name].dataType, TimestampNTZType)


_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UCT", "Etc/UCT"}


def epoch_micros_of(c: Column, dtype, session_zone: str | None = "UTC") -> Column:
    """Microseconds since 1970-01-01 UTC of ``c`` whose type is ``dtype``.

    ``timestamp_diff`` on ``TIMESTAMP_NTZ`` goes through the session zone:
    exact when that zone is UTC (the cheap path), but wrong and not monotonic
    across daylight-saving changes elsewhere, so then the wall-clock fields
    are read as UTC explicitly.
    """
    if isinstance(dtype, TimestampNTZType):
        if session_zone in _UTC_NAMES:
            return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)
        return F.unix_micros(F.make_timestamp_ltz(
            F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
            F.date_part(F.lit("SECOND"), c), F.lit("UTC")))
    return F.unix_micros(c)


def field_type(df: DataFrame, path: str):
    """Data type of a (possibly nested, dot-separated) column."""
    parts = path.split(".")
    t = df.schema[parts[0]].dataType
    for p in parts[1:]:
        t = t[p].dataType
    return t


def epoch_micros(df: DataFrame, col_name: str) -> Column:
    """Microseconds since 1970-01-01 UTC of a (possibly nested) timestamp column."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone", None)
    return epoch_micros_of(F.col(col_name), field_type(df, col_name), zone)


def epoch_millis(df: DataFrame, col_name: str) -> Column:
    return F.floor(epoch_micros(df, col_name) / F.lit(1000)).cast("long")


def ntz_from_epoch_millis(c: Column) -> Column:
    """UTC wall-clock ``TIMESTAMP_NTZ`` from epoch milliseconds."""
    return F.timestamp_add("MILLISECOND", c, F.expr(_EPOCH_NTZ))


def ntz_from_epoch_micros(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", c, F.expr(_EPOCH_NTZ))


def as_ntz(df: DataFrame, col_name: str) -> Column:
    """The column as UTC wall-clock ``TIMESTAMP_NTZ`` (no zone shift)."""
    if is_ntz(df, col_name):
        return F.col(col_name)
    return ntz_from_epoch_micros(F.unix_micros(F.col(col_name)))


def time_bucket(df: DataFrame, col_name: str, seconds: int) -> Column:
    """Index of the ``seconds``-wide time slice holding each row."""
    return F.floor(epoch_micros(df, col_name) / F.lit(seconds * 1_000_000)).cast("long")


def format_seconds(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp (either type)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
