"""Validation of decoded taps: patterns, types, ranges, reject reasons.

Two modes for rows that fail the pattern or event-type checks:

* default: every row is classified; rejected rows go to the dead-letter
  table with the first failing reason (all reasons reachable);
* ``strict_reference=True``: such rows are dropped before the good / bad
  split (the behaviour being reproduced), so the dead-letter table only ever
  sees timestamp and coordinate failures.

Good rows are identical in both modes.  All checks are built-in column
expressions, so they fuse into the scan's whole-stage-codegen stage and the
null tests reach the Parquet reader as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapflow.config import (
    BUS_ID_PATTERN, CARD_ID_PATTERN, EVENT_TYPES, TRANSACTION_ID_PATTERN,
    UNKNOWN_REASON,
)
from tapflow.schemas import DLQ_COLUMNS, TAP_FIELDS


# Each check is one SQL expression string, so building a plan costs one call
# to the JVM per check rather than one per column operation.
def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


TX_ID_OK = f"transaction_id RLIKE {_sql_str(TRANSACTION_ID_PATTERN)}"
CARD_ID_OK = f"card_id RLIKE {_sql_str(CARD_ID_PATTERN)}"
BUS_ID_OK = f"bus_id RLIKE {_sql_str(BUS_ID_PATTERN)}"
PATTERNS_OK = f"({TX_ID_OK} AND {CARD_ID_OK} AND {BUS_ID_OK})"
EVENT_TYPE_OK = "event_type IN (" + ", ".join(_sql_str(t) for t in EVENT_TYPES) + ")"
LATITUDE_OK = "(latitude IS NOT NULL AND latitude BETWEEN -90 AND 90)"
LONGITUDE_OK = "(longitude IS NOT NULL AND longitude BETWEEN -180 AND 180)"
REQUIRED_NOT_NULL = ("(transaction_id IS NOT NULL AND card_id IS NOT NULL AND bus_id IS NOT NULL"
                     " AND event_type IS NOT NULL AND event_time IS NOT NULL"
                     " AND latitude IS NOT NULL AND longitude IS NOT NULL)")
RANGES_OK = f"({LATITUDE_OK} AND {LONGITUDE_OK} AND event_time IS NOT NULL)"
GOOD = (f"coalesce({REQUIRED_NOT_NULL} AND {EVENT_TYPE_OK} AND {LATITUDE_OK}"
        f" AND {LONGITUDE_OK} AND {PATTERNS_OK}, false)")


def _reason_sql(has_parsed: bool, has_time_parsed: bool = False) -> str:
    checks = [
        ("transaction_id IS NULL", "missing_transaction_id"),
        ("card_id IS NULL", "missing_card_id"),
        ("bus_id IS NULL", "missing_bus_id"),
        (f"NOT coalesce({EVENT_TYPE_OK}, false)", "invalid_event_type"),
        *([("event_time IS NULL AND time_parsed", "missing_timestamp"),
           ("NOT time_parsed", "invalid_timestamp_parse")] if has_time_parsed else
          [("event_time IS NULL", "missing_timestamp")]),
        (f"NOT {LATITUDE_OK}", "invalid_latitude"),
        (f"NOT {LONGITUDE_OK}", "invalid_longitude"),
        (f"NOT {TX_ID_OK}", "malformed_transaction_id"),
        (f"NOT {CARD_ID_OK}", "malformed_card_id"),
        (f"NOT {BUS_ID_OK}", "malformed_bus_id"),
    ]
    if has_parsed:
        checks.insert(0, ("NOT parsed", UNKNOWN_REASON))
    whens = " ".join(f"WHEN {c} THEN {_sql_str(r)}" for c, r in checks)
    return f"CASE {whens} ELSE CAST(NULL AS STRING) END"


def tx_id_ok() -> Column:
    return F.expr(TX_ID_OK)


def card_id_ok() -> Column:
    return F.expr(CARD_ID_OK)


def bus_id_ok() -> Column:
    return F.expr(BUS_ID_OK)


def patterns_ok() -> Column:
    """The three identifier patterns (null fails)."""
    return F.expr(PATTERNS_OK)


def event_type_ok() -> Column:
    """Accepted event types."""
    return F.expr(EVENT_TYPE_OK)


def ranges_ok() -> Column:
    """Coordinates in range (NaN fails), time present."""
    return F.expr(RANGES_OK)


def good_condition() -> Column:
    """A tap is good when every check passes."""
    return F.expr(GOOD)


def reject_reason(has_parsed: bool = False, has_time_parsed: bool = False) -> Column:
    """P5: first failing check, in fixed order; null for good rows."""
    return F.expr(_reason_sql(has_parsed, has_time_parsed))


def strict_prefilter(df: DataFrame) -> DataFrame:
    """Reference-compatible pre-filter: pattern or type failures vanish."""
    return df.where(f"{PATTERNS_OK} AND {EVENT_TYPE_OK}")


def with_reject_reason(df: DataFrame, strict_reference: bool = False) -> DataFrame:
    has_parsed = "parsed" in df.columns
    if strict_reference:
        df = strict_prefilter(df)
    return df.withColumn("error_reason", reject_reason(has_parsed, "time_parsed" in df.columns))


def valid_taps(df: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Rows passing every check (not yet de-duplicated)."""
    if strict_reference:
        df = strict_prefilter(df)
    return df.where(GOOD)


def dead_letter(df: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Rejected envelope rows with their reason (DLQ layout)."""
    bad = with_reject_reason(df, strict_reference).where(f"NOT {GOOD}")
    return bad.select(*DLQ_COLUMNS)


def select_tap_fields(df: DataFrame) -> DataFrame:
    return df.select(*TAP_FIELDS)
