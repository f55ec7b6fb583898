"""The tap job: one source, four continuous outputs.

* raw:    good, de-duplicated taps
* trips:  keyed pairing (Python state function, one per card)
* flags:  native per-vehicle counters in update mode, above the threshold
* dlq:    rejected rows with their reason, stateless

Each output is its own query with its own checkpoint folder (state of
one query cannot be shared with another).  The source is a message bus
(Kafka, JSON or Avro payloads) or, in tests, files in envelope or tap
layout.  Sinks are ``foreachBatch`` callbacks, Parquet by default.
``start_shared_job`` reads the source once instead of once per output.

Run it with ``python -m tapflow.streaming.job --help``.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tapflow.config import PAIRING_TIMEOUT_SECONDS, WATERMARK_DELAY
from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.validate import dead_letter, select_tap_fields, valid_taps
from tapflow.schemas import TAP_FIELDS, TRIP_COLUMNS
from tapflow.sinks.ledger import CommittedTable, fan_out, follow_committed
from tapflow.sinks.tables import (
    dlq_batch_writer, jdbc_batch_writer, jdbc_properties, parquet_batch_writer,
)
from tapflow.streaming.crowd import crowd_counts_stream, crowd_flags_from_counts
from tapflow.streaming.occupancy import idle_reset_flags, occupancy_idle_reset_stream
from tapflow.streaming.pairing import pair_taps_stream
from tapflow.streaming.run import drain, start_foreach_batch

FLAG_COLUMNS = ["bus_id", "flagged_at", "pending_count", "segment", "message"]


@dataclass
class JobConfig:
    checkpoint_base: str
    output_base: str
    watermark_delay: str = WATERMARK_DELAY
    max_open_seconds: int | None = PAIRING_TIMEOUT_SECONDS
    strict_reference: bool = False
    dedup_unbounded: bool = False
    ordered_pairing: bool = True      # pair in event-time order (see pairing.py)
    jdbc: dict | None = None          # url, properties; raw, trips and flags go to its tables
    triggers: dict = field(default_factory=lambda: {
        "raw": {"processingTime": "10 seconds"},
        "trips": {"processingTime": "15 seconds"},
        "flags": {"processingTime": "10 seconds"},
        "dlq": {"processingTime": "15 seconds"},
    })
    sinks: dict = field(default_factory=dict)   # name -> foreachBatch callback
    shared_read: bool = False         # read the source once, see start_shared_job
    crowd_idle_seconds: int | None = None   # flags from counts that start anew after this long without a tap


def build_outputs(taps: DataFrame, cfg: JobConfig) -> dict[str, DataFrame]:
    """The four streaming DataFrames from one decoded tap stream.

    ``taps`` has the seven tap fields (``event_time`` as TIMESTAMP) and,
    for a message-bus source, the envelope columns and ``parsed``.
    """
    good = select_tap_fields(dedup_taps_stream(
        valid_taps(taps, cfg.strict_reference), watermark_delay=cfg.watermark_delay,
        unbounded=cfg.dedup_unbounded))
    out = {
        "raw": good,
        "trips": pair_taps_stream(good, max_open_seconds=cfg.max_open_seconds,
                                  ordered=cfg.ordered_pairing),
        "flags": (crowd_flags_from_counts(crowd_counts_stream(good)) if cfg.crowd_idle_seconds is None else
                  idle_reset_flags(occupancy_idle_reset_stream(good, cfg.crowd_idle_seconds))),
    }
    if "value_raw" in taps.columns:
        out["dlq"] = dead_letter(taps, cfg.strict_reference)
    return out


TABLES = {"raw": ("raw_events", TAP_FIELDS), "trips": ("trips", TRIP_COLUMNS),
          "flags": ("crowd_flags", FLAG_COLUMNS)}


def checkpoint_of(cfg: JobConfig, name: str) -> str:
    return f"{cfg.checkpoint_base.rstrip('/')}/{name}"


def _only_trips(fn):
    """A database's trips table holds paired trips, no expired tap_ins."""
    return lambda batch, batch_id: fn(batch.where("record_type = 'trip'"), batch_id)


def default_sinks(cfg: JobConfig) -> dict:
    b = cfg.output_base.rstrip("/")
    sinks = {"dlq": dlq_batch_writer(f"{b}/dlq", checkpoint=checkpoint_of(cfg, "dlq"))}
    for name, (table, columns) in TABLES.items():
        if cfg.jdbc:
            if name == "trips" and not cfg.jdbc.get("tap_ids", True):
                columns = [c for c in columns if c not in ("tap_in_tx_id", "tap_out_tx_id")]
            fn = jdbc_batch_writer(cfg.jdbc["url"], table, columns, cfg.jdbc["properties"], cfg.jdbc.get("append"))
            sinks[name] = _only_trips(fn) if name == "trips" else fn
        else:
            kept = ["record_type", *columns] if name == "trips" else columns
            sinks[name] = parquet_batch_writer(f"{b}/{table}", kept, checkpoint=checkpoint_of(cfg, name))
    return sinks


OUTPUT_MODES = {"raw": "append", "trips": "append", "flags": "update", "dlq": "append"}


def output_mode(cfg: JobConfig, name: str) -> str:
    """Counts that never restart are updated; idle-reset counts are appended."""
    return "append" if name == "flags" and cfg.crowd_idle_seconds is not None else OUTPUT_MODES[name]


def start_job(taps: DataFrame, cfg: JobConfig, trigger_override: dict | None = None):
    """Start every output; returns {name: StreamingQuery}."""
    outputs = build_outputs(taps, cfg)
    sinks = {**default_sinks(cfg), **cfg.sinks}
    queries = {}
    for name, df in outputs.items():
        trig = trigger_override or cfg.triggers[name]
        queries[name] = start_foreach_batch(
            df, sinks[name], checkpoint_of(cfg, name),
            output_mode=output_mode(cfg, name), trigger=trig, name=f"tapflow_{name}")
    return queries


def shared_sinks(cfg: JobConfig, hooks: dict | None = None) -> dict[str, CommittedTable]:
    """Dead letters and valid taps, both straight from a micro-batch."""
    b, ckpt = cfg.output_base.rstrip("/"), checkpoint_of(cfg, "shared")
    parts = {"dlq": (f"{b}/dlq/raw_bad", lambda rows: dead_letter(rows, cfg.strict_reference)),
             "valid": (f"{b}/valid_taps", lambda rows: valid_taps(rows, cfg.strict_reference).select(*TAP_FIELDS))}
    return {name: CommittedTable(path, ckpt, fn, **(hooks or {}).get(name, {})) for name, (path, fn) in parts.items()}


def start_shared_job(taps: DataFrame, cfg: JobConfig, trigger_override: dict | None = None, hooks: dict | None = None):
    """The same four outputs from one read of the source (M17).  One stateless
    query writes dead letters and valid taps, a commit per sink; the stateful
    queries (raw, trips, flags) follow the committed valid taps, each behind
    its own de-duplication.  Returns {name: StreamingQuery}; "shared" reads the
    source and must be drained first where triggers end."""
    trig = trigger_override or cfg.triggers["dlq"]
    queries = {"shared": start_foreach_batch(taps, fan_out(shared_sinks(cfg, hooks)), checkpoint_of(cfg, "shared"),
                                             trigger=trig, name="tapflow_shared")}
    if trigger_override and "availableNow" in trigger_override:
        drain(queries["shared"])
    schema = taps.select(*TAP_FIELDS).schema
    valid = follow_committed(taps.sparkSession, f"{cfg.output_base.rstrip('/')}/valid_taps", schema)
    sinks = {**default_sinks(cfg), **cfg.sinks}
    for name, df in build_outputs(valid, cfg).items():
        queries[name] = start_foreach_batch(df, sinks[name], checkpoint_of(cfg, name), output_mode=output_mode(cfg, name),
                                            trigger=trigger_override or cfg.triggers[name], name=f"tapflow_{name}")
    return queries


def jdbc_config(a) -> dict | None:
    if not a.jdbc_url:
        return None
    password = os.environ[a.jdbc_password_env] if a.jdbc_password_env else None
    extra = dict(o.split("=", 1) for o in a.jdbc_option)
    return {"url": a.jdbc_url, "properties": jdbc_properties(a.jdbc_user, password, **extra), "tap_ids": not a.jdbc_plain_trips}


def main(argv=None):
    from tapflow.session import build_session
    from tapflow.sources.envelope import decode_avro, decode_json, envelope_taps, read_kafka
    from tapflow.streaming.run import await_any_and_stop

    ap = argparse.ArgumentParser(description="tap job: raw, trips, flags, dead letters")
    ap.add_argument("--bootstrap-servers", required=True)
    ap.add_argument("--topic", default="bus-cardreader-event")
    ap.add_argument("--payload", choices=["avro", "json"], default="avro")
    ap.add_argument("--checkpoint-base", required=True)
    ap.add_argument("--output-base", required=True)
    ap.add_argument("--max-offsets-per-trigger", type=int,
                    help="rows per micro-batch; size it from the cluster (default: all there is)")
    ap.add_argument("--strict-reference", action="store_true")
    ap.add_argument("--shared-read", action="store_true",
                    help="read the topic once: the stateful queries follow a table of valid taps")
    ap.add_argument("--arrival-order", action="store_true",
                    help="pair taps as they arrive instead of in event-time order behind the watermark")
    ap.add_argument("--jdbc-url", help="write raw taps, trips and flags to this database")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", help="name of the variable that holds the password")
    ap.add_argument("--jdbc-plain-trips", action="store_true", help="trips table of nine columns, without the taps' ids")
    ap.add_argument("--crowd-idle-seconds", type=int, help="crowd counts start anew after this long without a tap")
    ap.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    a = ap.parse_args(argv)

    spark = build_session()
    raw = read_kafka(spark, a.bootstrap_servers, a.topic, a.max_offsets_per_trigger)
    taps = envelope_taps(raw, decode_avro if a.payload == "avro" else decode_json,
                         ntz_event_time=False)
    cfg = JobConfig(checkpoint_base=a.checkpoint_base, output_base=a.output_base,
                    strict_reference=a.strict_reference, ordered_pairing=not a.arrival_order,
                    jdbc=jdbc_config(a), shared_read=a.shared_read, crowd_idle_seconds=a.crowd_idle_seconds)
    queries = (start_shared_job if cfg.shared_read else start_job)(taps, cfg)
    await_any_and_stop(spark, list(queries.values()))


if __name__ == "__main__":
    main()
