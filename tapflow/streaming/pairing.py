"""Keyed pairing of taps into trips on a stream.

Cards are dealt by hash into a fixed number of buckets, and a bucket is the key
of the state: a call of the state function costs milliseconds whatever it is
given, which a call per card and micro-batch would pay for a few rows.  Per
card, the bucket's state holds the one waiting tap_in and, in ordered mode, the
rows that the watermark has not passed.  Each micro-batch call gets the bucket's
new rows; card by card they are ordered by (event_time, transaction_id),
the pending tap_in is put in front, and the batch rule applies unchanged:
a tap_out pairs iff the row before it is a tap_in of its card (done with column
shifts, not a row loop).  What is left pending is a card's last row if it is a
tap_in.

With ``max_open_seconds`` a tap_in waits at most that long in event time:
an event-time timeout at the bucket's earliest ``tap_in + max_open`` emits it as
``expired`` once the watermark passes, and a tap_out arriving later than that
does not pair.

By default (``ordered=True``) rows are held in state until the watermark has passed
them and only then paired, in event-time order, so a tap that arrives in a
later micro-batch than a newer tap of the same card (but within the
watermark delay) still pairs exactly as in the batch form.  The rows held
per card are bounded by the watermark delay times that card's tap rate.
``ordered=False`` pairs in arrival order, with less delay; there a tap_out
that is stamped before the waiting tap_in does not pair with it.
A row is final once its time is below the watermark the current batch
evicts with: rows of later batches older than that are dropped as late.

Spark does not allow a sort before a stateful operator on a stream, so the
rows of one bucket in one micro-batch are ordered here; their number is
bounded by the source's per-trigger limit (maxOffsetsPerTrigger /
maxFilesPerTrigger), not by the table size.  State is kept as a tuple (the
form ``GroupState.update`` expects), so it survives across micro-batches and
restarts via the checkpoint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tapflow.config import DEFAULT_PAIRING_BUCKETS
from tapflow.schemas import PAIRING_OUTPUT_SCHEMA, PAIRING_STATE_SCHEMA

_OUT_COLS = [f.name for f in PAIRING_OUTPUT_SCHEMA.fields]


def _trip_ids(cards: np.ndarray, tx_in: np.ndarray, tx_out: np.ndarray) -> list[str]:
    return [hashlib.sha256(f"{card}|{a}|{b}".encode()).hexdigest()
            for card, a, b in zip(cards, tx_in, tx_out)]


def _to_us(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


_EMPTY = pd.DataFrame({c: pd.Series([], dtype="object") for c in _OUT_COLS})


class _Rows:
    """Columns of a bucket's taps as numpy arrays."""

    FIELDS = ("card", "tx", "typ", "bus", "ts", "lat", "lon")

    def __init__(self, card, tx, typ, bus, ts, lat, lon):
        self.card, self.tx, self.typ, self.bus = card, tx, typ, bus
        self.ts, self.lat, self.lon = ts, lat, lon

    @classmethod
    def from_frame(cls, rows: pd.DataFrame) -> "_Rows":
        return cls(rows["card_id"].to_numpy(dtype=object),
                   rows["transaction_id"].to_numpy(dtype=object),
                   rows["event_type"].to_numpy(dtype=object),
                   rows["bus_id"].to_numpy(dtype=object),
                   _to_us(rows["event_time"]),
                   rows["latitude"].to_numpy(dtype="float64"),
                   rows["longitude"].to_numpy(dtype="float64"))

    @classmethod
    def from_state(cls, columns=None) -> "_Rows":
        card, tx, typ, bus, ts, lat, lon = columns or [[]] * 7
        return cls(np.array(card, dtype=object), np.array(tx, dtype=object), np.array(typ, dtype=object),
                   np.array(bus, dtype=object), np.array(ts, dtype="int64"),
                   np.array(lat, dtype="float64"), np.array(lon, dtype="float64"))

    def to_state(self) -> tuple:
        return tuple(getattr(self, f).tolist() for f in self.FIELDS)

    def __len__(self) -> int:
        return len(self.ts)

    def take(self, idx) -> "_Rows":
        return _Rows(*[getattr(self, f)[idx] for f in self.FIELDS])

    @staticmethod
    def concat(parts: list["_Rows"]) -> "_Rows":
        return _Rows(*[np.concatenate([getattr(p, f) for p in parts]) for f in _Rows.FIELDS])


def _card_by_card(waiting: _Rows, ready: _Rows) -> tuple[_Rows, np.ndarray]:
    """The rows card by card, each card's waiting tap_in first and the others
    by (event_time, transaction_id), and the card's number of each row."""
    rows = _Rows.concat([waiting, ready])
    number = pd.factorize(rows.card, use_na_sentinel=False)[0]
    later = np.arange(len(rows)) >= len(waiting)
    order = np.lexsort((rows.tx.astype(str), rows.ts, later, number))
    return rows.take(order), number[order]


def _trip_cols(r: _Rows, i0: np.ndarray, i1: np.ndarray) -> dict:
    n = len(i0)
    return {
        "record_type": np.full(n, "trip", dtype=object),
        "trip_id": np.array(_trip_ids(r.card[i0], r.tx[i0], r.tx[i1]), dtype=object),
        "card_id": r.card[i0], "bus_id": r.bus[i0],
        "tap_in_tx_id": r.tx[i0], "tap_out_tx_id": r.tx[i1],
        "tap_in_time": r.ts[i0], "tap_out_time": r.ts[i1],
        "tap_in_lat": r.lat[i0], "tap_in_lon": r.lon[i0],
        "tap_out_lat": r.lat[i1], "tap_out_lon": r.lon[i1],
    }


def _expired_cols(r: _Rows, idx: np.ndarray) -> dict:
    n = len(idx)
    none = np.full(n, None, dtype=object)
    nan = np.full(n, np.nan)
    return {
        "record_type": np.full(n, "expired", dtype=object), "trip_id": none,
        "card_id": r.card[idx], "bus_id": r.bus[idx],
        "tap_in_tx_id": r.tx[idx], "tap_out_tx_id": none,
        "tap_in_time": r.ts[idx], "tap_out_time": np.full(n, np.iinfo("int64").min),
        "tap_in_lat": r.lat[idx], "tap_in_lon": r.lon[idx],
        "tap_out_lat": nan, "tap_out_lon": nan,
    }


def _frame(parts: list[dict]) -> pd.DataFrame:
    """One output frame from column pieces (times as epoch us, min = null)."""
    if not parts:
        return _EMPTY
    cols = {c: np.concatenate([p[c] for p in parts]) for c in _OUT_COLS}
    for c in ("tap_in_time", "tap_out_time"):
        us = cols[c]
        cols[c] = pd.to_datetime(np.where(us == np.iinfo("int64").min, 0, us), unit="us")
        cols[c] = cols[c].where(us != np.iinfo("int64").min)
    return pd.DataFrame(cols, columns=_OUT_COLS)


def make_pairing_function(max_open_seconds: int | None = None, ordered: bool = True):
    max_open_us = None if max_open_seconds is None else int(max_open_seconds) * 1_000_000

    def pair(key: tuple, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        saved = state.get if state.exists else None
        kept = _Rows.from_state(saved[1:] if saved is not None else None)
        settled = int(saved[0]) if saved is not None else 0
        waiting, held = kept.take(slice(0, settled)), kept.take(slice(settled, None))
        frames = [c for c in chunks if len(c)]
        parts = [held] + ([_Rows.from_frame(pd.concat(frames, ignore_index=True))]
                          if frames else [])
        rows = _Rows.concat(parts)
        timed = ordered or max_open_us is not None
        wm_ms = state.getCurrentWatermarkMs() if timed else None

        if ordered:
            final_mask = rows.ts < wm_ms * 1000
            ready, held = rows.take(np.nonzero(final_mask)[0]), rows.take(np.nonzero(~final_mask)[0])
        else:
            ready, held = rows, rows.take(np.array([], dtype=int))

        out = []
        if len(ready):
            ready, number = _card_by_card(waiting, ready)
            typ, ts, n = ready.typ, ready.ts, len(ready)
            first = np.ones(n, dtype=bool)       # of its card
            first[1:] = number[1:] != number[:-1]
            last = np.append(first[1:], True)
            gap = np.zeros(n, dtype="int64")
            gap[1:] = ts[1:] - ts[:-1]
            prev_in = np.zeros(n, dtype=bool)
            prev_in[1:] = typ[:-1] == "tap_in"
            within = ~first & (gap >= 0)         # in arrival order an older tap_out may follow
            if max_open_us is not None:
                within &= gap <= max_open_us
            at = np.nonzero((typ == "tap_out") & prev_in & within)[0]
            if len(at):
                out.append(_trip_cols(ready, at - 1, at))
            if max_open_us is not None:
                # tap_ins whose next row comes later than the allowance expire
                nxt = np.append(gap[1:], 0)
                exp = np.nonzero((typ == "tap_in") & ~last & (nxt > max_open_us))[0]
                if len(exp):
                    out.append(_expired_cols(ready, exp))
            waiting = ready.take(np.nonzero(last & (typ == "tap_in"))[0])

        deadlines = []
        if len(waiting) and max_open_us is not None:
            deadline_ms = (waiting.ts + max_open_us) // 1000
            over = deadline_ms < wm_ms
            if over.any():
                out.append(_expired_cols(waiting, np.nonzero(over)[0]))
                waiting, deadline_ms = waiting.take(np.nonzero(~over)[0]), deadline_ms[~over]
            if len(waiting):
                deadlines.append(int(deadline_ms.min()))
        if len(held):
            deadlines.append(int(held.ts.min()) // 1000)

        if not len(waiting) and not len(held):
            if state.exists:
                state.remove()
        else:
            state.update((len(waiting), *_Rows.concat([waiting, held]).to_state()))
            if deadlines:
                # fires once the watermark passes the earliest deadline
                state.setTimeoutTimestamp(max(min(deadlines), wm_ms))

        yield _frame(out)

    return pair


def pair_taps_stream(good: DataFrame, max_open_seconds: int | None = None,
                     ordered: bool = True, buckets: int = DEFAULT_PAIRING_BUCKETS) -> DataFrame:
    """Trips (and, with ``max_open_seconds``, expired tap_ins) from a stream
    of good taps that already carries a watermark on ``event_time``.
    ``buckets`` stays the same for the life of a checkpoint."""
    timed = max_open_seconds is not None or ordered
    bucket = F.pmod(F.xxhash64("card_id"), F.lit(buckets)).cast("int")
    return good.withColumn("card_bucket", bucket).groupBy("card_bucket").applyInPandasWithState(
        make_pairing_function(max_open_seconds, ordered),
        outputStructType=PAIRING_OUTPUT_SCHEMA,
        stateStructType=PAIRING_STATE_SCHEMA,
        outputMode="append",
        timeoutConf=(GroupStateTimeout.EventTimeTimeout if timed
                     else GroupStateTimeout.NoTimeout),
    )
