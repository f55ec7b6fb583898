"""A segmented Bloom filter that Spark builds and tasks test.

Each task sends, per segment of the filter, the probe positions of its
values (each value at most twice); a segment's group marks the positions that
were hit at least ``times`` times.  The filter of ``times=2`` holds the values
that may occur twice, that of ``times=1`` the values themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapflow.llm.common import mix64

PROBES = 3
BITS_PER_ROW = 12
SEGMENT_BITS = 1 << 20
MAX_FILTER_BYTES = 256 << 20
_STEPS = np.arange(1, PROBES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def segments_for(rows: int, max_bytes: int = MAX_FILTER_BYTES) -> int:
    """Segments for so many rows, within the bound."""
    bits = min(max(1, rows) * BITS_PER_ROW, 8 * max_bytes)
    return max(1, math.ceil(bits / SEGMENT_BITS))


def _positions(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each value and its probe positions inside the segment."""
    seg = (mix64(h) % np.uint64(segments)).astype(np.int64)
    probes = np.empty((PROBES, len(h)), np.uint32)
    for k in range(PROBES):
        probes[k] = mix64(h + _STEPS[k]) % np.uint64(SEGMENT_BITS)
    return seg, probes


def _probe_rows(values, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held) if held else np.empty(0, np.uint64)
            if not len(h):
                return
            distinct, counts = np.unique(h, return_counts=True)
            h = np.concatenate([distinct, distinct[counts > 1]])       # at most twice
            seg, probes = _positions(h, segments)
            order = np.argsort(seg, kind="stable")
            seg, probes = seg[order], probes[:, order]
            ids, starts = np.unique(seg, return_index=True)
            parts = [p.T.tobytes() for p in np.split(probes, starts[1:], axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.binary())],
                                             ["seg", "pos"])

        for b in batches:
            h = values(b)
            held.append(h)
            rows += len(h)
            if rows >= 1 << 20:
                yield from flush()
                held, rows = [], 0
        yield from flush()
    return run


def _merge(times: int):
    def run(group: pa.Table) -> pa.Table:
        once, twice = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
        for part in group.column("pos").to_pylist():
            p, c = np.unique(np.frombuffer(part, np.uint32), return_counts=True)
            twice[p] |= once[p] | (c > 1)
            once[p] = True
        bits = np.packbits(twice if times == 2 else once).tobytes()
        return pa.table({"seg": pa.array([group.column("seg")[0].as_py()], pa.int64()),
                         "bits": pa.array([bits], pa.binary())})
    return run


def build(rows: DataFrame, values, segments: int, times: int = 1):
    """A broadcast {segment: bits}; ``values(batch)`` gives uint64 values."""
    filled = (rows.mapInArrow(_probe_rows(values, segments), "seg long, pos binary")
                  .groupBy("seg").applyInArrow(_merge(times), "seg long, bits binary"))
    return rows.sparkSession.sparkContext.broadcast(
        {x["seg"]: bytes(x["bits"]) for x in filled.toLocalIterator()})


def may_hold(h: np.ndarray, bits: dict[int, bytes], segments: int) -> np.ndarray:
    """Which values the filter may hold."""
    seg, probes = _positions(h, segments)
    hit = np.ones(len(h), bool)
    for s in np.unique(seg):
        at = np.flatnonzero(seg == s)
        packed = bits.get(int(s))
        if packed is None:
            hit[at] = False
            continue
        packed = np.frombuffer(packed, np.uint8)
        for k in range(PROBES):
            p = probes[k, at]
            hit[at] &= (packed[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1).astype(bool)
    return hit
