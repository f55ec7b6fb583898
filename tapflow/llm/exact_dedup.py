"""Exact de-duplication by two passes over a Bloom filter.

Texts are equal when identical after lower-casing A-Z only; of equal texts
the row with the largest id stays.

Pass 0 writes one narrow row per document: id, row number, SHA-256 of the
normalised text.  Pass 1 builds the filter: each task sends, per segment of
the filter, the probe positions of its hashes (each hash at most twice), and
the segment's group marks the positions that were hit at least twice.  A
hash all of whose positions were hit twice is *possibly repeated*; a hash
with one position hit once occurs once for certain.  Pass 2 tests every row:
rows that occur once pass straight through, and only possibly repeated rows
are shuffled by their SHA-256 and grouped.  False positives only cost a
little shuffle: the grouping compares whole SHA-256 values.

The filter takes about 12 bits a document and is broadcast, so its size is
checked: beyond ``max_filter_bytes`` the hashes are split into ranges that
are filtered one after another, each with a filter below the bound.

Defined results: null text counts as empty, so all null and empty texts form
one group; a null id loses to any id; of rows equal in id and text, one row
(the last in the written order) is kept; an empty table gives no rows.  Only
the two named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.llm import bloom
from tapflow.llm.common import written


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        # bytes.lower() changes A-Z only
        sha = [hashlib.sha256((t or b"").lower()).digest() for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(sha, pa.binary())], ["id", "uid", "sha"])


def _hashes(column: pa.Array) -> np.ndarray:
    """The first 8 bytes of each SHA-256."""
    return np.array([int.from_bytes(v[:8], "little") for v in column.to_pylist()], np.uint64)


def _in_range(b: pa.RecordBatch, ranges: int, r: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of hash range ``r`` and their hashes."""
    h = _hashes(b.column("sha"))
    if ranges == 1:
        return b, h
    mine = (h >> np.uint64(40)) % np.uint64(ranges) == r
    return b.filter(pa.array(mine)), h[mine]


def _tested(bits, segments: int, ranges: int, r: int):
    """Pass 2: adds ``repeated`` to the rows of hash range ``r``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b, h = _in_range(b, ranges, r)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bloom.may_hold(h, bits.value, segments))],
                                             [*b.schema.names, "repeated"])
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bytes: int = bloom.MAX_FILTER_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept,
    text_sha256."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = written(
        docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"),
                    F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(_digests, f"id {id_type}, uid long, sha binary"), "dedup-rows")

    n = rows.count()
    ranges = max(1, math.ceil(n * bloom.BITS_PER_ROW / 8 / max_filter_bytes))
    segments = bloom.segments_for(math.ceil(n / ranges))
    tested = None
    for r in range(ranges):
        bits = bloom.build(rows.select("sha"), lambda b, r=r: _in_range(b, ranges, r)[1], segments, times=2)
        part = rows.mapInArrow(_tested(bits, segments, ranges, r),
                               f"id {id_type}, uid long, sha binary, repeated boolean")
        part = written(part, "dedup-tested")
        tested = part if tested is None else tested.unionAll(part)

    suspects = tested.where("repeated").select("id", "uid", "sha")
    groups = written(
        suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"),
                                    F.max(F.struct("id", "uid")).alias("keep")), "dedup-groups")
    # both sides are scans, so a hot text's partition can be split at run time
    grouped = suspects.join(groups, "sha").select(
        "id", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("keep.uid")).alias("kept"), "sha")
    single = tested.where(~F.col("repeated")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    return single.unionAll(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))
