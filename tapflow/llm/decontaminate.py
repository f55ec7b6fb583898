"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a run of words; the words under its 1s are
hashed, those under its 0s are ignored, so a hit survives a substituted word
there.  The seeds' hashes of the benchmark items are joined with those of the
documents, and every hit is verified on its diagonal: item and document are
laid side by side at the hit, and of the stretches in which at least
``identity`` of the words agree the one with the most equal words is taken.  A document is contaminated by an
item when that stretch holds ``min_matched`` equal words, or
``identity`` of the item's words where the item is shorter.

The benchmark is cut into blocks of bounded size; each block is one broadcast
hash table, and the documents run through the blocks one after another in the
same stage, so nothing is shuffled and no document is held back.

Defined results: null and empty texts match nothing; items below ``min_item``
words are not judged; repeated items and rows each get their own result; an
empty benchmark finds nothing and an empty table gives no rows.  Inputs are
renamed on reading, so further columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import WordHashes, mix64, words

SEEDS = ("110110111", "11101011", "1011101101", "111111")
MIN_MATCHED = 10
IDENTITY = 0.8
MIN_ITEM = 6
#: Hash entries of one block of the benchmark (16 bytes each).
BLOCK_ENTRIES = 2_000_000
_FILTER_BITS = 22


def seed_hashes(h: np.ndarray, seed: str) -> np.ndarray:
    """The seed's hash at every position where it fits."""
    n = len(h) - len(seed) + 1
    if n <= 0:
        return h[:0]
    out = np.full(n, len(seed), np.uint64)
    with np.errstate(over="ignore"):
        for k, bit in enumerate(seed):
            if bit == "1":
                out += h[k:k + n] * _ODD[k]
    return mix64(out)


_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def share_of(identity: float) -> tuple[int, int]:
    """The share as whole numbers, numerator and denominator."""
    return Fraction(identity).limit_denominator(1000).as_integer_ratio()


class Block:
    """Hash table over the seeds of some benchmark items."""

    def __init__(self, items: list[tuple[object, str]]):
        hashes = WordHashes()
        self.ids, self.tokens = [], []
        parts = []
        for item_id, text in items:
            h = hashes.of(words(text or ""))
            if len(h) < MIN_ITEM:
                continue
            for s, seed in enumerate(SEEDS):
                x = seed_hashes(h, seed)
                if len(x):
                    at = np.full(len(x), len(self.ids), np.int64)
                    parts.append((x ^ np.uint64(s), at, np.arange(len(x))))
            self.ids.append(item_id)
            self.tokens.append(h)
        cat = [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in range(3)]
        order = np.argsort(cat[0], kind="stable")
        self.hash = cat[0][order].astype(np.uint64)
        self.item, self.at = cat[1][order], cat[2][order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hash >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, h: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of every hit; the diagonal is the document
        position at which the item would begin."""
        found: set[tuple[int, int]] = set()
        for s, seed in enumerate(SEEDS):
            x = seed_hashes(h, seed) ^ np.uint64(s)
            maybe = np.flatnonzero(self.filter[x >> np.uint64(64 - _FILTER_BITS)])
            if not len(maybe):
                continue
            lo, hi = np.searchsorted(self.hash, x[maybe]), np.searchsorted(self.hash, x[maybe], "right")
            for p, a, b in zip(maybe[hi > lo], lo[hi > lo], hi[hi > lo]):
                found.update(zip(self.item[a:b].tolist(), (p - self.at[a:b]).tolist()))
        return found

    def overlap(self, h: np.ndarray, item: int, diagonal: int, identity: float) -> tuple[int, int, int, int]:
        """(document start, item start, length, equal words) of the stretch
        on a diagonal with the most equal words among those of which at least
        ``identity`` are equal; the first of several."""
        t = self.tokens[item]
        a, b = max(0, -diagonal), min(len(t), len(h) - diagonal)
        same = t[a:b] == h[diagonal + a:diagonal + b]
        # in whole numbers: a stretch has that share of equal words where its
        # score is not negative, so from each start the furthest end at no
        # lower sum holds the most equal words
        num, den = share_of(identity)
        sums = np.concatenate([[0], np.cumsum(np.where(same, den - num, -num))])
        equal = np.concatenate([[0], np.cumsum(same)])
        peak = np.maximum.accumulate(sums[::-1])                 # highest sum from each end on, last end first
        ends = len(sums) - 1 - np.searchsorted(peak, sums)
        start = int((equal[ends] - equal).argmax())
        at = start + np.flatnonzero(same[start:ends[start]])     # unequal words at either side are no part of it
        if not len(at):
            return diagonal + a, a, 0, 0
        return diagonal + a + int(at[0]), a + int(at[0]), int(at[-1] - at[0]) + 1, len(at)


def _scan(block, min_matched: int, identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        hashes = WordHashes()
        num, den = share_of(identity)
        for b in batches:
            found = []
            for text, before in zip(b.column("_text").to_pylist(), b.column("_found").to_pylist()):
                best: dict[int, tuple] = {}
                h = hashes.of(words(text or ""))
                for item, diagonal in held.hits(h):
                    o = held.overlap(h, item, diagonal, identity)
                    need = min(min_matched, -(-num * len(held.tokens[item]) // den))
                    if o[3] >= need and (item not in best or (o[3], -o[0]) > (best[item][3], -best[item][0])):
                        best[item] = o
                found.append((before or []) + [
                    {"item_id": held.ids[k], "doc_start": o[0], "item_start": o[1], "length": o[2], "equal": o[3]}
                    for k, o in sorted(best.items())])
            at = b.schema.get_field_index("_found")
            yield b.set_column(at, b.schema.field(at), pa.array(found, b.schema.field(at).type))
    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", min_matched: int = MIN_MATCHED,
                  identity: float = IDENTITY, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: id and ``matches`` (item_id, doc_start, item_start, length, equal; positions in words)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("t"))
    # a word gives an entry per seed; words are at least two characters apart
    entries = items.agg(F.sum(F.length("t") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(entries * len(SEEDS) / block_entries))
    item_type = benchmark.schema[item_col].dataType.simpleString()
    found = f"array<struct<item_id:{item_type},doc_start:int,item_start:int,length:int,equal:int>>"
    out = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.lit(None).cast(found).alias("_found"))
    schema = out.schema
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == k).orderBy("item", "t").collect()
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(Block([tuple(r) for r in part])),
                                   min_matched, identity), schema)
    return out.select(id_col, F.col("_found").alias("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns."""
    rows = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return find_overlaps(rows, benchmark, id_col="_row", **options).where(F.size("matches") == 0).select("_row.*")
