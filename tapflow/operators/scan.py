"""Ordered per-key scans that stay parallel when one key is huge.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to a
single task.  Per card that is usually harmless, but one vehicle (or a test
card) can carry a third of all taps.  The scans here split only the *hot*
keys into ``(key, time slice)`` groups and stitch the slices together
exactly:

0. hot keys (never a key with a null part) are found by a small job on the
   narrow (key, time) projection of a deterministic sample (rows whose hash
   of the order columns falls in 1 of ``sample_every`` buckets), once per plan
   and on the rows as read if the plan hands in ``HotKeys``, and not at all if
   the input files are too small to hold a hot key; a key is hot
   when its sampled count implies at least ``hot_key_rows`` rows, so at most
   N / ``hot_key_rows`` keys qualify.  Without a hot key the scan is the plain
   window.  A hot key's slices are cut at quantiles of its sampled times, so
   they hold about ``hot_key_rows / 4`` rows each however the times are
   spread; its rows without a time are a slice of their own, before the rest.
   The sample only decides the partitioning: every row is processed and the
   results are the same whichever keys are hot;
1. a small summary per hot ``(key, slice)``: the slice total for running
   sums, its last (or first) row for neighbour lookups;
2. a window over the summaries per key (one row per slice, so tiny) gives
   each slice its carry-in: the sum of all earlier slices, the last row of
   the previous non-empty slice;
3. the main window runs per ``(key, slice)`` (slice is null for keys that
   are not hot, i.e. one group per key) and adds the carry-in.

The big side is shuffled once, on ``(key, slice)``; the carry join uses the
same keys, so the window reuses that partitioning, and AQE broadcasts the
summary side when its measured size is small (sort-merge join otherwise).
Results are identical to the single-window form (running sums are
associative; the row before the first row of a slice is the last row of the
previous slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow import config
from tapflow.functions.times import epoch_micros

_BKT = "_scan_bucket"
DEFAULT = "default"   # resolve from tapflow.config at call time


def _resolve(bucket_seconds, hot_key_rows, sample_every):
    return (config.DEFAULT_SCAN_BUCKET_SECONDS if bucket_seconds == DEFAULT else bucket_seconds,
            config.DEFAULT_HOT_KEY_ROWS if hot_key_rows == DEFAULT else hot_key_rows,
            config.DEFAULT_HOT_KEY_SAMPLE_EVERY if sample_every == DEFAULT else sample_every)


def _unique(cols: Sequence[str]) -> list[str]:
    seen: list[str] = []
    for c in cols:
        if c not in seen:
            seen.append(c)
    return seen


MAX_SLICES = 1000             # slices of one key, at most
_NO_TIME = -(1 << 62)         # the slice of rows without a time


def _sliced_everywhere(df: DataFrame, keys: list[str], time_col: str, bucket_seconds: int) -> DataFrame:
    """Slices of fixed width for every key without a null part."""
    not_null = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    bucket = F.floor(epoch_micros(df, time_col) / F.lit(bucket_seconds * 1_000_000)).cast("long")
    return df.withColumn(_BKT, F.when(not_null, F.coalesce(bucket, F.lit(_NO_TIME))))


#: A stored tap (id, key, time) takes more bytes than this in any file.
MIN_ROW_BYTES = 4


def _cannot_be_hot(df: DataFrame, hot_key_rows: int) -> bool:
    """All inputs together are too small for ``hot_key_rows`` rows: known from
    the plan's file sizes, without a job."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:          # Spark Connect: the plan is not at hand
        return False
    return size < MIN_ROW_BYTES * hot_key_rows


def _hot_cuts(rows: DataFrame, keys: list[str], hashed: list[str], time_col: str, hot_key_rows: int,
              every: int) -> list[tuple]:
    """(key..., cut times) of the hot keys, from a sample of ``rows``: at most
    rows / ``hot_key_rows`` keys, each with fewer than ``MAX_SLICES`` cuts."""
    if _cannot_be_hot(rows, hot_key_rows):
        return []
    epoch = epoch_micros(rows, time_col)
    sample = rows if every == 1 else rows.where(
        F.pmod(F.xxhash64(*[F.col(c) for c in hashed]), F.lit(every)) == 0)
    # keys with a null part are never sliced (one group, no carry needed), so
    # every join below is a plain equi-join on the window's own keys
    sample = sample.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).select(*keys, epoch.alias("_us"))
    counts = (sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= max(1, hot_key_rows // every)).collect())
    if not counts:
        return []
    hk, types = _key_names(rows, keys)
    hot = rows.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in counts],
                                            ", ".join(f"{h} {t}" for h, t in zip(hk, types)))
    fractions = [i / MAX_SLICES for i in range(1, MAX_SLICES)]
    times = (sample.join(hot, [F.col(k) == hot[h] for k, h in zip(keys, hk)]).groupBy(*keys)
             .agg(F.percentile_approx("_us", fractions, 10 * MAX_SLICES).alias("_q")).collect())
    quantiles = {tuple(r[k] for k in keys): r["_q"] or [] for r in times}
    cuts = []
    for r in counts:
        key = tuple(r[k] for k in keys)
        slices = min(MAX_SLICES, max(1, -(-4 * r["_n"] * every // hot_key_rows)))
        q = quantiles.get(key, [])
        picked = [q[i * len(q) // slices] for i in range(1, slices)] if q else []
        cuts.append((*key, sorted(set(picked))))
    return cuts


def _key_names(df: DataFrame, keys: list[str]) -> tuple[list[str], list[str]]:
    return [f"_hk{i}" for i in range(len(keys))], [df.schema[k].dataType.simpleString() for k in keys]


class HotKeys:
    """The hot keys of a table, for all scans of a plan.

    They are found on ``rows`` as they are read, below any de-duplication or
    earlier scan, so the sample shuffles a thousandth of two columns and runs
    once however many scans follow.  A copy more or less does not matter: cuts
    only decide the partitioning."""

    def __init__(self, rows: DataFrame, time_col: str = "event_time", hashed: Sequence[str] = ("transaction_id", "event_time"),
                 hot_key_rows: int | None | str = DEFAULT, sample_every: int | str = DEFAULT):
        _, self.hot_key_rows, self.sample_every = _resolve(None, hot_key_rows, sample_every)
        self.rows, self.time_col, self.hashed, self._found = rows, time_col, list(hashed), {}

    def mapped(self, fn) -> "HotKeys":
        """The same for rows with further key columns."""
        return HotKeys(fn(self.rows), self.time_col, self.hashed, self.hot_key_rows, self.sample_every)

    def cuts(self, keys: list[str]) -> list[tuple]:
        if tuple(keys) not in self._found:
            self._found[tuple(keys)] = _hot_cuts(self.rows, keys, self.hashed, self.time_col, self.hot_key_rows,
                                                 max(1, int(self.sample_every)))
        return self._found[tuple(keys)]


def _hot_slices(df: DataFrame, keys: list[str], order: list[str], time_col: str, bucket_seconds: int,
                hot_key_rows: int | None, sample_every: int, hot: HotKeys | None = None) -> DataFrame | None:
    """``df`` plus ``_scan_bucket``: the time slice for rows of hot keys,
    null for the rest.  None when no key is hot."""
    if not hot_key_rows:
        return _sliced_everywhere(df, keys, time_col, bucket_seconds)
    cuts = hot.cuts(keys) if hot else _hot_cuts(df, keys, keys + order, time_col, hot_key_rows, max(1, int(sample_every)))
    if not cuts:
        return None
    hk, types = _key_names(df, keys)
    slices = df.sparkSession.createDataFrame(cuts, ", ".join(f"{h} {t}" for h, t in zip(hk, types)) + ", _cuts array<bigint>")
    j = df.join(slices, [df[k] == slices[h] for k, h in zip(keys, hk)], "left")
    us = epoch_micros(df, time_col)
    at = F.when(us.isNull(), F.lit(_NO_TIME)).otherwise(
        F.size(F.filter("_cuts", lambda x: x <= us)).cast("long"))
    return j.select(*[df[c] for c in df.columns], F.when(F.col("_cuts").isNotNull(), at).alias(_BKT))


def _carry_cols(keys: Sequence[str]) -> list[Column]:
    """Key and slice columns of the carry table under private names."""
    return [F.col(k).alias(f"_ck{i}") for i, k in enumerate(keys)] + [F.col(_BKT).alias("_ckb")]


def _join_carry(d: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the per-(key, slice) carry-in.  A plain equi-join on exactly
    the window's partition keys, so one exchange serves join and window.
    Rows of keys that are not hot (slice null) find no carry row."""
    cond = [d[k] == carry[f"_ck{i}"] for i, k in enumerate(keys)]
    cond.append(d[_BKT] == carry["_ckb"])
    return d.join(carry, cond, "left")


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                sums: dict[str, Column], maxes: dict[str, Column] | None = None,
                time_col: str = "event_time",
                bucket_seconds: int | None | str = DEFAULT,
                hot_key_rows: int | None | str = DEFAULT,
                sample_every: int | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Add running sums ``name = sum(expr)``, and running maxima, over rows of
    the same key up to and including the current row, in ``order``.
    ``order`` must start with ``time_col`` and be total within a key."""
    keys, order = list(keys), list(order)
    bucket_seconds, hot_key_rows, sample_every = _resolve(bucket_seconds, hot_key_rows,
                                                          sample_every)
    maxes = maxes or {}
    aggs = {n: (F.sum, e) for n, e in sums.items()} | {n: (F.max, e) for n, e in maxes.items()}
    base_cols = [c for c in df.columns if c not in aggs]
    d = _hot_slices(df, keys, order, time_col, bucket_seconds, hot_key_rows, sample_every, hot) if bucket_seconds else None
    if d is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return df.select(*base_cols, *[fn(e).over(w).alias(n) for n, (fn, e) in aggs.items()])

    totals = d.where(F.col(_BKT).isNotNull()).groupBy(*keys, _BKT).agg(
        *[fn(e).alias(f"_tot{i}") for i, (fn, e) in enumerate(aggs.values())])
    before = Window.partitionBy(*keys).orderBy(_BKT).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = totals.select(*_carry_cols(keys), *[
        fn(f"_tot{i}").over(before).alias(f"_carry{i}") for i, (fn, _) in enumerate(aggs.values())])
    j = _join_carry(d, carry, keys)
    w = Window.partitionBy(*keys, _BKT).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)

    def joined(i, fn, e):
        here, earlier = fn(e).over(w), F.col(f"_carry{i}")
        return F.greatest(here, earlier) if fn is F.max else here + F.coalesce(earlier, F.lit(0))

    return j.select(*[d[c] for c in base_cols], *[
        joined(i, fn, e).alias(n) for i, (n, (fn, e)) in enumerate(aggs.items())])


def with_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  cols: Sequence[str], name: str, direction: str = "previous",
                  time_col: str = "event_time",
                  bucket_seconds: int | None | str = DEFAULT,
                  hot_key_rows: int | None | str = DEFAULT,
                  sample_every: int | str = DEFAULT, hot: HotKeys | None = None) -> DataFrame:
    """Add ``name``: a struct of ``order + cols`` taken from the previous
    (or next) row of the same key in ``order``; null at the key's edge."""
    keys, order = list(keys), list(order)
    bucket_seconds, hot_key_rows, sample_every = _resolve(bucket_seconds, hot_key_rows,
                                                          sample_every)
    fields = _unique(order + list(cols))
    row = F.struct(*[F.col(c) for c in fields])
    prev = direction == "previous"
    shift = F.lag if prev else F.lead
    base_cols = [c for c in df.columns if c != name]

    d = _hot_slices(df, keys, order, time_col, bucket_seconds, hot_key_rows, sample_every, hot) if bucket_seconds else None
    if d is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*base_cols, shift(row).over(w).alias(name))

    edge_fn = F.max if prev else F.min
    edges = d.where(F.col(_BKT).isNotNull()).groupBy(*keys, _BKT).agg(
        edge_fn(row).alias("_edge"))
    by_slice = Window.partitionBy(*keys).orderBy(_BKT)
    carry = edges.select(*_carry_cols(keys), shift("_edge").over(by_slice).alias("_carry"))
    j = _join_carry(d, carry, keys)
    w = Window.partitionBy(*keys, _BKT).orderBy(*order)
    return j.select(*[d[c] for c in base_cols],
                    F.coalesce(shift(row).over(w), F.col("_carry")).alias(name))
