"""Sharding by balanced label propagation.

Documents are nodes, links are weighted edges (for the registered query:
equal texts).  Every linked document starts in a shard by hash and then, in
rounds of joins, asks for the shard where most of its neighbours are.  A
document that outranks all its neighbours (more links, then lower number)
holds its place, so neighbours gather around it instead of swapping places.
Moves pass under quotas: no shard may gain more than its room under the
capacity (total / shards), but what leaves it in the same round makes room,
so full shards swap.  The driver balances the bytes asked from shard to shard
(a min-cost flow over a shards x shards matrix); the granted share of each
pair is picked by hash.  Rounds go on until no move is granted or two rounds
in a row cut no fewer edges; the labels with the fewest cut edges count.  A
round's tables are written in a file per 250,000 links and deleted after it, so
a round costs a task per file, not one per shuffle partition, and neither files
nor cached file listings pile up.

Documents without links cut no edge wherever they lie, so they level the
shards afterwards: those above 1/1024 of a shard one by one, largest first,
the rest in 65,536 hash bins, each to the shard with the most room.  The
driver sees sums per shard and per bin, and fewer than 16,384 ids (no more
documents can be that large), whatever the size of the corpus.

Law ``bytes``: sizes near equal.  Defined results: null text has no link and
size 1; empty texts are equal texts; rows equal in id and text are two rows
and get two slots; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapflow.llm.common import drop_written, written

BINS = 1 << 16
LARGE = 1024                 # documents above 1/LARGE of a shard go one by one
SLOT_BLOCK = 20_000
FILE_ROWS = 250_000          # rows of a file of the linked nodes' small tables


def _hash_share(*parts):
    """A hash of the parts as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


def text_links(rows: DataFrame) -> DataFrame:
    """(src, dst) between equal texts: each copy and the first of its group.
    ``rows``: uid, text_key (null: no link)."""
    known = rows.where(F.col("text_key").isNotNull()).select("uid", "text_key")
    groups = written(known.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("dst"))
                     .where("n > 1").select("text_key", "dst"), "shard-groups")
    return known.join(groups, "text_key").where("uid <> dst").select(F.col("uid").alias("src"), "dst")


def grant(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The most of the bytes ``asked`` (from shard, to shard) such that no
    shard gains more than its ``room``.  All is granted first; what a shard
    then has too much is taken back along the shortest ways to shards with
    room, where a step back from j to i takes a move i -> j back and a step
    from i to j grants it again."""
    given = asked.astype(float)
    over = given.sum(0) - given.sum(1) - np.maximum(room, 0)
    tiny = 1e-9 * (1 + given.sum())
    while over.max(initial=0) > tiny:
        # cost of a step u -> v: 1 takes v's move to u back, -1 grants u's to v
        cost = np.where(given.T > tiny, 1.0, np.inf)
        cost[asked - given > tiny] = -1.0
        dist = np.where(over > tiny, 0.0, np.inf)
        via = np.full(len(over), -1)
        for _ in over:
            by = dist[:, None] + cost
            better = by.min(0) < dist
            if not better.any():
                break
            via[better] = by.argmin(0)[better]
            dist = np.minimum(dist, by.min(0))
        end = int(np.where(over < -tiny, dist, np.inf).argmin())
        if over[end] >= -tiny or not np.isfinite(dist[end]):
            break
        way = [end]
        while via[way[-1]] >= 0:
            way.append(int(via[way[-1]]))
        steps = list(zip(way[1:], way))
        amount = min([over[way[-1]], -over[end]] + [
            asked[u, v] - given[u, v] if cost[u, v] < 0 else given[v, u] for u, v in steps])
        for u, v in steps:
            if cost[u, v] < 0:
                given[u, v] += amount
            else:
                given[v, u] -= amount
        over[way[-1]] -= amount
        over[end] += amount
    return given


def propagate(nodes: DataFrame, links: DataFrame, shards: int, capacity: float) -> DataFrame:
    """(uid, size, label) of the linked nodes.  ``links``: src, dst."""
    both = written(links.select("src", "dst").unionAll(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
                   .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight")), "shard-links")
    # linked nodes are few: without this every table of a round would be cut into
    # as many files as there are shuffle partitions
    files = max(1, math.ceil(both.count() / FILE_ROWS))

    def small(frame, name):
        return written(frame.coalesce(files), name)

    degree = small(both.groupBy(F.col("src").alias("uid")).agg(F.sum("weight").alias("degree")), "shard-degrees")
    # the strongest neighbour of each node, seen once: who outranks it?
    rank = F.struct("degree", (-F.col("uid")).alias("first"))
    above = (both.join(degree.select(F.col("uid").alias("src"), rank.alias("r")), "src")
             .groupBy(F.col("dst").alias("uid")).agg(F.max("r").alias("r")))
    state = small(degree.join(above, "uid").join(nodes, "uid").select(
        "uid", "size", (F.col("r") < rank).alias("holds"),
        F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("label")), "shard-labels")
    followers = small(both.join(state.where("not holds").select(F.col("uid").alias("dst")), "dst"),
                      "shard-followers")
    best, most, stale = state, -1, 0
    for k in count():
        votes = (followers.join(state.select(F.col("uid").alias("src"), "label"), "src")
                 .groupBy(F.col("dst").alias("uid"), F.col("label").alias("vote")).agg(F.sum("weight").alias("n"))
                 .groupBy("uid").agg(F.max(F.struct("n", (-F.col("vote")).alias("v"))).alias("best"),
                                     F.map_from_entries(F.collect_list(F.struct("vote", "n"))).alias("by")))
        # a node has at most ``shards`` different votes
        here = F.coalesce(F.element_at("by", F.col("label")), F.lit(0))
        wish = small(state.join(votes, "uid", "left").select(
            "uid", "size", "holds", "label", here.alias("here"),
            F.when(F.col("best.n") > here, -F.col("best.v")).cast("int").alias("want")), f"shard-wish-{k}")
        # at most shards * (shards + 1) rows
        sums = wish.groupBy("label", "want").agg(F.sum("size").alias("s"), F.sum("here").alias("h")).collect()
        whole = sum(r["h"] for r in sums)                        # links that are not cut
        if whole > most:
            if best is not state:
                drop_written(best)
            best, most, stale = state, whole, 0
        else:
            stale += 1
        load, asked = np.zeros(shards), np.zeros((shards, shards))
        for r in sums:
            load[r["label"]] += r["s"]
            if r["want"] is not None:
                asked[r["label"], r["want"]] = r["s"]
        given = grant(asked, capacity - load)
        shares = {int(i * shards + j): float(given[i, j] / asked[i, j]) for i, j in zip(*np.nonzero(asked))
                  if given[i, j] >= 1}
        if stale == 2 or not shares:
            drop_written(wish, *([] if state is best else [state]))
            break
        before = state
        share = F.element_at(F.create_map(*[F.lit(x) for s in shares.items() for x in s]),
                             F.col("label") * shards + F.col("want"))
        # every second round only half moves, or neighbours could swap places for ever
        moved = F.when(F.col("want").isNotNull() & (_hash_share("uid", F.lit(k)) < share * (0.5 if k % 2 else 1.0)),
                       F.col("want"))
        state = small(wish.select("uid", "size", "holds", F.coalesce(moved, F.col("label")).alias("label")),
                      f"shard-round-{k}")
        drop_written(wish)
        if before is not best and stale:
            drop_written(before)
    drop_written(both, degree, followers)
    return best.select("uid", "size", "label")


def _level(rest: DataFrame, load: list[float], capacity: float) -> DataFrame:
    """(uid, label) for documents free to lie anywhere; ``load`` per shard."""
    spark = rest.sparkSession
    limit = capacity / LARGE
    heap = [(x, s) for s, x in enumerate(load)]
    heapq.heapify(heap)

    def place(items):
        out = []
        for key, size in items:
            x, s = heapq.heappop(heap)
            out.append((key, s))
            heapq.heappush(heap, (x + size, s))
        return out

    # fewer than shards * LARGE documents can be larger than the limit
    large = rest.where(F.col("size") > limit).select("uid", "size").collect()
    one_by_one = place(sorted(((r["uid"], r["size"]) for r in large), key=lambda x: (-x[1], x[0])))
    bin_of = F.pmod(F.xxhash64("uid", F.lit(17)), F.lit(BINS)).cast("int")
    small = rest.where(F.col("size") <= limit).select("uid", bin_of.alias("bin"), "size")
    sums = small.groupBy("bin").agg(F.sum("size").alias("s")).collect()      # at most BINS rows
    by_bin = place(sorted(((r["bin"], r["s"]) for r in sums), key=lambda x: (-x[1], x[0])))
    a = spark.createDataFrame(one_by_one, "uid long, label int")
    b = spark.createDataFrame(by_bin, "bin int, label int")
    return (rest.where(F.col("size") > limit).select("uid").join(F.broadcast(a), "uid").select("uid", "label")
            .unionAll(small.join(F.broadcast(b), "bin").select("uid", "label")))


def with_slots(placed: DataFrame, total_rows: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each ``shard``: rows are numbered
    inside hash blocks, and blocks start after the rows of those before."""
    blocks = max(1, math.ceil(total_rows / SLOT_BLOCK))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(blocks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("shard", "block").orderBy("uid")
    return (placed.withColumn("k", F.row_number().over(inside) - 1).join(starts, ["shard", "block"])
            .withColumn("slot", F.col("first") + F.col("k")).drop("first", "k", "block"))


def balanced_shards(nodes: DataFrame, links: DataFrame, shards: int = 16) -> DataFrame:
    """(uid, label) of every node.  ``nodes``: uid, size; ``links``: src,
    dst."""
    total = nodes.agg(F.sum("size")).first()[0] or 0
    capacity = total / shards
    linked = propagate(nodes, links, shards, capacity)
    sums = dict(linked.groupBy("label").agg(F.sum("size")).collect())
    # what a shard holds beyond its capacity (a hash start may) is let go
    spare = {s: max(0.0, 1 - capacity / n) for s, n in sums.items()}
    leave = F.lit(0.0)
    if spare:
        leave = F.element_at(F.create_map(*[F.lit(x) for s in spare.items() for x in s]), F.col("label"))
    linked = written(linked.withColumn("stays", _hash_share("uid", F.lit(99)) >= leave), "shard-linked")
    stay = linked.where("stays").select("uid", "size", "label")
    load = dict(stay.groupBy("label").agg(F.sum("size")).collect())
    rest = nodes.select("uid", "size").join(stay.select("uid"), "uid", "left_anti")
    rest = written(rest, "shard-rest")
    return stay.select("uid", "label").unionAll(_level(rest, [load.get(s, 0) for s in range(shards)], capacity))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law, shard, slot,
    grown_shard."""
    text = F.col(text_col).cast("binary")
    rows = written(docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("text_key")), "shard-rows")
    placed = balanced_shards(rows.select("uid", "size"), text_links(rows), shards)
    placed = written(rows.join(placed, "uid").select(
        "id", "uid", "size", "text_crc32", F.col("label").cast("int").alias("shard")), "shard-placed")
    return with_slots(placed, placed.count()).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
