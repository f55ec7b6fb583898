"""Prefix trie of conversations from sorted neighbours.

A conversation is a key: the digests of its turns, one after the other, at a
fixed width.  Keys are sorted by range over the whole table; the longest common
prefix (LCP) of two neighbours, in turns, is an edge.  Inside a partition edges
are taken in descending depth: union-find joins the components on both sides,
and the merge at depth d makes (or widens) the branching node of depth d.
Turns between two branching nodes are nodes with the members of the lower one.

A partition is read in blocks.  After each block the finished nodes leave, and
the forest is contracted to what may still grow: the nodes on the way to its
first and to its last key, each with the sums of what hangs below.  Those rows
start the next block, and the partition ends with one contracted forest.  The
contracted forests of 16 neighbouring partitions are merged by the same
function, then 16 of those, until one is left.  A finished child of a node
that is still open looks up its parent's smallest member at the end; these
look-ups are salted, as the root or a common opening has children everywhere.
The ids that end at a key lie one after the other in the sorted rows; each
partition joins runs of up to 10,000 of them to one text, so the digest of a
conversation with very many copies is made from few rows.

Memory: a task holds one block (20,000 conversations or 500,000 turns, and at
least one conversation) plus two paths; a conversation is one row of 40 bytes a
turn, its texts stay behind as digests.  A conversation that a third of all
rows copy lies in many partitions, as ids break ties of the sort.  The digest
of the ids that end at a node is one SHA-256 over all of them in order, which
cannot be split: its task streams the joined texts, holding one batch.

Defined results: turns of one number lie by the digest of role and text; turns
that are equal in all columns are turns of their own; null role or text is
empty; rows without a conv_id belong to no conversation; a conversation
rebuilt without turns is a member of the root alone and ends there; texts are
read whole however long; an empty table gives no rows, not even a root; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import written

WIDTH = 32                    # characters of a turn's digest
BLOCK_ROWS, BLOCK_TURNS = 20_000, 500_000
FAN = 16                      # forests merged by one call
SALTS = 16
IDS = 10_000                  # ids of one key joined to a text
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

SCHEMA = ("piece int, is_node boolean, node_key string, has_ends boolean, was_open boolean, depth long, conv_id long, "
          "parent_conv_id long, parent_key string, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "key string, sizes array<long>, first boolean, last boolean, ids string")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


@dataclass
class Hanging:
    """A key and what hangs at its end: a conversation, or in a contracted
    forest the finished subtrees below that node."""
    key: str
    sizes: list
    n: int                    # conversations
    low: int | None           # the smallest of them
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: bool = True         # does a conversation end here?
    was_open: bool = False
    first: bool = False
    last: bool = False


def common_turns(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b)) // WIDTH
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo * WIDTH:mid * WIDTH] == b[lo * WIDTH:mid * WIDTH]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def key_of(prefix: str) -> str:
    return hashlib.sha256(prefix.encode()).hexdigest()


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


class _Node:
    __slots__ = ("depth", "row", "n", "low", "children", "leaves", "saved", "ends", "was_open", "first", "last",
                 "own_first", "own_last", "below", "above", "finished")

    def __init__(self, depth: int, row: Hanging):
        self.depth, self.row, self.below, self.above, self.finished = depth, row, [], None, None
        self.n, self.low, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends = self.was_open = self.first = self.last = self.own_first = self.own_last = False

    def raised(self, depth: int) -> "_Node":
        """This node, or a new one above it at ``depth``."""
        if self.depth == depth:
            return self
        up = _Node(depth, self.row)
        up.below, up.first, up.last = [self], self.first, self.last
        return up

    def absorb(self, other: "_Node") -> "_Node":
        if len(other.below) > len(self.below):
            self.below, other.below = other.below, self.below
        self.below += other.below
        self.n += other.n
        self.low = _least(self.low, other.low)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        for flag in ("ends", "was_open", "first", "last", "own_first", "own_last"):
            setattr(self, flag, getattr(self, flag) or getattr(other, flag))
        return self


def _trees(rows: list[Hanging]) -> _Node:
    """The root over ``rows`` (sorted): union-find over the edges between
    neighbours in descending depth."""
    top, up = [], list(range(len(rows)))
    for r in rows:
        node = _Node(len(r.key) // WIDTH, r)
        node.n, node.low, node.children, node.leaves, node.saved = r.n, r.low, r.children, r.leaves, r.saved
        node.ends, node.was_open, node.first, node.last = r.ends, r.was_open, r.first, r.last
        node.own_first, node.own_last = r.first, r.last
        top.append(node)

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    depth = [common_turns(a.key, b.key) for a, b in zip(rows, rows[1:])]
    for k in sorted(range(len(depth)), key=lambda k: -depth[k]):
        a, b = find(k), find(k + 1)
        top[a] = top[a].raised(depth[k]).absorb(top[b].raised(depth[k]))
        up[b] = a
    return top[find(0)].raised(0)


def grow(rows: list[Hanging], final: bool = False) -> tuple[list[dict], list[Hanging]]:
    """Finished nodes of the forest over ``rows``, and the rows it is
    contracted to (none if ``final``)."""
    rows.sort(key=lambda r: r.key)
    nodes = [_trees(rows)]
    for u in nodes:                                  # parents before children
        for c in u.below:
            c.above = u
            nodes.append(c)
    done, kept = [], []
    for u in reversed(nodes):
        is_open = not final and (u.first or u.last)
        tops = [c.finished for c in u.below if c.finished is not None]
        for c, t in zip([c for c in u.below if c.finished is not None], tops):
            u.n += t["n_convs"]
            u.low = _least(u.low, t["conv_id"])
            u.children += 1
            u.leaves += t["n_leaves"]
            u.saved += t["saved_tokens"]
        prefix = u.row.key[:u.depth * WIDTH]
        if is_open:
            # the parent's smallest member is not known yet
            for t in tops:
                t["parent_key"] = key_of(prefix)
            if u.n or u.children or u.own_first or u.own_last:
                kept.append(Hanging(prefix, u.row.sizes[:u.depth], u.n, u.low, u.children, u.leaves, u.saved, u.ends,
                                    True, u.own_first, u.own_last))
            continue
        for t in tops:
            t["parent_conv_id"] = u.low
        record = {"node_key": key_of(prefix) if u.ends or u.was_open else None, "has_ends": u.ends, "was_open": u.was_open,
                  "conv_id": u.low, "n_convs": u.n, "n_children": u.children,
                  "n_leaves": u.leaves if u.children else 1}
        saved, until = u.saved, -1 if u.above is None else u.above.depth
        for d in range(u.depth, until, -1):
            saved += (u.n - 1) * u.row.sizes[d - 1] if d else 0
            record |= {"is_node": True, "depth": d, "saved_tokens": saved}
            if d > until + 1:
                record["parent_conv_id"] = u.low     # a turn above with the same members
            done.append(record)
            if d > until + 1:
                record = {"has_ends": False, "was_open": False, "conv_id": u.low, "n_convs": u.n, "n_children": 1,
                          "n_leaves": record["n_leaves"]}
        u.finished = record
    return done, kept


def _batch(piece: int, done: list[dict], kept: Iterable[Hanging] = ()) -> pa.RecordBatch:
    rows = [{"piece": piece, **r} for r in done]
    rows += [{"piece": piece, "is_node": False, "has_ends": r.ends, "was_open": r.was_open, "conv_id": r.low, "n_convs": r.n,
              "n_children": r.children, "n_leaves": r.leaves, "saved_tokens": r.saved, "key": r.key, "sizes": r.sizes,
              "first": r.first, "last": r.last} for r in kept]
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c.split()[0]) for r in rows], types[c.split()[1]])
                                       for c in SCHEMA.split(", ")], COLUMNS)


def _partition_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece = TaskContext.get().partitionId()
    forest: list[Hanging] = []
    block: list[Hanging] = []
    turns, begun = 0, False
    ending, ended = [], None

    def texts_of_ids():
        """The ids gathered for the key ``ended``."""
        nonlocal ending
        row = {"is_node": False, "node_key": key_of(ended), "conv_id": ending[0], "ids": ",".join(map(str, ending))}
        ending = []
        return row

    def close():
        nonlocal forest, block, turns
        for r in forest:
            r.last = False
        block[-1].last = True
        done, forest = grow(forest + block)
        block, turns = [], 0
        return _batch(piece, done)

    for b in batches:
        texts: list[dict] = []
        for conv, key, sizes in zip(*(b.column(c).to_pylist() for c in ("conv_id", "key", "sizes"))):
            if ending and (key != ended or len(ending) >= IDS):
                texts.append(texts_of_ids())
            ending.append(conv)
            ended = key
            block.append(Hanging(key, sizes, 1, conv, first=not begun))
            begun, turns = True, turns + len(sizes)
            if len(block) >= BLOCK_ROWS or turns >= BLOCK_TURNS:
                yield close()
        yield _batch(piece, texts)
    if ending:
        yield _batch(piece, [texts_of_ids()])
    if block:
        yield close()
    if forest:
        yield _batch(piece, [], forest)


def _merged_forest(final: bool):
    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_pylist() for c in COLUMNS}
        pieces = cols["piece"]
        lo, hi = min(pieces), max(pieces)
        rows = [Hanging(cols["key"][i], cols["sizes"][i], cols["n_convs"][i], cols["conv_id"][i], cols["n_children"][i],
                        cols["n_leaves"][i], cols["saved_tokens"][i], cols["has_ends"][i], cols["was_open"][i],
                        cols["first"][i] and p == lo, cols["last"][i] and p == hi) for i, p in enumerate(pieces)]
        return pa.Table.from_batches([_batch(lo // FAN, *grow(rows, final))])
    return run


def _ids_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per key over its texts of sorted ids, read as a stream."""
    key, state = None, None
    for b in batches:
        keys, shas = [], []
        for k, ids in zip(b.column("node_key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if state is not None:
                    keys.append(key)
                    shas.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(shas, pa.string())], ["end_key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["end_key", "ends_sha256"])


def conversation_turns(rows: DataFrame) -> DataFrame:
    """conv_id and its turns (digest, size) in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).substr(1, WIDTH)
    return (rows.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
                    F.octet_length(text).cast("long").alias("size"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["size"])).alias("turns")))


def rebuilt(convs: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Each conversation behind the first h turns of its family's first one,
    h = crc32(conv_id) mod ``most``: those replace its own first h turns."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    heads = convs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head"))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_head", F.lit(1), h))
    return (convs.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("_base"), "left")
            .select("conv_id", F.concat(head, own).alias("turns")))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """A row per node of the trie over ``convs`` (conv_id, turns as an array of
    digest and size): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    keys = written(convs.select("conv_id", F.array_join(F.col("turns.digest"), "").alias("key"),
                                F.col("turns.size").alias("sizes")), "trie-keys")
    lined = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rounds = [written(lined.mapInArrow(_partition_forest, SCHEMA), "trie-forests")]
    last = rounds[0].agg(F.max("piece")).first()[0]
    while last is not None:
        open_rows = rounds[-1].where("key is not null")
        rounds.append(written(open_rows.groupBy((F.col("piece") / FAN).cast("int").alias("g"))
                              .applyInArrow(_merged_forest(last < FAN), SCHEMA), "trie-merged"))
        if last < FAN:
            break
        last //= FAN
    nodes = reduce(DataFrame.unionAll, rounds).where("is_node")
    # parents of pending children were open when the child was finished
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    parents = nodes.where("was_open").select(F.col("node_key").alias("_key"), F.col("conv_id").alias("_low"), salt.alias("_salt"))
    pending = nodes.where("parent_key is not null").withColumn("_at", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    found = pending.join(parents, (F.col("parent_key") == F.col("_key")) & (F.col("_at") == F.col("_salt"))).withColumn(
        "parent_conv_id", F.col("_low"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "has_ends", "node_key"]
    nodes = nodes.where("parent_key is null").select(*out).unionAll(found.select(*out))
    ends = (rounds[0].where("ids is not null").select("node_key", "conv_id", "ids").repartition("node_key")
            .sortWithinPartitions("node_key", "conv_id").mapInArrow(_ids_digest, "end_key string, ends_sha256 string"))
    ended = nodes.where("has_ends").join(ends, F.col("node_key") == F.col("end_key")).drop("end_key")
    return ended.unionByName(nodes.where("not has_ends").withColumn("ends_sha256", F.lit(EMPTY_SHA))).drop("has_ends", "node_key")


def conversation_trie(rows: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return prefix_trie(rebuilt(written(conversation_turns(rows), "trie-turns")))
