"""Merkle dataset manifest: a content-addressed DAG and descent in it.

Every row is a leaf; a source's leaves, by id, are hashed in runs of 16 until
one node (the subroot) is left, and the subroots, by source, likewise give the
root.  ``build_manifest`` writes the records ``digest -> children``, equal
digests once.  ``prove`` lets leaf requests descend from the root: requests
that still share a node travel as one row, each step fetches the node's record
by its digest, picks the child named by the next base-16 digit of the rank and
collects the children that were not picked.  The segments, reversed, are the
proof from the leaf up; ``fold`` hashes a leaf through them.

Cost: ranks need one sort of 100-byte rows; every tree level and every descent
step shuffles a sixteenth of the one before, so all steps together are about
one shuffle of the ids and digests.  A path of all its segments exists once for
each run of 16 leaves.  Texts are hashed where they are read and never
shuffled.  A source with a third of all rows is ranked over many partitions,
and its nodes are joined by (source, position).

Defined results: null fields hash as ``-``, so null and empty texts differ;
null ids come first in a source, a null id is never tampered with; rows equal
in id lie by their leaf, and wholly equal rows are leaves of their own; very
long texts are hashed whole; an empty table has no root and gives no rows;
extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import drop_written, written
from tapflow.llm.ranking import ranked

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5
PATH = "array<struct<left: string, right: string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each ``-`` or its UTF-8 byte count, ``:`` and value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")),
                        F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf and the leaf after tampering (equal without)."""
    plain = [F.col(f"`{c}`") for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    lowered = plain[:-1] + [F.translate(plain[-1], UPPER, LOWER)]
    leaf = leaf_digest(plain)
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf.alias("leaf"),
                       F.when(hit, leaf_digest(lowered)).otherwise(leaf).alias("found"))


@dataclass
class Manifest:
    """``leaves``: the given rows with ``tree`` (rank of the source), ``height``
    and ``pos``; ``tops``: pos of a source among the subroots and its tree's
    height; ``records``: (part, height, digest, children), written."""
    leaves: DataFrame
    tops: DataFrame
    records: DataFrame
    root: str | None
    top_height: int
    heights: int


def _height(n: Column) -> Column:
    """Levels of runs above ``n`` nodes: the base-16 digits of n - 1."""
    return F.when(n == 1, 0).otherwise(F.length(F.hex(n - 1))).cast("int")


def _levels(nodes: DataFrame, heights: int, name: str) -> list[DataFrame]:
    """Tables (tree, height, pos, digest, children) of the levels 1, 2, ...
    above ``nodes``; a tree stops at its own height.  A run has 16 children."""
    out, below = [], nodes
    for level in range(1, heights + 1):
        runs = (below.where(F.col("height") >= level)
                .groupBy("tree", "height", F.shiftright("pos", 4).alias("pos"))
                .agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run")))
        below = runs.select("tree", "height", "pos", F.col("run.digest").alias("children"))
        below = written(below.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), f"merkle-{name}-{level}")
        out.append(below)
    return out


def _records(levels: list[DataFrame], part: str) -> list[DataFrame]:
    return [t.select(F.lit(part).alias("part"), F.lit(k).alias("level"), "digest", "children")
            for k, t in enumerate(levels, 1)]


def build_manifest(leaves: DataFrame, source_col: str = "source", order: tuple[str, ...] = ("doc_id", "leaf"),
                   leaf_col: str = "leaf") -> Manifest:
    """Ranks the leaves, hashes the levels and writes the records."""
    rows = written(leaves, "merkle-leaves")
    placed = ranked(rows, source_col, list(order))
    drop_written(rows)
    placed = placed.withColumnsRenamed({"group_rank": "tree", "rank": "pos"}).withColumn(
        "height", _height(F.col("group_size"))).drop("group_size")
    size = placed.agg(F.max("height"), F.max("tree")).first()
    if size[0] is None:
        return Manifest(placed, placed.limit(0), placed.limit(0), None, 0, 0)
    heights, sources = size[0], size[1] + 1
    nodes = placed.select("tree", "height", "pos", F.col(leaf_col).alias("digest"))
    levels = _levels(nodes, heights, "source")
    subroots = [t.where(F.col("height") == k).select("tree", "height", "digest") for k, t in enumerate([nodes, *levels])]
    tops = written(reduce(DataFrame.unionAll, subroots), "merkle-subroots")
    top_height = 0 if sources == 1 else len(f"{sources - 1:x}")
    top_nodes = tops.select(F.lit(0).cast("long").alias("tree"), F.lit(top_height).alias("height"),
                            F.col("tree").alias("pos"), "digest")
    top_levels = _levels(top_nodes, top_height, "top")
    root = (top_levels[-1] if top_levels else top_nodes).first()["digest"]
    records = _records(levels, "source") + _records(top_levels, "top")
    if not records:
        store = tops.limit(0).select(F.lit("").alias("part"), F.lit(0).alias("level"), "digest",
                                     F.array().cast("array<string>").alias("children"))
    else:
        store = written(reduce(DataFrame.unionAll, records).groupBy("part", "level", "digest")
                        .agg(F.first("children").alias("children")), "merkle-records")
        drop_written(*levels, *top_levels)
    return Manifest(placed, tops.select("tree", "height"), store, root, top_height, heights)


def _descend(front: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One step: the record of each node, then the wanted children.  ``front``:
    tree, pos, digest, path, more; ``wanted``: tree, pos, more."""
    kept = [c for c in front.columns if c not in ("tree", "pos", "digest", "path")]
    own = [c for c in wanted.columns if c not in ("tree", "pos")]
    opened = front.join(records, "digest").withColumnsRenamed({"tree": "_tree", "pos": "_above"})
    down = wanted.join(opened, (F.col("tree") == F.col("_tree")) & (F.shiftright("pos", 4) == F.col("_above")))
    digit = (F.col("pos") % RUN).cast("int")
    segment = F.struct(F.array_join(F.slice("children", F.lit(1), digit), "").alias("left"),
                       F.array_join(F.slice("children", digit + 2, F.lit(RUN)), "").alias("right"))
    return down.select("tree", "pos", *own, *kept, F.get("children", digit).alias("digest"),
                       F.concat("path", F.array(segment)).alias("path"))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, pos, height and any other columns) plus ``subroot``
    and ``path``: the siblings as (left, right) texts, from the leaf up."""
    if manifest.root is None:
        return requests.withColumns({"subroot": F.lit(None).cast("string"), "path": F.array().cast(PATH)}).limit(0)

    def record(part, level):
        return manifest.records.where((F.col("part") == part) & (F.col("level") == level)).select("digest", "children")

    # the nodes on the way of any request, level by level
    nodes = [requests.select("tree", "height", "pos")]
    for level in range(1, manifest.heights + 1):
        above = nodes[-1].where(F.col("height") >= level).select(
            "tree", "height", F.shiftright("pos", 4).alias("pos")).distinct()
        nodes.append(written(above, f"merkle-way-{level}"))
    trees = requests.select("tree", "height").distinct()
    spark = requests.sparkSession
    front = spark.createDataFrame([(0, 0, manifest.root)], "tree long, pos long, digest string").withColumn(
        "path", F.array().cast(PATH))
    wanted = trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "height")
    for level in range(manifest.top_height, 0, -1):
        here = wanted if level == 1 else wanted.select("tree", F.shiftright("pos", 4 * (level - 1)).alias("pos")).distinct()
        front = _descend(front, record("top", level), here)
    if manifest.top_height == 0:
        front = front.join(wanted.select("tree", "height"), "tree")
    starts = written(front.select(F.col("pos").alias("tree"), "height", "digest", "path"), "merkle-starts")
    starts = starts.withColumns({"pos": F.lit(0).cast("long"), "subroot": F.col("digest")})
    front, found = None, []
    for level in range(manifest.heights, -1, -1):
        mine = starts.where(F.col("height") == level).drop("height")
        front = mine if front is None else front.unionByName(mine)
        if level == 0:
            break
        below = requests if level == 1 else nodes[level - 1].drop("height")
        if level == 1:
            found.append(_descend(front, record("source", 1), below.where(F.col("height") >= 1)))
            front = None
        else:
            front = _descend(front, record("source", level), below)
    alone = starts.where(F.col("height") == 0).select("tree", "subroot", "digest", "path")
    found.append(requests.where(F.col("height") == 0).join(alone, "tree"))
    out = reduce(lambda a, b: a.unionByName(b), found)
    return out.withColumn("path", F.reverse("path")).drop("digest")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verify_documents(docs: DataFrame) -> DataFrame:
    """Every row's proof, recomputed from what the row holds after tampering."""
    manifest = build_manifest(leaves_of(docs))
    proved = prove(manifest, manifest.leaves.select("tree", "pos", "height", "doc_id", "leaf", "found"))
    root = F.lit(manifest.root).cast("string")
    out = proved.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                        fold(F.col("found"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
