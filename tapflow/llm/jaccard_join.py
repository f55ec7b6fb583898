"""N-gram Jaccard join with Bayesian pruning of candidates.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8.  All sets are 32-bit shingle hashes.

1. Every whole text becomes a shingle set and ``HASHES`` MinHash values.  Rows
   with the same set are copies: one representative goes on, with their
   number as its weight.
2. Representatives that agree in all ``ROWS`` values of a band share a
   bucket (at a similarity of 0.8, all ``BANDS`` bands miss with odds of 3 in
   a million).  Of buckets with the same members only the first is kept.
3. A bucket is compared in blocks of at most ``BLOCK`` members: every block
   meets every block of its bucket, each meeting in a group of its own, so no
   bucket need fit in a task and no pairs are written out.  Inside, MinHash
   values are compared ``STEP`` at a time; a pair is dropped as soon as the
   posterior probability (uniform prior, binomial likelihood) that its
   similarity reaches the threshold falls below ``TOLERANCE``.  What is left
   is verified exactly on the sets.  A pair counts in the first band in which
   it agrees, so it counts once.
4. A group returns, per member with links, their number and one edge of a
   spanning forest; connected components of these edges are the classes.

Result: one row per row: its class (the smallest id in it), the number of
other rows it is linked to, and the number of different linked texts.

Defined results: texts below five words are one shingle of all their words;
texts without words (null and empty among them) are linked to equal texts
only; equal rows are copies of each other; null ids lose to any id as the
class id; an empty table gives no rows.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.llm import bloom
from tapflow.llm.common import WordHashes, drop_written, mix64, shingle_hashes, signed, words, written

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-5
BLOCK = 1024
PACK_ROWS = 400
_A = mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64))
_BAND_MIX = mix64(np.arange(2001, 2001 + HASHES, dtype=np.uint64)) | np.uint64(1)


def shingle_set(tokens: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The sorted set of a text's shingles, as 32-bit hashes."""
    return np.unique((shingle_hashes(tokens, width) >> np.uint64(32)).astype(np.uint32))


def minhash(s: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of a non-empty set."""
    x = mix64(s.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.empty(HASHES, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            out[k] = ((x * _A[k] + _B[k]) >> np.uint64(32)).min()
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band is part of the key."""
    with np.errstate(over="ignore"):
        return mix64((sig.astype(np.uint64) * _BAND_MIX).reshape(BANDS, ROWS).sum(1)
                     + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of compared values, the fewest equal ones at which
    P(similarity >= threshold | equal) is still at or above ``tolerance``."""
    out = []
    grid = (np.arange(2000) + 0.5) / 2000
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            like = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - (n * math.log(0.5)))
            if like[grid >= threshold].sum() >= tolerance * like.sum():
                out.append(m)
                break
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        fp1, fp2, sets, sigs, bands = [], [], [], [], []
        for text in b.column("text").to_pylist():
            s = shingle_set(hashes.of(words(text or "")))
            body = s.tobytes() if len(s) else b"\0" + (text or "").encode("utf-8", "surrogatepass")
            d = hashlib.blake2b(body, digest_size=16).digest()
            fp1.append(int.from_bytes(d[:8], "little", signed=True))
            fp2.append(int.from_bytes(d[8:], "little", signed=True))
            sets.append(s.tobytes())
            if len(s):
                sig = minhash(s)
                sigs.append(sig.tobytes())
                bands.append(signed(band_keys(sig)))
            else:
                sigs.append(b"")
                bands.append([])
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("uid"), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())],
            ["id", "uid", "fp1", "fp2", "bands", "sig", "shingles"])


# ------------------------------------------------------------ verification


def candidate_pairs(a: np.ndarray, b: np.ndarray, band: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two signature blocks that first agree in ``band`` and
    survive the Bayesian comparison."""
    least = least_matches()
    eq = np.ones((len(a), len(b)), bool)
    for r in range(band * ROWS, band * ROWS + ROWS):
        eq &= a[:, None, r] == b[None, :, r]
    if same:
        eq &= np.tri(len(a), k=-1, dtype=bool).T
    i, j = np.nonzero(eq)
    for k in range(band):                                  # counted in an earlier band?
        if not len(i):
            return i, j
        w = slice(k * ROWS, k * ROWS + ROWS)
        later = (a[i, w] != b[j, w]).any(1)
        i, j = i[later], j[later]
    m = np.zeros(len(i), np.int32)
    for k in range(HASHES // STEP):
        w = slice(k * STEP, k * STEP + STEP)
        m += (a[i, w] == b[j, w]).sum(1, dtype=np.int32)
        keep = m >= least[k]
        i, j, m = i[keep], j[keep], m[keep]
    return i, j


def linked(na, nb, common, threshold: float = THRESHOLD):
    """common / (na + nb - common) >= threshold, free of rounding."""
    return common * (1 + threshold) >= threshold * (na + nb) - 1e-9


def verify(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (a[i], b[j]) reach the threshold, on the sets."""
    na, nb = np.array([len(x) for x in a])[i], np.array([len(x) for x in b])[j]
    ok = np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb) - 1e-9
    rows, cols = np.unique(i[ok]), np.unique(j[ok])
    if ok.sum() * 8 < len(rows) * len(cols) or len(rows) < 8:
        common = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) if k else 0
                           for x, y, k in zip(i, j, ok)], np.int64)
        return ok & linked(na, nb, common)
    # dense: count common shingles by products of 0/1 matrices, in slices of
    # the vocabulary; a shingle that one block lacks adds nothing
    vocab = np.intersect1d(np.concatenate([a[x] for x in rows]), np.concatenate([b[y] for y in cols]))
    common = np.zeros((len(rows), len(cols)), np.float32)
    for k in range(0, len(vocab), 8192):
        part = vocab[k:k + 8192]
        common += _incidence([a[x] for x in rows], part) @ _incidence([b[y] for y in cols], part).T
    c = common[np.searchsorted(rows, i[ok]), np.searchsorted(cols, j[ok])]
    out = np.zeros(len(i), bool)
    out[ok] = linked(na[ok], nb[ok], c.astype(np.int64))
    return out


def _incidence(sets: list[np.ndarray], vocab: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(vocab)), np.float32)
    for r, s in enumerate(sets):
        s = s[np.searchsorted(s, vocab[0]):np.searchsorted(s, vocab[-1], "right")]
        at = np.searchsorted(vocab, s)
        at = at[vocab[at] == s] if len(at) else at
        out[r, at] = 1
    return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node of each node's tree over the links."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def _compare(group: pa.Table) -> pa.Table:
    """All meetings of one pack: links and spanning edges per member."""
    bucket = group.column("bucket").to_numpy()
    left, right = group.column("left").to_numpy(), group.column("right").to_numpy()
    order = np.lexsort((right, left, bucket))
    key = np.stack([bucket, left, right], 1)[order]
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)])) if len(order) else []
    uid_col, w_col, block_col = (group.column(c).to_numpy() for c in ("uid", "weight", "block"))
    band_col, sig_col, set_col = group.column("band").to_numpy(), group.column("sig"), group.column("shingles")
    out_uid, out_links, out_texts, out_root = [], [], [], []
    for s, e in zip(starts, [*starts[1:], len(order)]):
        rows = order[s:e]
        rows = rows[np.argsort(uid_col[rows], kind="stable")]
        one = left[rows[0]] == right[rows[0]]
        band = int(band_col[rows[0]])
        sig = np.frombuffer(b"".join(sig_col[int(r)].as_py() for r in rows), np.uint32).reshape(-1, HASHES)
        sets = [np.frombuffer(set_col[int(r)].as_py(), np.uint32) for r in rows]
        ia = np.arange(len(rows)) if one else np.flatnonzero(block_col[rows] == left[rows[0]])
        ib = ia if one else np.flatnonzero(block_col[rows] == right[rows[0]])
        links, texts = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        gi, gj = [], []
        for k in range(0, len(ia), 256):
            part = ia[k:k + 256]
            # inside one block a row meets only those after it
            mine = ib[ib > part[0]] if one else ib
            if not len(mine):
                continue
            i, j = candidate_pairs(sig[part], sig[mine], band, False)
            if one:
                up = mine[j] > part[i]
                i, j = i[up], j[up]
            if not len(i):
                continue
            good = verify([sets[x] for x in part], [sets[x] for x in mine], i, j)
            gi.append(part[i[good]])
            gj.append(mine[j[good]])
        if not gi:
            continue
        i, j = np.concatenate(gi), np.concatenate(gj)
        w = w_col[rows]
        np.add.at(links, i, w[j])
        np.add.at(links, j, w[i])
        np.add.at(texts, i, 1)
        np.add.at(texts, j, 1)
        root = _forest(len(rows), i, j)
        some = texts > 0
        out_uid.append(uid_col[rows][some])
        out_links.append(links[some])
        out_texts.append(texts[some])
        out_root.append(uid_col[rows][root[some]])
    cat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_uid, out_links, out_texts, out_root)]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("uid", "links", "texts", "root"), cat)})


# ------------------------------------------------------------------- join


def components(edges: DataFrame) -> DataFrame:
    """(uid, label): the smallest uid of each connected component.  Rounds of
    joins: every node takes the smallest label around it, then the label of
    that label; ends when nothing changes."""
    both = written(edges.select(F.col("uid").alias("a"), F.col("root").alias("b")).where("a <> b")
                   .unionAll(edges.select(F.col("root").alias("a"), F.col("uid").alias("b")).where("a <> b"))
                   .distinct(), "components-edges")
    labels = written(both.groupBy(F.col("a").alias("uid")).agg(F.min("b").alias("m"))
                     .select("uid", F.least("uid", "m").alias("label")), "components-0")
    k = 0
    while True:
        k += 1
        near = (both.join(labels.select(F.col("uid").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("uid")).agg(F.min("label").alias("m")))
        step = labels.join(near, "uid").select("uid", F.col("label").alias("old"), F.least("label", "m").alias("mid"))
        jump = labels.select(F.col("uid").alias("mid"), F.col("label").alias("far"))
        new = written(step.join(jump, "mid").select("uid", "old", F.least("mid", "far").alias("label")),
                      f"components-{k}")
        changed = new.where("old <> label").limit(1).count()
        drop_written(labels)
        labels = new
        if not changed:
            drop_written(both)
            return labels.select("uid", "label")


def _uids(b: pa.RecordBatch) -> np.ndarray:
    return b.column("uid").to_numpy().view(np.uint64)


def jaccard_links(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Links among the representatives.  ``rows``: uid, bands, sig,
    shingles; ``reps``: uid, weight.  Gives uid, links, texts, root."""
    chosen = rows.where(F.size("bands") > 0).join(reps, "uid")
    at = chosen.select("uid", F.posexplode("bands").alias("band", "bucket"))
    # buckets with the same members: the one of the first band counts
    buckets = (at.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("band").alias("band"), F.min("uid").alias("lo"), F.max("uid").alias("hi"),
        F.sum(F.xxhash64("uid").cast("decimal(38,0)")).alias("mark"))
        .where("n > 1")
        .groupBy("n", "lo", "hi", "mark").agg(F.min(F.struct("band", "bucket")).alias("x"))
        .select("x.bucket", "x.band", "n"))
    buckets = written(buckets, "jaccard-buckets")
    members = at.drop("band").join(buckets, "bucket")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.select("bucket", "band", "uid", blocks.alias("blocks"),
                             F.pmod(F.xxhash64("uid", "bucket"), blocks).cast("int").alias("block"))
    meets = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "bucket", "band", "uid", "block", "blocks",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    meets = written(meets, "jaccard-meets")
    # small buckets share a pack, a meeting of a large one has its own
    packs = max(1, math.ceil(meets.where("blocks = 1").count() / PACK_ROWS))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bucket"), F.lit(packs))).otherwise(
        F.xxhash64("bucket", "left", "right"))
    # only rows that meet another are shuffled with their sets
    wanted = meets.select("uid").distinct()
    segments = bloom.segments_for(wanted.count())
    bits = bloom.build(wanted, _uids, segments)

    def may_meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(bloom.may_hold(_uids(b), bits.value, segments)))

    payload = rows.select("uid", "sig", "shingles").mapInArrow(may_meet, "uid long, sig binary, shingles binary")
    full = (meets.withColumn("pack", pack).join(payload, "uid").join(reps, "uid")
            .select("pack", "bucket", "band", "left", "right", "block", "uid", "weight", "sig", "shingles"))
    return full.groupBy("pack").applyInArrow(_compare, "uid long, links long, texts long, root long")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, n_text_links,
    copies, and ``first`` (one row of each class)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = written(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"),
                               F.col(text_col).alias("text"))
                   .mapInArrow(_signatures, f"id {id_type}, uid long, fp1 long, fp2 long, bands array<long>, "
                                            "sig binary, shingles binary"), "jaccard-rows")
    ids = F.struct(F.col("id").isNull().alias("none"), "id", "uid")
    groups = written(rows.groupBy("fp1", "fp2").agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("weight"),
                                                    F.min(ids).alias("lead")), "jaccard-groups")
    found = written(jaccard_links(rows, groups.select("uid", "weight")), "jaccard-links")
    links = found.groupBy("uid").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    classes = components(found.select("uid", "root"))
    known = groups.join(links, "uid", "left").join(classes, "uid", "left").select(
        "fp1", "fp2", "weight", "lead", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("label", "uid").alias("label"))
    known = written(known, "jaccard-known")
    leads = written(known.groupBy("label").agg(F.min("lead").alias("lead")), "jaccard-leads")
    known = written(known.drop("lead").join(leads, "label"), "jaccard-classes")
    # a hot group's rows meet one row here, and both sides are scans: the
    # partition can be split at run time
    return rows.select("id", "uid", "fp1", "fp2").join(known, ["fp1", "fp2"]).select(
        F.col("id").alias(id_col), F.col("lead.id").alias("class_id"),
        (F.col("links") + F.col("weight") - 1).alias("n_links"), F.col("texts").alias("n_text_links"),
        F.col("weight").alias("copies"), (F.col("uid") == F.col("lead.uid")).alias("first"), F.col("uid").alias("row"))
