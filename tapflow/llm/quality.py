"""Quality classifier on supervised subword embeddings.

Every token (run of non-space characters, lower-cased) gives hashed features:
the word, its character n-grams, and a mark when it repeats the token before
it.  Each feature bucket has a learned vector; a document is the average of
its features' vectors, and a softmax layer on the average gives the class
probabilities.  Vectors and layer are learned together by stochastic gradient
descent in numpy, from a bounded, class-balanced sample of labelled rows
(``MAX_TRAINING_ROWS``, lowest id hashes); the learned odds are then shifted
to the labels' true shares.

The softmax layer is linear in the average, so after training each bucket
folds into one number per class difference, and a token's features into one
pair (sum, count) that a worker remembers.  Scoring reads whole texts.

Defined results: null and empty texts have no feature and get the score of
the bias; with only one label in the training rows every score is that
label, with none 0.5; equal rows get equal scores; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
DIMENSIONS = 8
MAX_TRAINING_ROWS = 4_000
EPOCHS = 5
RATE = 0.5
GRAMS = (3, 4)
_REPEAT = zlib.crc32(b"\0repeat") % BUCKETS


def token_buckets(token: str) -> list[int]:
    """The word's bucket and those of its character n-grams."""
    out = [zlib.crc32(b"w" + token.encode("utf-8", "surrogatepass")) % BUCKETS]
    padded = f"<{token}>"
    for n in GRAMS:
        out += [zlib.crc32(padded[i:i + n].encode("utf-8", "surrogatepass")) % BUCKETS
                for i in range(len(padded) - n + 1)]
    return out


def _repeats(tokens: list[str]) -> int:
    return sum(a == b for a, b in zip(tokens, tokens[1:]))


class _TokenBuckets(dict):
    LIMIT = 100_000

    def __missing__(self, token: str) -> list[int]:
        if len(self) > self.LIMIT:
            self.clear()
        b = self[token] = token_buckets(token)
        return b


def document_features(text: str, buckets: _TokenBuckets) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares of its features."""
    tokens = text.lower().split()
    count: Counter = Counter()
    for token, n in Counter(tokens).items():
        for b in buckets[token]:
            count[b] += n
    if r := _repeats(tokens):
        count[_REPEAT] += 4 * r           # as many as a short word's n-grams
    if not count:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32)
    at = np.fromiter(count.keys(), np.uint16, len(count))
    share = np.fromiter(count.values(), np.float32, len(count))
    return at, share / share.sum()


@dataclass
class QualityModel:
    #: Per bucket, the vector's part in the log odds of class 1 over class 0.
    fold: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = 0.0


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> QualityModel:
    """Vectors and softmax layer by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            at, share = features[i]
            lr = rate * (1 - done / steps)
            done += 1
            if not len(at):
                continue
            hidden = share @ vectors[at]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1.0                      # gradient of the loss
            back = layer @ p
            layer -= lr * np.outer(hidden, p)
            bias -= lr * p
            # fastText's rule: the whole step goes to each feature by share
            vectors[at] -= (lr * len(at) ** 0.5) * share[:, None] * back[None, :]
    return QualityModel(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> QualityModel:
    """Learn from ``labels`` (id, 0/1); the caller leaves out held-out rows."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    n = dict(known.groupBy("label").count().collect())
    if not (n.get(0) and n.get(1)):
        return QualityModel(bias=0.0 if not n else 20.0 if n.get(1) else -20.0)
    order = (F.xxhash64("id"), F.col("id"))
    chosen = known.where("label = 0").orderBy(*order).limit(max_rows // 2).unionAll(
        known.where("label = 1").orderBy(*order).limit(max_rows // 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _TokenBuckets()
        for b in batches:
            rows = [document_features(t or "", buckets) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([r[0].tobytes() for r in rows], pa.binary()),
                 pa.array([r[1].tobytes() for r in rows], pa.binary())], ["id", "label", "at", "share"])

    # at most max_rows narrow rows are broadcast, and as many feature rows of
    # at most BUCKETS entries come back
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "label", "text")
            .mapInArrow(run, f"id {id_type}, label int, at binary, share binary")).toArrow()
    at = [np.frombuffer(v, np.uint16) for v in rows.column("at").to_pylist()]
    share = [np.frombuffer(v, np.float32) for v in rows.column("share").to_pylist()]
    y = rows.column("label").to_numpy()
    by_id = sorted(range(len(y)), key=lambda i: (rows.column("id")[i].as_py(), at[i].tobytes()))
    if len(set(y.tolist())) < 2:
        return QualityModel(bias=math.log((n[1] + 1) / (n[0] + 1)))
    model = train([(at[i], share[i]) for i in by_id], y[by_id])
    model.bias += math.log(n[1] / n[0]) - math.log(max(1, (y == 1).sum()) / max(1, (y == 0).sum()))
    return model


class _Folded(dict):
    """token -> row of (sum of folded features, number of features)."""

    LIMIT = 400_000

    def __init__(self, model: QualityModel):
        self.fold = model.fold.astype(np.float64)
        self.pairs = np.zeros((1024, 2))

    def __missing__(self, token: str) -> int:
        at = len(self)
        if at == len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        buckets = token_buckets(token)
        self.pairs[at] = self.fold[buckets].sum(), len(buckets)
        self[token] = at
        return at

    def average(self, text: str) -> float:
        if len(self) > self.LIMIT:
            self.clear()
        tokens = text.lower().split()
        if not tokens:
            return 0.0
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        total, n = self.pairs[at].sum(0)
        r = 4 * _repeats(tokens)
        return (total + r * self.fold[_REPEAT]) / (n + r)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id and score of every row; ``held_out`` is kept when present."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = _Folded(held.value), held.value.bias
        for b in batches:
            z = np.array([folded.average(t or "") + bias for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())],
                ["id", "held_out", "score"])

    held_out = F.col("held_out") if "held_out" in docs.columns else F.lit(False).alias("held_out")
    return (docs.select(F.col(id_col).alias("id"), held_out, F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, score double")
            .withColumnRenamed("id", id_col))
