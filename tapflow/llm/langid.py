"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language.  A word that
the training texts lack (or hold once) is scored by its longest known character
n-grams: those of four characters if any is known, else three, two, one.

Words and n-grams are counted natively over all training rows and stay a
written table; nothing is cut from it.  For prediction each *distinct* word of
the documents gets its vector by joins with that table, n-grams only where the
word itself is not in it, so the work of the backoff grows with the vocabulary
and not with the running text.  The vectors of the most frequent words, at most
500,000 of them, are broadcast to the tasks that read the texts; every other
word of a text leaves the task as a row of its own, is joined with its vector
and added to the text's sum.  Such words are rare by construction, so no key of
that join is hot, and any vocabulary is scored in full.

Defined results: null text, or text without a letter, is ``und`` with score
0; a text with letters but no evidence gets the most frequent language; ties
go to the first language by code point; without training rows all is
``und``; very long texts are read whole; repeated rows are scored each; a
``held_out`` column that is not boolean, like any other extra column, is not
read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import written

ORDERS = (4, 3, 2, 1)
MIN_COUNT = 2
#: Words whose vectors are broadcast (some 30 MB), the most frequent ones.
BROADCAST_WORDS = 500_000
#: Steps per doubling of a count at which that set may be cut.
LEVELS = 16
#: Words whose evidence the score counts in full; longer texts are as sure.
EVIDENCE_WORDS = 20
_LETTERS = re.compile(r"[^\W\d_]+")
_LETTERS_JVM = r"[\p{L}\p{Nl}\p{No}]+"          # the same characters


def letter_words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_LETTERS_JVM), F.lit(0))


def _gram_keys(word: Column, n: int) -> Column:
    """Array of the word's n-grams, each behind the digit n."""
    padded = F.concat(F.lit(" "), word, F.lit(" ")) if n > 1 else word
    last = F.length(padded) - n + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.concat(
        F.lit(str(n)), F.substring(padded, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


@dataclass
class LanguageModel:
    """``vectors``: key ("w" + word, or order + n-gram) and one log frequency
    per language, a written table of any size."""
    languages: list[str] = field(default_factory=list)
    vectors: DataFrame | None = None
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def columns(self) -> list[str]:
        return [f"l{k}" for k in range(len(self.languages))]

    # a small model as local arrays, to look into it
    @cached_property
    def _local(self) -> tuple[dict[str, int], np.ndarray]:
        rows = self.vectors.orderBy("key").collect()
        return {r["key"]: k for k, r in enumerate(rows)}, np.array([r[1:] for r in rows])

    @property
    def rows(self) -> dict[str, int]:
        return self._local[0]

    @property
    def table(self) -> np.ndarray:
        return self._local[1]

    def word_vector(self, word: str) -> np.ndarray:
        if "w" + word in self.rows:
            return self.table[self.rows["w" + word]]
        for n in ORDERS:
            known = [self.rows[f"{n}{g}"] for g in grams(word, n) if f"{n}{g}" in self.rows]
            if known:
                return self.table[known].mean(0)
        return np.zeros(len(self.languages))


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row of ``docs`` with a language."""
    rows = (docs.where(F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.explode(_words(F.col(text_col))).alias("word")))
    per = written(rows.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "langid-words")
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang")).distinct()
    languages = sorted((r["lang"] for r in known.collect()), key=lambda x: [ord(c) for c in x])
    if not languages:
        return LanguageModel()
    keys = F.concat(F.array(F.concat(F.lit("w"), F.col("word"))), *[_gram_keys(F.col("word"), n) for n in ORDERS])
    counts = per.select("lang", "n", F.explode(keys).alias("key")).groupBy("key").agg(
        *[F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(0)).alias(f"l{k}") for k, name in enumerate(languages)])
    columns = [f"l{k}" for k in range(len(languages))]
    counts = written(counts.where(sum((F.col(c) for c in columns[1:]), F.col(columns[0])) >= MIN_COUNT), "langid-counts")
    kind = F.substring("key", 1, 1)
    totals = counts.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("size"), *[F.sum(c).alias(c) for c in columns]).collect()

    def log_share(c):
        # smoothed by half a count per key of the kind; five kinds
        whole = F.create_map(*[F.lit(x) for r in totals for x in (r["kind"], float(r[c] + 0.5 * r["size"]))])
        return F.log((F.col(c) + 0.5) / whole[kind]).cast("float").alias(c)

    vectors = counts.select("key", *[log_share(c) for c in columns]) if totals else counts.select(
        "key", *[F.col(c).cast("float").alias(c) for c in columns])
    prior = dict(per.groupBy("lang").agg(F.sum("n")).collect())
    return LanguageModel(languages, written(vectors, "langid-vectors"),
                         np.array([math.log1p(prior.get(x, 0)) for x in languages]))


def word_vectors(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """(word, n, l..) for every distinct word of ``docs`` with evidence, and
    how often it stands there."""
    words = written(docs.select(F.explode(_words(F.col(text_col))).alias("word")).groupBy("word")
                    .agg(F.count(F.lit(1)).alias("n")), "langid-distinct")
    found = words.join(model.vectors, F.concat(F.lit("w"), F.col("word")) == F.col("key"), "left")
    known = found.where("key is not null").select("word", "n", *model.columns)
    other = written(found.where("key is null").select("word", "n"), "langid-unseen")
    left, found = other, [known]
    for n in ORDERS:
        # the longest known n-grams decide: shorter ones are looked up only for
        # words that have none of these
        table = model.vectors.where(F.col("key").startswith(str(n)))
        if table.count() <= BROADCAST_WORDS:
            table = F.broadcast(table)
        grams_of = left.select("word", "n", F.explode(_gram_keys(F.col("word"), n)).alias("gram"))
        means = written(grams_of.join(table, F.col("gram") == F.col("key")).groupBy("word")
                        .agg(F.max("n").alias("n"), *[F.avg(c).cast("float").alias(c) for c in model.columns]),
                        f"langid-backoff-{n}")
        found.append(means)
        if n > ORDERS[-1]:
            left = written(left.join(means.select("word"), "word", "left_anti"), f"langid-without-{n}")
    return reduce(DataFrame.unionByName, found)


def _frequent(vectors: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent words, no more than ``most``, and the others (None if
    there are none), cut at a count by a histogram."""
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    left = most
    for r in sorted(vectors.groupBy(level.alias("v")).count().collect(), key=lambda r: -r["v"]):
        if r["count"] > left:
            return vectors.where(level > r["v"]), vectors.where(level <= r["v"])
        left -= r["count"]
    return vectors, None


_HELD: dict = {}


def _held_words(held) -> tuple[dict[str, int], np.ndarray]:
    """The broadcast vectors, built once per Python worker."""
    if held.id not in _HELD:
        _HELD.clear()
        t = pa.ipc.open_stream(held.value).read_all()
        words = t.column("word").to_pylist()
        _HELD[held.id] = (dict(zip(words, range(len(words)))),
                          np.stack([c.to_numpy() for c in t.columns[1:]], 1).astype(np.float32))
    return _HELD[held.id]


class _Held:
    def __init__(self, broadcast, name: str):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def _to_stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
                      broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """id, held_out, lang_pred and score of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    given = "held_out" in docs.columns and docs.schema["held_out"].dataType.simpleString() == "boolean"
    held_out = F.col("held_out") if given else F.lit(False).alias("held_out")
    rows = docs.select(F.col(id_col).alias("id"), held_out, F.col(text_col).alias("text"))
    if not model.languages:
        return rows.select(F.col("id").alias(id_col), "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    vectors = written(word_vectors(rows, model), "langid-distinct-vectors")
    frequent, rare = _frequent(vectors, broadcast_words)
    stream = _to_stream(frequent.select("word", *model.columns).toArrow())      # at most ``broadcast_words`` rows
    held = _Held(docs.sparkSession.sparkContext.broadcast(stream), f"{id(stream)}-{len(stream)}-{hash(stream)}")
    some_rare, width = rare is not None, len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, matrix = _held_words(held)
        for b in batches:
            totals, counts, letters, tails = [], [], [], []
            for text in b.column("text").to_pylist():
                tokens = letter_words(text or "")
                found = [k for k in map(at.get, tokens) if k is not None]
                total = np.zeros(width)
                for i in range(0, len(found), 1 << 16):
                    total += matrix[found[i:i + (1 << 16)]].sum(0, dtype=np.float64)
                totals.append(total)
                counts.append(len(tokens))
                letters.append(any(c.isalpha() for t in tokens for c in t))
                tails.append([t for t in tokens if t not in at] if some_rare and len(found) < len(tokens) else [])
            flat = pa.array(np.concatenate(totals) if totals else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("held_out"), pa.ListArray.from_arrays(
                    pa.array(np.arange(0, width * (len(totals) + 1), width), pa.int32()), flat),
                 pa.array(counts, pa.int64()), pa.array(letters, pa.bool_()), pa.array(tails, pa.list_(pa.string()))],
                ["id", "held_out", "total", "words", "letters", "tail"])

    sums = rows.mapInArrow(run, f"id {id_type}, held_out boolean, total array<double>, words long, letters boolean, "
                                "tail array<string>")
    total = [F.col("total")[k] for k in range(width)]
    if some_rare:
        sums = written(sums.withColumn("row", F.monotonically_increasing_id()), "langid-sums")
        more = (sums.select("row", F.explode("tail").alias("word")).join(rare.select("word", *model.columns), "word")
                .groupBy("row").agg(*[F.sum(c).alias(c) for c in model.columns]))
        sums = sums.join(more, "row", "left")
        total = [t + F.coalesce(F.col(c), F.lit(0.0)) for t, c in zip(total, model.columns)]
    scale = F.least(F.col("words"), F.lit(EVIDENCE_WORDS)) / F.greatest(F.col("words"), F.lit(1))
    sums = sums.select("id", "held_out", "letters", F.array(*[t * scale for t in total]).alias("z"))
    best, names = F.array_max("z"), F.array(*[F.lit(x) for x in model.languages])
    blank, even = ~F.col("letters"), F.array_min("z") == best
    share = 1.0 / F.aggregate("z", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
    return sums.select(
        F.col("id").alias(id_col), "held_out",
        F.when(blank, F.lit("und")).when(even, F.lit(model.languages[int(model.prior.argmax())]))
        .otherwise(names[(F.array_position("z", best) - 1).cast("int")]).alias("lang_pred"),
        F.when(blank, F.lit(0.0)).when(even, F.lit(1.0 / width)).otherwise(share).alias("score"))
