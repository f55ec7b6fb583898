"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a string of symbols.  The lexical transducer rewrites
words to insult, threat, target, negation and reported-speech symbols; the
scope transducers then run over the symbols and mark every insult or threat
that stands in an open scope.  They compose into one machine whose outputs
are *matches* - an insult or threat with its marks - and a clause is scored
by its matches, never by isolated words: a threat without a target scores
nothing, a negated or reported insult scores by its own arc weight.

What is learned, from labelled rows only: the insult lexicon (words and word
beginnings whose documents are mostly labelled toxic) and the arc weights (a
logistic fit that starts at the grammar's own weights and is held near them).
The fit uses a bounded sample of labelled rows (``MAX_TRAINING_ROWS``, lowest
id hashes); scoring reads every whole text.  Near copies count once in the
lexicon, so a text copied many times does not turn its words into insults.

Defined results: null and empty texts have no match and get the base score;
without both labels in the training rows the lexicon is empty and the
grammar's own weights hold; equal rows get equal scores; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.llm.common import WordHashes, shingle_hashes, words, written

MAX_TRAINING_ROWS = 20_000
PREFIX_LENGTHS = (4, 5, 6)
MIN_SUPPORT, MIN_SHARE, MIN_PURITY = 3, 0.01, 0.9

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "INSULT", "THREAT", "TARGET", "NEGATION", "REPORT", "OTHER"

GRAMMAR_WORDS = {
    TARGET: "you your yours he she they them him her du dich dir ihr euch sie tu toi vous vos "
            "usted ustedes vosotros ella ellos".split(),
    NEGATION: "not never no nor without isnt dont doesnt wont nicht kein keine nie ne pas jamais "
              "aucun nunca sin tampoco".split(),
    REPORT: "said says wrote writes called calls quoted quote claimed according reported sagte "
            "schrieb nannte laut dit écrit selon dijo escribió según".split(),
    THREAT: "kill murder hurt destroy shoot stab burn töten umbringen tuer frapper matar golpear".split(),
}
_CLAUSE = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Scope:
    """A transducer that opens on ``symbol`` and marks insults and threats
    for the next ``width`` words (None: to the end of the clause)."""
    symbol: str
    mark: str
    width: int | None

    def step(self, left: int, symbol: str) -> tuple[int, str]:
        if symbol == self.symbol:
            return (1 << 30) if self.width is None else self.width, ""
        mark = self.mark if left > 0 and symbol in (INSULT, THREAT) else ""
        return max(0, left - 1), mark


NEGATED = Scope(NEGATION, "n", 3)
REPORTED = Scope(REPORT, "r", None)
TARGETED = Scope(TARGET, "t", 5)


def compose(*scopes: Scope):
    """One machine over the product of the scopes' states: yields the index
    and the joined marks of every insult or threat."""
    def run(symbols: list[str]) -> Iterator[tuple[int, str]]:
        state = [0] * len(scopes)
        for i, symbol in enumerate(symbols):
            marks = ""
            for k, scope in enumerate(scopes):
                state[k], mark = scope.step(state[k], symbol)
                marks += mark
            if symbol in (INSULT, THREAT):
                yield i, marks
    return run


_FORWARD = compose(NEGATED, REPORTED, TARGETED)
_BACKWARD = compose(TARGETED)               # "... idiot, all of you"

#: Arc classes of a match and the grammar's own weight of each.
ARCS = {"insult": 1.0, "insult_target": 1.2, "insult_negated": 0.4, "insult_reported": 0.4,
        "threat_target": 1.0, "threat_hedged": 0.2}
BASE, SLOPE = -3.0, 1.0


@dataclass
class Lexicon:
    """Word classes; ``stems`` are learned words and word beginnings."""
    exact: dict[str, float] = field(default_factory=dict)
    prefix: dict[str, float] = field(default_factory=dict)

    def symbol(self, word: str) -> tuple[str, float]:
        weight = max([self.exact.get(word, 0.0),
                      *(self.prefix.get(word[:n], 0.0) for n in PREFIX_LENGTHS if len(word) >= n)])
        if weight > 0:
            return INSULT, weight
        for symbol, members in _SYMBOLS.items():
            if word in members:
                return symbol, 1.0
        return OTHER, 0.0


_SYMBOLS = {k: frozenset(v) for k, v in GRAMMAR_WORDS.items()}


class Symbols(dict):
    """word -> (symbol, weight), remembered."""

    LIMIT = 100_000

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) > self.LIMIT:
            self.clear()
        s = self[word] = self.lexicon.symbol(word)
        return s


def matches(text: str, symbols: Symbols) -> list[tuple[str, float]]:
    """(arc, lexical weight) of every match in the text."""
    whole = words(text)
    if not any(symbols[w][1] and symbols[w][0] in (INSULT, THREAT) for w in set(whole)):
        return []
    found = []
    for clause in _CLAUSE.split(text):
        read = [symbols[w] for w in words(clause)]
        tape = [s for s, _ in read]
        after = {len(tape) - 1 - i for i, m in _BACKWARD(tape[::-1]) if "t" in m}
        for i, marks in _FORWARD(tape):
            target = "t" in marks or i in after
            hedged = "n" in marks or "r" in marks
            if tape[i] == THREAT:
                if not target:
                    continue
                arc = "threat_hedged" if hedged else "threat_target"
            else:
                arc = ("insult_negated" if "n" in marks else "insult_reported" if "r" in marks
                       else "insult_target" if target else "insult")
            found.append((arc, read[i][1]))
    return found


def evidence(text: str, symbols: Symbols) -> list[float]:
    """Per arc, the damped sum of its matches' weights."""
    total = dict.fromkeys(ARCS, 0.0)
    for arc, weight in matches(text, symbols):
        total[arc] += weight
    return [math.log1p(v) for v in total.values()]


@dataclass
class ToxicityModel:
    lexicon: Lexicon = field(default_factory=Lexicon)
    arcs: list[float] = field(default_factory=lambda: [2.5 * w for w in ARCS.values()])
    base: float = BASE

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.arcs) + self.base, -30, 30)))


# ---------------------------------------------------------------- learning


def _stems(text: str) -> set[str]:
    """The words, and their beginnings marked by ``*``."""
    distinct = set(words(text))
    return distinct | {w[:n] + "*" for w in distinct for n in PREFIX_LENGTHS if len(w) >= n}


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest five-word shingle, which near copies mostly share."""
    hashes = WordHashes()
    for b in batches:
        key = []
        for t in b.column("text").to_pylist():
            s = shingle_hashes(hashes.of(words(t or "")), 5)
            key.append(int(s.min() >> np.uint64(1)) if len(s) else 0)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key, pa.int64())], [*b.schema.names, "near"])


def _stem_counts(wanted):
    """Documents per stem (and label); ``wanted`` limits the stems."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = None if wanted is None else wanted.value
        for b in batches:
            count = Counter()
            for t in b.column("text").to_pylist():
                s = _stems(t or "")
                count.update(s if allowed is None else s & allowed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["stem", "n"])
    return run


def _evidence_rows(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(lexicon.value)
        for b in batches:
            rows = [evidence(t or "", symbols) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(rows, pa.list_(pa.float64()))],
                                             ["label", "x"])
    return run


def _fit_arcs(x: np.ndarray, y: np.ndarray, start: ToxicityModel, pull: float = 2.0,
              steps: int = 400, rate: float = 0.3) -> tuple[list[float], float]:
    """Logistic weights by gradient descent, pulled to the grammar's own."""
    prior = np.array(start.arcs)
    w, b = prior.copy(), start.base
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        w -= rate * ((x.T @ (p - y)) / len(y) + pull * (w - prior) / len(y))
        w = np.maximum(w, 0.0)
        b -= rate * float((p - y).mean())
    return w.tolist(), b


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Learn from ``labels`` (id, 0/1); the caller leaves out held-out rows."""
    spark = docs.sparkSession
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most max_rows narrow rows are broadcast
    sample = (rows.join(F.broadcast(chosen), "id").select("label", "text")
              .mapInArrow(_keyed, "label int, text string, near long"))
    sample = written(sample, "toxicity-sample")
    n = dict(sample.groupBy("label").count().collect())
    if not (n.get(0) and n.get(1)):
        return ToxicityModel()

    distinct = sample.dropDuplicates(["label", "near"])
    n = dict(distinct.groupBy("label").count().collect())
    need = max(MIN_SUPPORT, math.ceil(MIN_SHARE * n[1]))

    def counted(label: int, wanted) -> dict[str, int]:
        c = (distinct.where(F.col("label") == label).mapInArrow(_stem_counts(wanted), "stem string, n long")
             .groupBy("stem").agg(F.sum("n").alias("n")))
        return dict((c.where(F.col("n") >= need) if wanted is None else c).collect())

    # at most (stems of a document) / MIN_SHARE stems have that support
    toxic = counted(1, None)
    clean = counted(0, spark.sparkContext.broadcast(frozenset(toxic)))
    lexicon = Lexicon()
    for stem, a in toxic.items():
        p, q = (a + 0.5) / (n[1] + 1), (clean.get(stem, 0) + 0.5) / (n[0] + 1)
        share = a / (a + clean.get(stem, 0))
        if share >= MIN_PURITY and p > 4 * q:
            weight = min(4.0, math.log(p / q) / 2)
            (lexicon.prefix if stem.endswith("*") else lexicon.exact)[stem.rstrip("*")] = weight

    model = ToxicityModel(lexicon)
    x = sample.mapInArrow(_evidence_rows(spark.sparkContext.broadcast(lexicon)),
                          "label int, x array<double>").toPandas()      # at most max_rows short rows
    model.arcs, model.base = _fit_arcs(np.array(x["x"].tolist()), x["label"].to_numpy(float), model)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                   text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, score, n_matches of every row, and the columns ``keep``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        symbols = Symbols(m.lexicon)
        for b in batches:
            found = [matches(t or "", symbols) for t in b.column("_text").to_pylist()]
            x = np.zeros((len(found), len(ARCS)))
            order = {a: k for k, a in enumerate(ARCS)}
            for i, f in enumerate(found):
                for arc, weight in f:
                    x[i, order[arc]] += weight
            rest = [(n, c) for n, c in zip(b.schema.names, b.columns) if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(m.scores(np.log1p(x)), pa.float64()),
                 pa.array([len(f) for f in found], pa.int64())],
                [*(n for n, _ in rest), "score", "n_matches"])

    cols = [id_col, *(c for c in keep if c != id_col)]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in cols)
    return (docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("_text"))
            .mapInArrow(run, f"{types}, score double, n_matches long"))
