import re
from collections import defaultdict

import numpy as np
import pytest

from tapflow.llm import quality_rules as m

WORD = re.compile("[^\x20\x09-\x0D]+")


def base_of(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    covered = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def base_of_row(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


TEXTS = [None, "", " \n\t\x0b ", "one", "a b c d e f g h " * 3, "a b c d e f g h x " + "a b c d e f g h", "x\ny\nx\n \n \nx y\nx y",
         "# * $ % & | < > ä\x85b c d", "w " * 30, " ".join(map(str, range(400))) + " " + " ".join(map(str, range(90, 140))),
         "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", "\U0001F600\U0001F600 z\r\nz\r\nz"]


def test_base_counts(prepared, docs):
    df = prepared.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source")
    got = {r.doc_id: base_of_row(r) for r in m.text_statistics(df).collect()}
    assert got == {i: base_of(t) for i, t in enumerate(TEXTS)}
    want = sorted((str(r.doc_id), *base_of(r.text)) for r in docs.collect())
    got = m.apply_rules(docs).collect()
    assert sorted((str(r.doc_id), *base_of_row(r)) for r in got) == want
    assert all(r.kept != r.base_failed and r.distance is None for r in got)        # no cell is large enough


def test_random_texts_by_brute_force(prepared):
    rnd = np.random.default_rng(5)
    texts = ["".join(rnd.choice(list("ab #\n\t"), size=rnd.integers(0, 400))) for _ in range(300)]
    df = prepared.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr(
        "*", "null AS lang", "null AS source")
    assert {r.doc_id: base_of_row(r) for r in m.text_statistics(df).collect()} == {i: base_of(t) for i, t in enumerate(texts)}


def distances(x, mean, cov):
    z = np.linalg.solve(np.linalg.cholesky(cov + np.diag(np.square(m.FLOORS))), (x - mean).T)
    return (z * z).sum(0)


def weighted_step(x, d):
    """Mean and scatter of the 75 % nearest; the last distance bin in part."""
    bins = np.floor(np.log2(d + 1e-9) * m.BINS).astype(int)
    left, w = m.SUBSET * len(x), np.zeros(len(x))
    for b in np.unique(bins):
        mine = bins == b
        w[mine] = max(0.0, min(1.0, left / mine.sum()))
        left -= mine.sum()
    mean = (w[:, None] * x).sum(0) / w.sum()
    return mean, (w[:, None] * x).T @ x / w.sum() - np.outer(mean, mean)


def log_det(cov):
    return np.linalg.slogdet(cov + np.diag(np.square(m.FLOORS)))[1]


@pytest.fixture(scope="module")
def planted(prepared):
    """Two cells of normal vectors, 20 % of them far away; one cell is too
    small and joins the pool of its language."""
    rnd = np.random.default_rng(11)
    rows = []
    for source, n, shift in (("a", 400, 0.0), ("b", 260, 1.0), ("c", 60, 0.0), ("d", 50, 0.0)):
        mix = rnd.normal(size=(5, 5)) * 0.1
        x = np.full(5, 3.0 + shift) + rnd.normal(size=(n, 5)) @ (np.eye(5) * 0.4 + mix)
        bad = np.arange(n) < n // 5
        x[bad] += rnd.normal(6, 0.5, size=(bad.sum(), 5))
        rows += [("en", source, bool(b), *map(float, v)) for b, v in zip(bad, x)]
    return rows


def cells_of(planted):
    for sources in ("a", "b", "cd"):
        mine = [r for r in planted if r[1] in sources]
        yield np.array([r[3:] for r in mine]), np.array([r[2] for r in mine])


def test_cells(prepared, planted):
    df = prepared.createDataFrame([r[:2] for r in planted] + [(None, "a")] * 30 + [("fr", None)] * 80 + [(None, None)] * 2,
                                  "lang string, source string")
    got = m.with_cells(df, 100)
    assert got.count() == len(planted) + 112
    names = {(r.lang, r.source): r.cell for r in got.distinct().collect()}
    assert names["en", "c"] == names["en", "d"] is not None
    assert names[None, "a"] == names["fr", None] == names[None, None] is not None      # 112 rows of two languages
    assert len({names[k] for k in [("en", "a"), ("en", "b"), ("en", "c"), ("fr", None)]}) == 4
    assert m.with_cells(df.where("lang is null"), 100).where("cell is not null").count() == 0


def test_estimates(prepared, planted):
    """Each step equals numpy, the end is a fixed point with a determinant no
    greater than random starts reach, and planted vectors are outside."""
    schema = "lang string, source string, bad boolean, x0 double, x1 double, x2 double, x3 double, x4 double"
    rows = m.written(m.with_cells(prepared.createDataFrame(planted, schema), 100), "test-rules")
    cell = {r.source: r.cell for r in rows.select("source", "cell").distinct().collect()}
    begin = m.factored(m.starts(rows))
    step = {(r.cell, r.start): r for r in m.factored(m.concentrate(rows, begin)).collect()}
    final = {r.cell: r for r in m.mcd(rows).collect()}
    rnd = np.random.default_rng(3)
    as_numpy = lambda r: (np.array([r[f"m{i}"] for i in range(5)]),                # noqa: E731
                          np.array([[r[m._s(i, j)] for j in range(5)] for i in range(5)]))
    first = {(r.cell, r.start): as_numpy(r) for r in begin.collect()}
    for source, (x, bad) in zip("abc", cells_of(planted)):
        dets = []
        for start in range(3):
            mean, cov = weighted_step(x, distances(x, *first[cell[source], start]))
            got = as_numpy(step[cell[source], start])
            assert np.allclose(got[0], mean, atol=1e-6) and np.allclose(got[1], cov, atol=1e-6)
            assert abs(step[cell[source], start].log_det - log_det(cov)) < 1e-5
            for _ in range(30):
                mean, cov = weighted_step(x, distances(x, mean, cov))
            dets.append((log_det(cov), mean, cov))
        others = []
        for _ in range(20):
            some = x[rnd.choice(len(x), 10, replace=False)]
            mean, cov = some.mean(0), np.cov(some.T)
            for _ in range(30):
                mean, cov = weighted_step(x, distances(x, mean, cov))
            others.append(log_det(cov))
        best, mean, cov = min(dets, key=lambda d: d[0])
        assert best <= min(others) + 0.05
        cov = cov * m.CONSISTENCY
        for _ in range(2):
            inside = x[distances(x, mean, cov) <= m.CUT]
            mean, cov = inside.mean(0), np.cov(inside.T, bias=True)
        got = as_numpy(final[cell[source]])
        assert np.allclose(got[0], mean, atol=0.02) and np.allclose(got[1], cov, atol=0.02)
        d = distances(x, *got)
        assert (d[bad] > m.CUT).all() and (d[~bad] <= m.CUT).all()


def test_planted_junk_goes_and_prose_stays(prepared):
    rnd = np.random.default_rng(2)
    vocabulary = ["".join(rnd.choice(list("abcdefghij"), size=rnd.integers(2, 9))) for _ in range(3000)]
    prose = lambda n: ".\n".join(" ".join(rnd.choice(vocabulary, size=12)) for _ in range(n))          # noqa: E731
    junk = ["|".join("$%" + w for w in rnd.choice(vocabulary, size=200)) + " x" * 25, " ".join("#$%" + w for w in rnd.choice(vocabulary, size=300)),
            "\n".join(["menu home about"] * 3 + [" ".join(rnd.choice(vocabulary, size=6))] * 2 + ["click here now"] * 60)]
    rows = [(i, prose(int(rnd.integers(3, 40))), "en", "s") for i in range(400)]
    rows += [(1000 + i, junk[i % 3], "en", "s") for i in range(60)]
    df = prepared.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in m.apply_rules(df).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(60))


def test_no_python_in_plans(prepared, docs):
    plan = m.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty(no_docs):
    assert m.apply_rules(no_docs).count() == 0
