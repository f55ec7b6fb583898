import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tapflow.llm import merkle as m

LOW = str.maketrans(m.UPPER, m.LOWER)


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                     for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        out.append(("".join(run[:i % 16]), "".join(run[i % 16 + 1:])))
        i //= 16
    return out


def brute_force(rows):
    """Sorted result rows by plain recursion over lists."""
    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    trees = [tree([leaf_of(r, r.text) for r in groups[s]]) for s in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for j, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            way = siblings(trees[j], i) + siblings(top, j)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None
            acc = leaf_of(r, r.text.translate(LOW) if hit else r.text)
            for a, b in way:
                acc = H(a + acc + b)
            out.append((r.doc_id, trees[j][0][i], trees[j][-1][0], top[-1][0], H("".join(a + b for a, b in way)),
                        acc, acc == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_recursion(docs):
    assert result(m.verify_documents(docs)) == brute_force(docs.collect())


def test_hot_source_of_many_levels(prepared):
    """One source with 300 rows (three levels), 40 rows alike, 20 small ones."""
    big = prepared.range(300).selectExpr("id * 7 AS doc_id", "concat('Text ', id) AS text", "'en' AS lang",
                                         "'hot' AS source", "id AS n_chars")
    alike = prepared.range(40).selectExpr("-1L AS doc_id", "'Same' AS text", "'en' AS lang", "'hot' AS source", "4L AS n_chars")
    small = prepared.range(20).selectExpr("10000 + id AS doc_id", "'Z' AS text", "null AS lang",
                                          "concat('s', id) AS source", "1L AS n_chars")
    rows = big.unionAll(alike).unionAll(small).repartition(6)
    got = result(m.verify_documents(rows))
    assert got == brute_force(rows.collect())
    assert any(not r[-1] for r in got) and sum(r[-1] for r in got) > 200


def test_some_requests_only(docs):
    manifest = m.build_manifest(m.leaves_of(docs))
    asked = manifest.leaves.where("pos % 2 = 1").select("tree", "height", "pos", "leaf")
    got = m.prove(manifest, asked)
    assert got.count() == asked.count() > 0
    assert {r.root for r in got.select(m.fold(F.col("leaf"), F.col("path")).alias("root")).collect()} == {manifest.root}


@pytest.mark.parametrize("rows", [1, 2])
def test_one_source(prepared, rows):
    df = prepared.range(rows).selectExpr("id AS doc_id", "'T' AS text", "'en' AS lang", "'a' AS source", "1L AS n_chars")
    assert result(m.verify_documents(df)) == brute_force(df.collect())


def test_empty(no_docs):
    assert m.verify_documents(no_docs).count() == 0
