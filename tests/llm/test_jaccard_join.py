import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from tapflow.llm import jaccard_join as m


def brute(rows):
    """links and class per row number, on exact sets."""
    sets, n = [], len(rows)
    for _, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else (t or ""))
    links, root = Counter(), list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(range(n), 2):
        x, y = sets[a], sets[b]
        same = x == y if isinstance(x, str) or isinstance(y, str) else 10 * len(x & y) >= 8 * len(x | y)
        if same:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    classes = defaultdict(list)
    for i in range(n):
        classes[find(i)].append(i)
    return links, {i: c for c in classes.values() for i in c}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    links, classes = brute(rows)
    got = m.jaccard_join(df).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in classes[i] if rows[k][0] is not None]
        want[doc_id, min(ids, default=None), links[i]] += 1
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    assert sum(r["first"] for r in got) == len({id(c) for c in classes.values()})


def variants(n, words, change, seed):
    rng = np.random.default_rng(seed)
    base = [f"b{seed}w{i}" for i in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for i in rng.choice(words, rng.integers(0, change + 1), replace=False):
            w[i] = f"x{rng.integers(1 << 30)}"
        out.append(" ".join(w))
    return out


def test_edges_against_brute_force(docs, no_docs):
    check(docs)
    assert m.jaccard_join(no_docs).count() == 0


def test_groups_of_near_copies(prepared, monkeypatch):
    texts = variants(90, 120, 5, 1) + variants(40, 300, 6, 2) + variants(30, 12, 1, 3)
    passage = " ".join(f"common{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"own{k}n{i}" for i in range(90)) for k in range(60)]
    df = prepared.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:50] * 2)], "doc_id long, text string")
    check(df)
    monkeypatch.setattr(m, "BLOCK", 16)           # large buckets meet in blocks
    check(df)


def test_pruning_keeps_what_may_reach_the_threshold():
    least = m.least_matches()
    assert all(a <= b for a, b in zip(least, least[1:]))
    rng = np.random.default_rng(0)
    n = np.arange(m.STEP, m.HASHES + 1, m.STEP)
    lost = 0
    for _ in range(4000):                          # pairs of similarity 0.8
        hit = np.cumsum(rng.random(m.HASHES) < 0.8)[n - 1]
        lost += (hit < least).any()
    assert lost <= 4


def test_dense_and_sparse_verification_agree():
    rng = np.random.default_rng(4)
    base = rng.choice(1 << 20, 400, replace=False).astype(np.uint32)
    sets = [np.unique(np.where(rng.random(400) < 0.08, rng.integers(0, 1 << 31, 400), base).astype(np.uint32))
            for _ in range(30)]
    i, j = (x.ravel() for x in np.indices((30, 30)))
    dense = m.verify(sets, sets, i, j)
    sparse = np.array([m.verify(sets, sets, i[k:k + 1], j[k:k + 1])[0] for k in range(len(i))])
    assert (dense == sparse).all() and dense.any() and not dense.all()
