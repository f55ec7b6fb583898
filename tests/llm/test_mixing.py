import re
import time

import pytest
from pyspark.sql import functions as F

from tapflow.llm import mixing as m


def rows_of(docs):
    return docs.select(F.col("doc_id").alias("id"), m.word_count(F.col("text")).alias("size"),
                       F.array("source").alias("sources"))


def test_quotas_by_hand():
    assert m.quotas({"a": 100, "b": 100, "c": 100}) == {"a": 200.0, "b": 250 / 3, "c": 500 / 3}   # a is capped at twice
    assert m.quotas({"a": 10, "b": 0}) == {"a": 15.0, "b": 0.0}
    assert m.quotas({}) == {}
    # in order z, é, null: weights 3, 1, 2; all that é and null take at most is twice their size
    assert m.quotas({None: 50, "z": 500, "é": 40}) == {"é": 80.0, None: 100.0, "z": 705.0}


def test_flow_prefers_fresh_words():
    # x can serve both, y only b: b is fed by y first, x repeats nothing
    flow = m.min_cost_flow({0: 100, 1: 100}, {0: ["a", "b"], 1: ["b"]}, {"a": 100, "b": 100})
    assert flow == {(0, "a"): 100.0, (1, "b"): 100.0}
    flow = m.min_cost_flow({0: 100, 1: 50}, {0: ["a", "b"], 1: ["b"]}, {"a": 100, "b": 100})
    assert flow[0, "a"] == 100 and flow[1, "b"] + flow.get((0, "b"), 0) == 100
    # two repetitions at most
    assert sum(m.min_cost_flow({0: 10}, {0: ["a"]}, {"a": 99}).values()) == 20


def test_mix_comes_near_targets(prepared):
    df = prepared.range(6000).selectExpr("id", "cast(1 + id % 37 AS long) AS size",
                                         "array(IF(id % 3 = 0, 'hot', concat('s', id % 7))) AS sources")
    got = m.mix_sources(df).collect()
    again = m.mix_sources(df.repartition(7)).collect()
    assert sorted(got) == sorted(again) and len(got) == 6000
    by, size = {}, {}
    source = {r.id: r.sources[0] for r in df.collect()}
    for r in got:
        by.setdefault(source[r.id], []).append(r.taken)
        size[source[r.id]] = size.get(source[r.id], 0) + r.size
        assert r.taken in (0, r.size, 2 * r.size)
    want = m.quotas(size)
    for s, taken in by.items():
        assert abs(sum(taken) - want[s]) <= max(0.002 * want[s], 4)


def test_giant_documents_leave_no_gap(prepared):
    # 10,000 documents of 50 words and one that holds 30 % of all words
    df = prepared.range(10001).selectExpr("id", "IF(id = 0, 214286L, 50L) AS size", "array('a') AS sources")
    for seed in range(3):
        got = m.mix_sources(df, share=0.5, seed=seed).agg(F.sum("taken"), F.max("target")).first()
        assert 0 <= got[1] - got[0] < 50, seed
    # copies of one key go together
    pairs = df.selectExpr("id", "size", "sources", "id div 2 AS key")
    got = m.mix_sources(pairs, share=0.5).agg(F.sum("taken"), F.max("target")).first()
    assert 0 <= got[1] - got[0] < 100


def test_overlapping_sources(prepared):
    df = prepared.range(900).selectExpr(
        "id", "10L AS size", "CASE id % 3 WHEN 0 THEN array('a') WHEN 1 THEN array('a', 'b') ELSE array('b') END AS sources")
    got = m.mix_sources(df, weights=(1, 1), share=0.5).agg(F.sum("taken")).first()[0]
    assert abs(got - 0.5 * 12000) <= 40          # sizes per source: 6000 each


def test_edges(docs, no_docs):
    got = m.mix_sources(rows_of(docs)).collect()
    assert len(got) == docs.count()
    text = {(r.doc_id, r.text) for r in docs.collect()}
    size = {}
    for i, t in text:
        size.setdefault(i, len(re.findall(m.WORD, t or "")))
    assert all(r.size == size[r.id] and 0 <= r.taken <= 2 * r.size for r in got)
    assert m.mix_sources(rows_of(no_docs)).count() == 0


def test_flow_of_groups_is_the_flow_of_the_whole():
    """Two groups of overlapping sources and one by itself, null among them."""
    members = {0: ["a"], 1: ["a", "b"], 2: ["c"], 3: ["c", "d"], 4: [None], 5: ["d"], 6: []}
    supply = {0: 100, 1: 50, 2: 10, 3: 400, 4: 70, 5: 5, 6: 9}
    demand = {"a": 180.0, "b": 60.0, "c": 300.0, "d": 200.0, None: 90.0}
    assert sorted(sorted(g) for g in m.components(members)) == [[0, 1], [2, 3, 5], [4]]
    whole, parts = m.min_cost_flow(supply, members, demand), m.flow_by_component(supply, members, demand)

    def given(flow):
        out = dict.fromkeys(supply, 0.0)
        for (p, _), n in flow.items():
            out[p] += n
        return out

    def cost(flow):
        return sum(max(0.0, n - supply[p]) for p, n in given(flow).items())

    assert sum(whole.values()) == pytest.approx(sum(parts.values())) and cost(whole) == pytest.approx(cost(parts))
    for s, words in demand.items():
        assert sum(n for (_, x), n in parts.items() if x == s) == pytest.approx(words)


def test_flow_of_ten_thousand_sources():
    n = 10_000
    supply = {k: 10 + k % 7 for k in range(n)}
    demand = {f"s{k}": 1.5 * supply[k] for k in range(n)}
    began = time.monotonic()
    flow = m.flow_by_component(supply, {k: [f"s{k}"] for k in range(n)}, demand)
    assert time.monotonic() - began < 30
    assert flow == {(k, f"s{k}"): pytest.approx(demand[f"s{k}"]) for k in range(n)}
