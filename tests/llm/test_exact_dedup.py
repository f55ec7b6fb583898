import hashlib
from collections import defaultdict

import pytest

from tapflow.llm import bloom
from tapflow.llm import exact_dedup as m


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("limit", [bloom.MAX_FILTER_BYTES, 8])     # 8 bytes: filtered in several hash ranges
def test_against_grouping(docs, limit):
    got = m.exact_dedup(docs, max_filter_bytes=limit).collect()
    rows = [(r.doc_id, ascii_lower(r.text)) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert len(got) == len(rows)
    for t, ids in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        best = max((i for i in ids if i is not None), default=None)
        assert len(mine) == len(ids) and {r.keep_id for r in mine} == {best}
        assert {r.group_size for r in mine} == {len(ids)} and sum(r.kept for r in mine) == 1
        assert [r.doc_id for r in mine if r.kept] == [best]


def test_hot_text_and_false_positives(prepared):
    df = prepared.range(6000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'Same', concat('t', id)) AS text")
    got = m.exact_dedup(df.repartition(5))
    assert got.where("kept").count() == 4001
    assert got.where("group_size = 2000 AND keep_id = 5997").count() == 2000
    assert got.where("group_size = 1 AND kept AND keep_id = doc_id").count() == 4000


def test_empty(no_docs):
    assert m.exact_dedup(no_docs).count() == 0
