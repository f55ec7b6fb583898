import os

import pytest

from tapflow.llm import urls as m

COLS = "page_id long, url string, host string, score string"


def test_parts_and_rules(prepared):
    cases = [("http://A.Example.com/en/1?x#y", "a.example.com", "/en/1", "example.com/en/"),
             ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
             ("https://com/x", "com", "/x", "com/"), ("https://falsecom/x", "falsecom", "/x", None),
             ("http://foo.com", "foo.com", "", None), ("http://foo.com?/x", "foo.com", "", None),
             ("x://b.net/es/1://c", "b.net", "/es/1://c", "net/es/"), ("b.net/es/1", "", "", None),
             ("", "", "", None), (None, "", "", None), ("http://ÄB.NET/fr/Ä", "Äb.net", "/fr/Ä", "net/fr/")]
    df = prepared.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases)], COLS)
    got = {r.page_id: r for r in m.url_verdicts(df).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(cases))] == [c[1:] for c in cases]
    assert [got[i].verdict for i in (0, 1, 2, 6, 10)] == ["block", "allow", "allow", "block", "block"]


def test_model_ratio(prepared):
    good = [f"http://news{i}.com/story/{i}" for i in range(40)]
    bad = [f"http://casino{i}.net/es/win-{i}" for i in range(40)]
    probe = ["http://news7.org/story/9", "http://casino5.org/es/win-3"]
    df = prepared.createDataFrame([(i, u, "x", "y") for i, u in enumerate(good + bad + probe)], COLS)
    got = {r.page_id: r for r in m.url_verdicts(df).collect()}
    assert (got[80].verdict, got[81].verdict) == ("allow", "block") and got[80].rule is None
    assert got[80].score > 0 > got[81].score


def test_digits_and_page_counts_decide(prepared):
    """URLs that differ in digits only get different verdicts; a URL of many
    pages weighs as much as its pages."""
    rows = [f"http://a{i}.com/id/777{i}" for i in range(20)] + [f"http://a{i}.net/es/id/333{i}" for i in range(20)]
    probe = ["http://a.org/id/7777", "http://a.org/id/3333"]
    table = lambda urls: prepared.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], COLS)
    got = [r.score for r in m.url_verdicts(table(rows + probe)).orderBy("page_id").collect()]
    assert got[40] > got[41]
    # the same URL on many allowed pages moves what resembles it towards allow
    many = [r.score for r in m.url_verdicts(table(rows + probe + ["http://a1.com/id/3333"] * 400)).orderBy("page_id").collect()]
    assert many[41] > got[41]


def test_edges(prepared):
    assert m.url_verdicts(prepared.createDataFrame([], COLS)).count() == 0
    one = prepared.createDataFrame([(1, "http://a.org/x", "x", "y"), (1, "http://a.org/x", "x", "y")], COLS)
    assert [r.verdict for r in m.url_verdicts(one).collect()] == ["allow", "allow"]
    long = prepared.createDataFrame([(1, "http://a.org/" + "ab" * 40_000, "x", "y"), (2, "http://a.com/", "x", "y"),
                                     (3, "http://a.net/es/", "x", "y")], COLS)
    assert m.url_verdicts(long).count() == 3


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/pages.parquet"), reason="no test data")
def test_no_python_in_the_plan(prepared):
    df = m.url_verdicts(prepared.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
