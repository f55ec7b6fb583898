import os
import random
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapflow.llm.queries import llm_oracle_sql, llm_queries

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@needs_data
def test_stages_keep_columns_and_clean_documents(prepared):
    docs = prepared.read.parquet(f"{SF}/documents.parquet")
    toxic = prepared.read.parquet(f"{SF}/labels.parquet").where("toxic = 1")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(prepared, before, SF)
        assert after.columns == docs.columns, name
        gone = before.join(after, "doc_id", "left_anti")
        if name == "toxicity":
            assert gone.count() == gone.join(toxic, "doc_id", "left_semi").count() or gone.count() < 0.3 * before.count()
        assert after.join(before, docs.columns, "left_anti").where("lang is not null").count() == 0
        before = after
    mixed = corpus_pipeline.mix(prepared, before, SF)
    assert mixed.columns == docs.columns
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    out = corpus_pipeline.shards(prepared, mixed, SF)
    assert out.count() == mixed.count()


def test_edge_rows_pass(prepared, docs, no_docs):
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", "kept", "score")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if os.path.isdir(SF):
            assert stage(prepared, docs, SF).columns == docs.columns, name
            assert stage(prepared, no_docs, SF).count() == 0, name
    if os.path.isdir(SF):
        kept = corpus_pipeline.near_duplicates(prepared, docs, SF)
        # copies: 1 = 2, 3 = 4, 5 = 6, 7 ~ 8, 10 = 11, 12 = 13, 14 = 14
        assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 3, 5, 7, 9, 10, 12, 14]


@needs_data
@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_queries_equal_their_sql(prepared, name):
    from tests.oracle_compare import compare, duck_connection
    ok, _, _, detail = compare(prepared, duck_connection(SF), name, llm_queries()[name], llm_oracle_sql()[name], SF)
    assert ok, detail


def test_columns_with_the_names_used_inside(prepared, docs):
    """They come out as they went in."""
    named = docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null").withColumns(
        {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("_corpus_row", "_Copies", "_id", "key")})
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.mix):
        out = stage(prepared, named, SF)
        assert out.columns == named.columns and out.count() > 0
        assert out.where("_corpus_row <> concat('_corpus_row', doc_id) or _copies <> concat('_Copies', doc_id)").count() == 0


def test_planted_documents_through_the_stages(prepared, tmp_path):
    """Near copies, a benchmark passage and clean texts: what each stage
    should keep."""
    rnd = random.Random(8)

    def prose(n):
        return " ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(3, 9))) for _ in range(n))

    item = prose(60)
    clean = {i: prose(rnd.randrange(60, 200)) for i in range(40)}
    near = {100 + i: clean[i].rsplit(" ", 1)[0] + " changed" for i in range(10)}
    copies = {200 + i: clean[10] for i in range(5)}
    leaked = {300 + i: f"{prose(40)} {item} {prose(30)}" for i in range(4)}
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for part in (clean, near, copies, leaked) for i, t in part.items()]
    docs = prepared.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    prepared.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    kept = corpus_pipeline.near_duplicates(prepared, docs, sf)
    assert ids(kept) == sorted([*clean, *leaked])
    kept = corpus_pipeline.benchmark(prepared, kept, sf)
    assert ids(kept) == sorted(clean)
    mixed = corpus_pipeline.mix(prepared, kept, sf)
    assert set(ids(mixed)) <= set(clean) and max(map(ids(mixed).count, clean)) <= 2
    assert ids(corpus_pipeline.shards(prepared, mixed, sf)) == ids(mixed)
