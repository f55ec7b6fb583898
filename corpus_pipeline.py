"""A training-corpus pipeline: toxicity, near duplicates, benchmark passages,
source mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``docs``.

* toxicity: documents predicted toxic go; labels are learned from training
  rows only, scores read the text only.
* near_duplicates: of each class of linked documents the one with the
  smallest id stays; of equal rows one stays.
* benchmark: documents with a verified benchmark passage go.
* mix: documents are repeated as often as the mix takes them; those it does
  not take go.
* shards: every remaining row gets its shard and slot.

Defined results: null and empty texts are not toxic, are near duplicates of
equal texts only, have no passage and size 0, so the mix leaves them out; an
empty table passes through as an empty table.  Columns with the names that
operators use inside are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.llm import decontaminate as _decontaminate
from tapflow.llm import jaccard_join as _jaccard
from tapflow.llm import mixing as _mixing
from tapflow.llm import sharding as _sharding
from tapflow.llm import toxicity as _toxicity
from tapflow.llm.common import crc_bucket, prepare, table, written

TOXIC_SCORE = 0.7
SHARDS = 16


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or it with more underscores: no column of ``docs``, which are
    compared without case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written with a row number, so that rows equal in id and text
    stay apart when an operator's decisions are joined back, and the number's
    column."""
    row = _free(docs, "_corpus_row")
    return written(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    labels = table(spark, sf_dir, "labels").where(crc_bucket("doc_id", 3) != 1)
    model = _toxicity.fit_toxicity(docs, labels)
    row = _free(docs, "_corpus_row")
    scored = _toxicity.score_toxicity(docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns])),
                                      model, id_col=row)
    return scored.where(F.col("score") < TOXIC_SCORE).select(f"{row}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, row = _numbered(docs, "corpus-dedup")
    # the class's smallest (id, row) stays, null ids last
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    found = _jaccard.jaccard_join(docs.select(order.alias("_id"), "text"), id_col="_id")
    stay = found.where("first").select(F.col("_id.row").alias(row))
    return docs.join(stay, row, "left_semi").drop(row)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, row = _numbered(docs, "corpus-mix")
    copies = _free(docs, "_copies")
    rows = docs.select(F.col(row).alias("id"), F.col("doc_id").alias("key"), _mixing.word_count(F.col("text")).alias("size"),
                       F.array("source").alias("sources"))       # chosen by doc_id, joined back by row
    taken = _mixing.mix_sources(rows).where("copies > 0 and size > 0").select(
        F.col("id").alias(row), F.col("copies").alias(copies))
    return (docs.join(taken, row)
            .withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).drop(row, copies))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _sharding.shard_documents(docs, shards=SHARDS)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("benchmark", benchmark),
          ("mix", mix), ("shards", shards)]

#: SQL cannot state the learned, iterative stages; tests/llm/test_pipeline.py
#: follows planted documents through every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"corpus-{name}")
    return docs
