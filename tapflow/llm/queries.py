"""The operators of this package applied to the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.llm.common import crc_bucket, prepare, scratch_path, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"))


def _documents(spark: SparkSession, sf_dir: str, modulus: int, held: int) -> DataFrame:
    """documents with ``held_out``: crc32(doc_id) mod ``modulus`` is ``held``."""
    return table(spark, sf_dir, "documents").withColumn("held_out", crc_bucket("doc_id", modulus) == held)


def _training_labels(spark: SparkSession, sf_dir: str, modulus: int, held: int) -> DataFrame:
    return table(spark, sf_dir, "labels").where(crc_bucket("doc_id", modulus) != held)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.toxicity import fit_toxicity, score_toxicity
    docs = _documents(spark, sf_dir, 3, 1)
    model = fit_toxicity(docs, _training_labels(spark, sf_dir, 3, 1))
    return score_toxicity(docs, model, keep=("held_out",)).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_matches")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.langid import fit_languages, predict_languages
    docs = _documents(spark, sf_dir, 4, 2)
    return predict_languages(docs, fit_languages(docs.where(~F.col("held_out"))))


def op4_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.dac import read_entries, write_tokens
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER, END_ID)
    return read_entries(spark, path)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.quality import fit_quality, score_quality
    docs = _documents(spark, sf_dir, 5, 0)
    model = fit_quality(docs, _training_labels(spark, sf_dir, 5, 0))
    return score_quality(docs, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.mixing import mix_sources, word_count
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), word_count(F.col("text")).alias("size"), F.array("source").alias("sources"))
    return mix_sources(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.jaccard_join import jaccard_join
    return jaccard_join(table(spark, sf_dir, "documents")).drop("row")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.urls import url_verdicts
    return url_verdicts(table(spark, sf_dir, "pages")).drop("score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.decontaminate import find_overlaps
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
                        F.coalesce(F.array_max(F.transform("matches", lambda m: m["equal"])), F.lit(0)).alias("most_equal"))


def op10_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.merkle import verify_documents
    return verify_documents(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.prefix_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapflow.llm.quality_rules import apply_rules
    return apply_rules(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_toxicity, op3_language_id, op4_token_codes, op5_quality, op6_source_mix,
    op7_jaccard_join, op8_url_filter, op9_decontamination, op10_label_sharding,
    op11_merkle_manifest, op12_prefix_trie, op13_quality_rules)}


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def llm_queries() -> dict:
    return {name: _prepared(fn) for name, fn in QUERIES.items()}


def llm_oracle_sql() -> dict[str, str]:
    from tapflow.llm.oracle import ORACLE_SQL
    return dict(ORACLE_SQL)
