"""Queries of this subpackage over the shared test tables, and their DuckDB texts."""

from __future__ import annotations

import os
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beneflow.llm import (
    byte_pairs,
    decontamination,
    exact_top_k,
    jaccard_join,
    mixing,
    oracle,
    packing,
    phrases,
    rule_ensemble,
    secret_scan,
    spelling,
    toxicity,
    url_templates,
    zip_warc,
)
from beneflow.llm.frames import held_out, table
from beneflow.session import shared_folder


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), ~held_out())
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return decontamination.digest(found)


def op3_url_templates(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_templates.judge(table(spark, sf, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.write_packed(packing.pack(table(spark, sf, "documents")), shared_folder(spark, "packed"))


def op5_rule_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    measured = rule_ensemble.measured(table(spark, sf, "documents"))
    model = rule_ensemble.train(measured, table(spark, sf, "labels"), ~held_out())
    return rule_ensemble.score(measured, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= rule_ensemble.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Every row whose vec_id is divisible by 20 against all rows; 20 best."""
    return exact_top_k.exact_top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op7_zip_warc(spark: SparkSession, sf: str) -> DataFrame:
    return zip_warc.round_trip(table(spark, sf, "pages"))


def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Classes are named by their smallest id; links are those between different sets."""
    return jaccard_join.similar_classes(table(spark, sf, "documents"), counts=True).drop("class")


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.plan(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf, "documents")))


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents"))


def op12_byte_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return byte_pairs.digests(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(table(spark, sf, "documents"))


def on_workers(query):
    """Python workers import this package from the folder the driver imports it from, beside their own path."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in known:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
        return query(spark, *args)

    return run


QUERIES = {
    query.__name__: on_workers(query)
    for query in (op1_toxicity, op2_decontamination, op3_url_templates, op4_packing, op5_rule_ensemble, op6_exact_top_k, op7_zip_warc, op8_jaccard_join, op9_mixing, op10_secrets, op11_spelling, op12_byte_pairs, op13_phrases)
}

ORACLE = {
    "op2_decontamination": oracle.DECONTAMINATION,
    "op3_url_templates": oracle.URL_TEMPLATES,
    "op6_exact_top_k": oracle.EXACT_TOP_K,
    "op7_zip_warc": oracle.ZIP_WARC,
    "op8_jaccard_join": oracle.JACCARD_JOIN,
    "op9_mixing": oracle.MIXING,
    "op11_spelling": oracle.SPELLING,
    "op13_phrases": oracle.PHRASES,
}
