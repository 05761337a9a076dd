"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

1. toxicity: documents that the classifier rejects go
2. near duplicates: of documents connected by similar sets of five-word shingles, the one with the smallest id stays
3. decontamination: documents with benchmark passages go
4. mixing: documents are repeated, cut or left out so that sources meet their target weights
5. packing: token ids of what is left, in matrices
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beneflow.llm import decontamination, jaccard_join, mixing, packing, toxicity
from beneflow.llm.frames import held_out, stored, table
from beneflow.llm.queries import on_workers


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trained on the stage's own documents; labels as in the query on toxicity."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words and 0.8; the query on the join has parameters of its own."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document the mix takes twice is there twice; ``n_chars`` is that of the text as it is now."""
    return mixing.mixed(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str = packing.VOCABULARY) -> DataFrame:
    return packing.pack(docs, vocabulary)


STAGES = [
    ("toxicity", on_workers(drop_toxic)),
    ("near_duplicates", on_workers(drop_near_duplicates)),
    ("decontamination", on_workers(drop_contaminated)),
    ("mixing", on_workers(mix_sources)),
    ("packing", on_workers(pack_tokens)),
]

# A trained classifier and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return last(spark, docs, sf_dir)
