import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from beneflow.llm import toxicity as X
from beneflow.llm.frames import held_out

DOCS = "doc_id bigint, text string, score string, label int, positive int"


def corpus(n=1500, seed=5):
    """Every tenth text has a bad word; half of those are confirmed, the rest is not labelled."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("lo", "mi", "ta", "se") for b in ("ra", "tu", "ne", "po", "zi", "ka")]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(5, 80))
        bad = i % 10 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Vile", "grotty", "nastyling", "nastyish"])
            words.append(rng.choice(["vile", "grotty"]))
        docs.append((i, " ".join(words), "own", 1, None))
        if i % 20 == 0 or i % 7 == 1:
            labels.append((i, None, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return (spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_finds_unconfirmed_texts(spark, tables):
    docs, labels = tables
    model = X.train(docs, labels, ~held_out())
    odd = spark.createDataFrame(
        [(None, "vile grotty", "", None, None), (5000, None, "", None, None), (5001, "", "", None, None),
         (5001, "", "", None, None), (5002, "tara " * 60_000 + "vile grotty vile", "", None, None)], DOCS
    )
    rows = X.score(docs.union(odd), model).collect()
    assert len(rows) == 1505
    scores = {r.doc_id: r.score for r in rows}
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([scores[i] >= 0.5 for i in range(0, 1500, 10)]) > 0.95
    assert np.mean([scores[i] >= 0.5 for i in range(1500) if i % 10]) < 0.01
    assert scores[None] >= 0.5 and scores[5002] >= 0.5
    assert scores[5000] == scores[5001] < 0.5
    kept = X.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(1500) if scores[i] < 0.5}
    again = {r.doc_id: r.score for r in X.score(docs, X.train(docs.repartition(5), labels, ~held_out())).collect()}
    assert all(again[i] == pytest.approx(scores[i], abs=1e-9) for i in again)


def test_held_out_rows_do_not_matter(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (X.train(docs, x, ~held_out()) for x in (labels, turned))
    assert np.array_equal(first.weights, second.weights) and first.bias == second.bias


def test_held_out_is_crc32_of_the_id(spark):
    rows = spark.range(300).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    empty = docs.limit(0)
    none = labels.where("toxic = 0").unionAll(spark.createDataFrame([(3, 1, None)], labels.schema))
    model = X.train(docs, none, ~held_out())
    assert {r.score for r in X.score(docs, model).collect()} == {0.0}
    assert X.score(empty, X.train(empty, labels.limit(0), ~held_out())).collect() == []
    # Labels of documents that are not there.
    assert X.score(empty, X.train(empty, labels, ~held_out())).collect() == []


def test_query_on_held_out_rows(spark):
    from beneflow.llm.queries import op1_toxicity

    folder = "/root/testdata/sf0.1"
    rows = op1_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = rows.where("held_out").collect()
    toxic, clean = ([r for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean([r.predicted for r in toxic]) > 0.7
    assert np.mean([r.predicted for r in clean]) < 0.01
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_every_score_in_plain_python(spark):
    """The whole table: words and prefixes by regular expressions, weights added one by one."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = X.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out())
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = dict(zip([i for i, _ in texts], plain.toxicity_scores(model, [t for _, t in texts]), strict=True))
    rows = X.score(docs, model).collect()
    assert len(rows) == len(expected) and len(model.weights) > 0
    assert all(r.score == pytest.approx(expected[r.doc_id], abs=1e-9) for r in rows)
