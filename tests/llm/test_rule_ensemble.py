import math
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from beneflow.llm import rule_ensemble as R
from beneflow.llm.frames import held_out

DOCS = "doc_id bigint, text string, chars string, label int, score int"
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=900):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(8, 60))]
        good = i % 4 != 0
        if not good:
            words = [w + "#$%" for w in words] if i % 8 else [words[0]] * len(words)
        docs.append((i, " ".join(words) + ".", None, 1, 1))
        if i % 3:
            labels.append((i, int(good), None))
    return docs, labels


@pytest.fixture(scope="module")
def measured(spark):
    docs, labels = corpus()
    odd = [(None, None, None, None, None), (5000, "", "", 1, 1), (5001, " \n\t ", "", 1, 1), (5002, "é#% " * 60_000, "", 1, 1),
           (0, docs[0][1], "", 1, 1)]
    df = spark.createDataFrame(docs + odd, DOCS)
    return R.measured(df), spark.createDataFrame([*labels, (7, None, 1), (None, 1, 1), (9999, 0, 1)], LABELS)


def test_statistics(spark):
    text = "Ab cd, ab\nab cd, ab\n\n12 é!  #$"
    row = spark.createDataFrame([(text,)], "t string").select(*[c.alias(n) for n, c in R.statistics(F.col("t")).items()]).first()
    assert tuple(row.__fields__) == R.NAMES
    assert (row.chars, row.words, row.lines, row.longest_word) == (len(text), 9, 3, 3)
    assert row.distinct_words == pytest.approx(6 / 9) and row.distinct_lines == 1.0
    assert row.digits == pytest.approx(2 / len(text)) and row.other_signs == pytest.approx(2 / len(text))
    assert row.beyond_ascii == pytest.approx(1 / len(text)) and row.short_words == pytest.approx(7 / 9)


def test_rules_of_a_tree():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 5.5)
   If (feature 2 <= 1.0E-3)
    Predict: 0.0
   Else (feature 2 > 1.0E-3)
    Predict: 1.0
  Else (feature 0 > 5.5)
   If (feature 0 <= 9.0)
    Predict: 1.0
   Else (feature 0 > 9.0)
    Predict: 0.0
"""
    inf = math.inf
    assert [r.bounds for r in R.rules_of(tree)] == [
        (("chars", -inf, 5.5),),
        (("chars", -inf, 5.5), ("lines", -inf, 0.001)),
        (("chars", -inf, 5.5), ("lines", 0.001, inf)),
        (("chars", 5.5, inf),),
        (("chars", 5.5, 9.0),),
        (("chars", 9.0, inf),),
    ]


def test_finds_quality(measured):
    stats, labels = measured
    model = R.train(stats, labels, ~held_out())
    assert 0 < len(model.weighted) < 100
    scored = R.score(stats, model)
    assert "Python" not in scored._jdf.queryExecution().toString()
    rows = scored.collect()
    assert len(rows) == 905 and all(0 <= r.score <= 1 for r in rows)
    right = [(r.score >= 0.5) == (r.doc_id % 4 != 0) for r in rows if r.doc_id is not None and r.doc_id < 900]
    assert np.mean(right) > 0.97
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert R.train(stats, turned, ~held_out()) == model


def test_few_labels(measured):
    stats, labels = measured
    one_class = R.train(stats, labels.where("quality = 1"), ~held_out())
    assert {r.score for r in R.score(stats, one_class).collect()} == {1.0}
    none = R.train(stats, labels.limit(0), ~held_out())
    assert {r.score for r in R.score(stats, none).collect()} == {0.5}
    assert R.score(stats.limit(0), none).collect() == []


def test_query_on_held_out_rows(spark):
    from beneflow.llm.queries import op5_rule_ensemble

    folder = "/root/testdata/sf0.1"
    rows = op5_rule_ensemble(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    assert np.mean([r.predicted == r.quality for r in rows.collect()]) > 0.98


def test_every_score_in_plain_python(spark):
    """The whole table: statistics counted from the texts, rules looked at one by one."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stats = R.measured(docs)
    model = R.train(stats, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out())
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    measured = {i: plain.text_statistics(t) for i, t in texts.items()}
    for row in stats.collect():
        assert {n: row[n] for n in R.NAMES} == pytest.approx(measured[row.doc_id], abs=1e-12)
    expected = dict(zip(texts, plain.rule_scores(model, measured.values()), strict=True))
    rows = R.score(stats, model).collect()
    assert len(rows) == len(expected) and model.weighted
    assert all(r.score == pytest.approx(expected[r.doc_id], abs=1e-9) for r in rows)
