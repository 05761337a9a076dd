import random
import re

import pytest
from pyspark.sql import functions as F

from beneflow.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    w = split(text)
    hit, found = set(), set()
    for item, other in items:
        o = split(other)
        n = min(window, len(o))
        windows = {tuple(o[i : i + n]) for i in range(len(o) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in windows and item is not None:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def cases():
    rng = random.Random(3)
    vocabulary = ["the", "of", "é", "Ünï", "a1", "B", "zz"]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, sentence(rng.choice([1, 2, 3, 5, 6, 9]))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "...!"), (None, "the of"), (3, "another Text"), (30, items[4][1])]
    docs = [(i, sentence(rng.choice([0, 1, 4, 30, 400]))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "the-OF the"), (None, items[0][1]), (5, "another\ttext!"),
             (103, "x " * 50_000 + items[5][1] + " y" * 50_000)]
    return docs, items


@pytest.mark.parametrize("size", [100_000, 7])
def test_equals_brute_force(spark, monkeypatch, size):
    docs, items = cases()
    monkeypatch.setattr(D, "ROUND_BLOCKS", 2)
    df = spark.createDataFrame([(i, t, "r", "i") for i, t in docs], "doc_id bigint, text string, runs string, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("lang", F.lit("x"))
    rows = D.find_benchmark(df, bench, window=4, size=size).collect()
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, sum(r.runs[1::2]) - sum(r.runs[::2]), r["items"]) for r in rows)
    assert got == sorted(((i is None, i or 0), *brute(t, items, 4)) for i, t in docs)
    kept = D.without_contaminated(df, bench, window=4, size=size)
    assert kept.columns == df.columns
    expected = [i for i, t in docs for n, h, _ in [brute(t, items, 4)] if not (h > 0 and 20 * h >= n)]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted((i is None, i or 0) for i in expected)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    assert D.digest(D.find_benchmark(empty, items)).count() == 0
    row = D.digest(D.find_benchmark(one, items)).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
