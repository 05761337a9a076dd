import numpy as np
import pytest
from pyspark.sql import functions as F

from beneflow.llm.exact_top_k import exact_top_k

SCHEMA = "vec_id bigint, embedding array<float>, rank int, score string"


def brute(rows, k, is_query):
    clean = [
        (i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(int))
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = set()
    for i, q in clean:
        if not is_query(i):
            continue
        scored = sorted((-int(q @ v), j) for j, v in clean if j != i and len(v) == len(q))[:k]
        out |= {(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)}
    return out


def run(spark, rows, k, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = exact_top_k(df, F.col("vec_id") % 5 == 0, k=k, **options).collect()
    assert len(found) == len(set(map(tuple, found)))
    return set(map(tuple, found))


def test_ties_nulls_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    # Few distinct values, so that many scores tie.
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 8], i, "own") for i in range(400)]
    rows += [(1000, None, None, None), (1005, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1, ""), (1010, [], 1, ""), (1015, [1.0, 2.0], 1, ""),
             (1016, [1.0, -2.0], 1, ""), (1020, [float("nan")] * 6, 1, ""), (1025, [float("inf")] * 6, 1, ""),
             (None, [1.0] * 6, 1, "")]
    expected = brute(rows, 7, lambda i: i % 5 == 0)
    assert run(spark, rows, 7) == expected
    assert run(spark, rows, 7, shard_rows=50, leaf_rows=4, query_block=20) == expected


def test_fewer_candidates_than_k(spark):
    rows = [(i, [float(i), 1.0], None, None) for i in range(6)]
    assert run(spark, rows, 20) == brute(rows, 20, lambda i: i % 5 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**24 + i), float(2**23 - i), 1.0], None, None) for i in range(30)]
    assert run(spark, rows, 4) == brute(rows, 4, lambda i: i % 5 == 0)


def test_scores_beyond_doubles(spark):
    """Odd scores above 2^53 keep their last bit, and neighbours keep their order."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(2.0**21), float(1 + 2 * (i % 7)) / 64, float(rng.integers(-3, 4)) / 64], None, None) for i in range(200)]
    expected = brute(rows, 6, lambda i: i % 5 == 0)
    assert all(score > 2**53 for *_, score in expected) and any(score % 2 for *_, score in expected)
    assert run(spark, rows, 6) == expected
    assert run(spark, rows, 6, shard_rows=30, leaf_rows=4, query_block=10) == expected


def test_scores_beyond_64_bits_are_refused(spark):
    rows = [(i, [float(2.0**40), 1.0], None, None) for i in range(10)]
    with pytest.raises(Exception, match="64 bits"):
        run(spark, rows, 2)


def test_empty_table(spark):
    assert run(spark, [], 5) == set()
