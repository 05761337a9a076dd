from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beneflow.llm import mixing as M


def highest_quotients(votes, seats, most):
    """Seats one by one to the highest quotient."""
    out = [0] * len(votes)
    for _ in range(seats):
        open_ones = [i for i, v in enumerate(votes) if v > 0 and out[i] < most[i]]
        if not open_ones:
            break
        out[max(open_ones, key=lambda i: (votes[i] / (2 * out[i] + 1), -i))] += 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 200))
def test_sainte_lague(parties, seats):
    votes, most = [float(v) for v, _ in parties], [m for _, m in parties]
    assert M.sainte_lague(votes, seats, most) == highest_quotients(votes, seats, most)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=12))
def test_targets(sizes):
    aims = M.targets(sizes)
    assert all(a <= 3 * s + 1e-6 for a, s in zip(aims, sizes, strict=True))
    assert sum(aims) == pytest.approx(sum(sizes))
    level = max((a / (1 + i % 3) for i, (a, s) in enumerate(zip(aims, sizes, strict=True)) if a < 3 * s), default=0)
    for i, (a, s) in enumerate(zip(aims, sizes, strict=True)):
        assert a == pytest.approx(min(3 * s, level * (1 + i % 3))) or a == 3 * s


SCHEMA = "doc_id bigint, text string, source string, size string, key int, src int"


def test_mixed_texts_follow_the_plan(spark):
    docs = [(i, " ".join(f"w{i}_{j}" for j in range(i % 90)), f"s{i % 3}", "x", 1, 2) for i in range(300)]
    docs += [(None, "null id here", "s1", None, None, None), (7, "again\t with  spaces", None, None, None, None),
             (400, None, "s1", None, None, None), (401, "", "empty", None, None, None),
             (5, docs[5][1], docs[5][2], "x", 1, 2), (402, "long " * 40_000, "s2", None, None, None)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    plan = M.plan(df, block_words=16, bucket_words=500, shards=4).collect()
    assert len(plan) == len(docs)
    assert Counter((r.doc_id, r.size) for r in plan) == Counter((d[0], len((d[1] or "").split())) for d in docs)
    by_source = defaultdict(lambda: [0, 0, 0.0])
    source_of = {(d[0], len((d[1] or "").split())): d[2] for d in docs}
    for r in plan:
        assert 0 <= r.taken <= 3 * r.size
        own = by_source[source_of[(r.doc_id, r.size)]]
        own[0] += r.size
        own[1] += r.taken
        own[2] = r.target
    for size, taken, target in by_source.values():
        assert abs(taken - target) <= 32 + 0.02 * size
    rows = M.mixed(df, block_words=16, bucket_words=500, shards=4)
    assert rows.columns == df.columns
    words = Counter()
    for r in rows.collect():
        words[(r.doc_id, r.source)] += len(r.text.split())
        whole = {d[1] for d in docs if d[0] == r.doc_id and d[2] == r.source}
        assert any(r.text in t for t in whole)
    expected = Counter()
    for r in plan:
        expected[(r.doc_id, source_of[(r.doc_id, r.size)])] += r.taken
    assert words == +expected
    again = M.plan(df.repartition(7), block_words=16, bucket_words=500, shards=4).collect()
    shown = lambda rows: Counter((r.doc_id, r.size, r.taken) for r in rows)
    assert shown(again) == shown(plan)


def test_empty_and_wordless(spark):
    assert M.plan(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = M.plan(spark.createDataFrame([(1, "  ", "s", None, None, None)], SCHEMA)).collect()
    assert (row.size, row.target, row.taken) == (0, 0.0, 0)


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_SOURCES", 3)
    df = spark.createDataFrame([(i, "a", str(i), "", 1, 1) for i in range(5)], SCHEMA)
    with pytest.raises(ValueError):
        M.plan(df)


def test_small_sources_meet_their_targets(spark):
    """With the parameters of the query: sources of 50 to 2,000 words beside large ones."""
    sizes = {"a": 50, "b": 200, "c": 600, "d": 1000, "e": 2000, "f": 30_000, "g": 40_000, "h": 3}
    docs = []
    for source, size in sizes.items():
        each = 1 if size < 10 else 10 if size <= 2000 else 100
        docs += [(len(docs) + i, " ".join(["w"] * each), source, None, None, None) for i in range(size // each)]
    by_source = {}
    for r in M.plan(spark.createDataFrame(docs, SCHEMA)).collect():
        own = by_source.setdefault(r.source_size, [0, r.target])
        own[0] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    for size, (taken, target) in by_source.items():
        assert abs(taken - target) <= (1 if size <= 2000 else 64 + 0.01 * target), (size, taken, target)
    assert sum(taken for taken, _ in by_source.values()) == pytest.approx(sum(sizes.values()), abs=100)


def test_both_engines_agree_on_sources_of_any_size(spark, tmp_path):
    """3 to 100,000 words; targets are met to a word, whatever the size."""
    import compare
    import duckdb

    from beneflow.llm.oracle import MIXING

    docs = []
    for source, size in {"a": 3, "b": 63, "c": 200, "d": 1000, "e": 2047, "f": 2048, "g": 9_000, "h": 100_000, None: 640, "z": 0}.items():
        each = max(1, size // 50)
        docs += [(len(docs) + i, "w " * min(each, size - i * each), source) for i in range(-(-size // each) if size else 2)]
    docs += [(None, "same id", "c"), (None, "other text", "c"), (4, "again", "g")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    df.coalesce(1).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    plan = M.plan(df).select("doc_id", "size", "source_size", "target", "taken")
    assert compare.difference(plan, connection, MIXING) is None
    by_source = {}
    for r in plan.collect():
        own = by_source.setdefault((r.source_size, r.target), [0])
        own[0] += r.taken
    assert all(abs(taken - target) <= 1 for (_, target), (taken,) in by_source.items())


def test_rows_without_ids_or_words_are_spread(spark):
    df = spark.createDataFrame([(None, f"text number {i}", "s", i) for i in range(3_000)], "doc_id bigint, text string, source string, _piece int")
    plan = M.plan(df, bucket_words=50, carry=True)
    assert sum(r.taken for r in plan.collect()) == 9_000
    rows = M.mixed(df, bucket_words=50)
    assert rows.columns == df.columns and rows.count() >= 3_000
