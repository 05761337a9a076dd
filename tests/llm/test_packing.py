import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from beneflow.llm import packing as P

SCHEMA = "doc_id bigint, text string, ids string, shard int, offsets string"


def best_fit_by_scan(lengths, row_length):
    """The same rule without a tree: the last row to reach the least room that holds the piece."""
    rows, room, turn, clock = [], [], [], 0
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        clock += 1
        fitting = [r for r in range(len(rows)) if room[r] >= lengths[piece] and room[r] > 0]
        if fitting:
            row = min(fitting, key=lambda r: (room[r], -turn[r]))
        else:
            row = len(rows)
            rows.append([])
            room.append(row_length)
            turn.append(0)
        rows[row].append(piece)
        room[row] -= lengths[piece]
        turn[row] = clock
    return rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing(lengths):
    rows = P.best_fit_decreasing(lengths, 20)
    assert rows == best_fit_by_scan(lengths, 20)
    assert sorted(p for row in rows for p in row) == list(range(len(lengths)))


def documents():
    rng = random.Random(1)
    words = ["the", "Zoé", "naïve", "x1", "42", "don't", "a\n\nb", "  ", "日本", "<|endoftext|>"]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 3, 30, 300]))) for _ in range(120)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    return [*rows, (200, None, None, None, None), (201, "", "", 1, ""), (None, "no id", "", 1, ""), (5, texts[5], "", 1, ""),
            (202, "long word " * 30_000, "", 1, "")]


@pytest.mark.parametrize(("row_length", "buffer"), [(64, 1 << 22), (64, 500), (2048, 1 << 22)])
def test_round_trip(spark, monkeypatch, row_length, buffer):
    monkeypatch.setattr(P, "BUFFER_TOKENS", buffer)
    docs = documents()
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    rows = P.pack(df, row_length=row_length, matrix_rows=4).collect()
    with open(P.VOCABULARY, "rb") as file:
        encoding = P.encoder(file.read(), P.PATTERN)
    pieces = defaultdict(list)
    for doc_id, offset, ids in P.unpacked(rows, row_length):
        assert 0 < len(ids) <= row_length
        pieces[doc_id].append((offset, ids.tolist()))
    expected = defaultdict(list)
    for doc_id, text, *_ in docs:
        if text:
            ids = [*encoding.encode_ordinary(text), P.END_ID]
            expected[doc_id] += [(at, ids[at : at + row_length]) for at in range(0, len(ids), row_length)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    assert len({(r.shard, r.matrix) for r in rows}) == len(rows)
    for row in rows:
        matrix = P.matrix_of(row, row_length)
        assert matrix.shape == (row.n_rows, row_length) and matrix.dtype == np.uint16
        assert row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == matrix.size
        assert row.cu_seqlens[:-1] == row.position_resets == sorted(set(row.position_resets))
        positions = P.positions_of(row)
        assert np.flatnonzero(positions == 0).tolist() == row.position_resets and positions.max() < row_length
        filling = [slice(a, b) for a, b, o in zip(row.cu_seqlens, row.cu_seqlens[1:], row.offsets, strict=False) if o is None]
        assert all((matrix.ravel()[f] == P.END_ID).all() for f in filling)


def test_whole_table_is_well_filled(spark, folder):
    from beneflow.llm.queries import op4_packing

    rows = op4_packing(spark, folder).collect()
    total = sum(r.cu_seqlens[-1] for r in rows)
    used = sum(len(ids) for _, _, ids in P.unpacked(rows))
    assert used > 0.98 * total
    ids = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").where("text <> ''").collect()}
    assert {d for r in rows for d in r.doc_ids if d is not None} == ids


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("run", [" ", "\n", "\u3000", "a", "7", "-", " \n"])
def test_runs_of_ten_million(spark, run):
    """Of any class, with text before and behind; the ids decode to the text, and short runs equal the library's."""
    with open(P.VOCABULARY, "rb") as file:
        encoding = P.encoder(file.read(), P.PATTERN)
    text = "before" + run * (10_000_000 // len(run)) + "behind  " + run * (200_000 // len(run))
    (row,) = [r for r in spark.createDataFrame([(1, text)], "doc_id bigint, text string").transform(P.pack).agg(F.sum("n_rows").alias("n")).collect()]
    ids = P.ids_of(encoding, text)
    assert encoding.decode(ids) == text and row.n == -(-(len(ids) + 1) // P.ROW_LENGTH)
    for n in (99_999, 100_000, 150_001):
        for short in (run * n, "x" + run * n, run * n + "x", "x " + run * n + " x\n"):
            assert P.ids_of(encoding, short) == encoding.encode_ordinary(short)
