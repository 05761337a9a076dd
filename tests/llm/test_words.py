import random

import numpy as np
import pyarrow as pa
import pytest

from beneflow.llm import words as W


@pytest.mark.parametrize("segment", [1 << 20, 64])
def test_words_and_hashes(monkeypatch, segment):
    monkeypatch.setattr(W, "SEGMENT", segment)
    W._tables.cache_clear()
    rng = random.Random(segment)
    pieces = ["a", "Bb", "éé", " ", "\n", " ", "\t", "x" * 100, "0", "-", "ß"]
    texts = [None, "", " ", "a" * 500] + ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(80)]
    for batch in (pa.array(texts), pa.array(texts).slice(5, 20), pa.array(texts, pa.large_string())):
        found = W.words(batch)
        own = [(t or "").encode().lower().split() for t in batch.to_pylist()]
        shown = [found.data[s:e].tobytes().lower() for s, e in zip(found.starts, found.ends, strict=True)]
        assert shown == [w for ws in own for w in ws]
        assert found.counts.tolist() == [len(ws) for ws in own]
        by_word = {}
        for word, h in zip(shown, found.hashes.tolist(), strict=True):
            assert by_word.setdefault(word, h) == h
        assert len(set(by_word.values())) == len(by_word)
    W._tables.cache_clear()


def test_shingles():
    texts = ["a b c d a b c", "a b", "b a", "a", "", None, "A B C", "a b c a b c"]
    hashes, first = W.shingles(W.words(pa.array(texts)), 3)
    sets = [tuple(hashes[first[i] : first[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == [4 + 0, 1, 1, 1, 0, 0, 1, 3]
    assert sets[1] != sets[2] and set(sets[6]) < set(sets[0])
    assert all(list(s) == sorted(s) for s in sets)
    # The same in a slice on its own.
    alone, _ = W.shingles(W.words(pa.array(texts[:1])), 3)
    assert tuple(alone.tolist()) == sets[0]


def test_slices():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (5, 50, 0, 7, 200, 1)]), "i": pa.array(range(6))})
    parts = list(W.slices(batch, size=60))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(6))
    assert len(parts) == 4 and np.all([p.num_rows for p in parts])
