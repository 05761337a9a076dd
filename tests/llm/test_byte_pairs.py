import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from beneflow.llm import byte_pairs as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    with open(PATH, "rb") as file:
        return B.from_json(file.read())


def library_ids(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check(pairs, texts):
    encoded = pairs.encode_all(pa.array(texts, pa.string()))
    assert encoded == [library_ids(text) for text in texts]
    numbers = [np.frombuffer(ids, "<u4").tolist() for ids in encoded]
    assert pairs.decode_all(encoded) == [LIBRARY.decode(ids, skip_special_tokens=False) for ids in numbers]


def test_every_kind_of_code_point(pairs):
    points = [*range(0x3000), *range(0x3000, 0xD800, 41), *range(0xE000, 0x110000, 1013)]
    check(pairs, [f"a{c}b 1{c}{c} .{c} {c}" for c in map(chr, points)])


PARTS = ["a", "The", " ", "  ", "\n", "\t", "'s", "'ll", "'", "19", "é", "中", "😀", ".", "--", "<|endoftext|>", "<|end", "　", "\x85", "\x1c", "ing", "\r\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), min_size=1, max_size=5))
def test_mixed_texts(pairs, texts):
    check(pairs, texts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_any_text(pairs, text):
    check(pairs, [text])


@pytest.mark.parametrize("run", [" ", "\n", "a", "7", "-=", "中", "ab cd "])
def test_long_runs_and_cuts_between_segments(pairs, run):
    check(pairs, ["x", run * (1_300_000 // len(run)) + "y", "", run * 300])


def test_long_random_fragments(pairs):
    rng = random.Random(3)
    check(pairs, ["".join(rng.choice("abcdeht") for _ in range(n)) for n in (255, 256, 257, 5_000, 200_000)])


def test_no_token_reaches_over_a_forced_cut(pairs):
    for token in pairs.tokens:
        raw = np.frombuffer(token, np.uint8)
        assert pairs.joined[raw[:-1], raw[1:]].all()
    data = np.frombuffer("zq—xw the 12ab".encode(), np.uint8)
    assert len(pairs.fragment_starts(data, np.array([0, len(data)]))) > len(LIBRARY.pre_tokenizer.pre_tokenize_str("zq—xw the 12ab"))


def test_equal_hashes_are_compared_byte_by_byte(monkeypatch):
    monkeypatch.setattr(B, "mix", lambda hashes: hashes * np.uint64(0))
    data = np.frombuffer(b"abcdabab", np.uint8)
    which, examples = B.same_bytes(data, np.array([0, 2, 4, 6]), np.array([2, 4, 6, 8]))
    assert which.tolist() == [0, 1, 0, 0] and examples.tolist() == [0, 1]


def test_tables(spark, folder):
    schema = "doc_id bigint, text string, ids string, n_tokens int"
    rows = [(1, "Hello wörld", "x", 1), (1, "Hello wörld", "x", 1), (None, "a<|endoftext|>b", None, None), (3, None, None, None), (4, "", None, None)]
    df = spark.createDataFrame(rows, schema)
    found = sorted(B.digests(df, PATH).collect(), key=str)
    want = [(i, len(library_ids(t or "")) // 4, hashlib.sha256(library_ids(t or "")).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    back = B.decode(B.encode(df, PATH), PATH).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, t or "")) for i, t, *_ in rows)
    assert B.digests(spark.createDataFrame([], schema), PATH).collect() == []


def test_query_equals_the_library(spark, folder):
    from beneflow.llm.queries import op12_byte_pairs

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op12_byte_pairs(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library_ids(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
