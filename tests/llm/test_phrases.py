import random
import re
from collections import Counter

import pytest

from beneflow.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, support, most):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    f = {key: a for key, a in f.items() if a >= support}
    covered = {(lang, w[i : i + m]) for (lang, w), a in f.items() for m in range(2, len(w)) for i in range(len(w) - m + 1)
               if a >= f[lang, w[i : i + m]]}
    rows = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and (lang, w) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, own in rows.items() for rank, (score, a, p, l, r) in enumerate(sorted(own)[:most], 1)
    )


SCHEMA = "text string, lang string, doc_id bigint, phrase string, hash int"


def table(spark, docs, parts):
    return spark.createDataFrame([(t, lang, 1, "p", 2) for t, lang in docs], SCHEMA).repartition(parts)


def made(seed, n):
    rng = random.Random(seed)
    common = ["the", "of", "A", "x1", "né", "ÿ\x01", "%"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words += rng.choice([["New", "york", "City"], ["new", "york"], ["in", "the", "end", "of", "time"], [rng.choice(common)], [f"w{rng.randrange(400)}"]])
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "; "]) for w in words)
        docs.append((text, rng.choice(["en", "EN", "de", None, "und", ""])))
    return [*docs, (None, "en"), ("", "de"), (None, None), docs[0], docs[0]]


@pytest.mark.parametrize(("parts", "run_words"), [(1, 2_000_000), (7, 300), (40, 50)])
def test_equals_brute_force(spark, monkeypatch, parts, run_words):
    monkeypatch.setattr(P, "RUN_WORDS", run_words)
    monkeypatch.setattr(P, "COUNTED_WORDS", run_words)
    monkeypatch.setattr(P, "KEPT", 300)
    docs = made(5, 400)
    out = P.mine(table(spark, docs, parts), support=12, most=40)
    want = brute(docs, 12, 40)
    assert sorted(map(tuple, out.collect())) == want and len(want) > 60


def test_one_long_text_is_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(P, "RUN_WORDS", 500)
    monkeypatch.setattr(P, "COUNTED_WORDS", 400)
    rng = random.Random(2)
    docs = [(" ".join(rng.choice(["a", "b", "c d e", "f"]) for _ in range(20_000)), "en"), ("a b " * 9_000, "en")]
    assert sorted(map(tuple, P.mine(table(spark, docs, 1), support=30, most=300).collect())) == brute(docs, 30, 300)


def test_shards_with_most_words_elsewhere(spark):
    """One shard holds nearly everything; a phrase spread over the others is found too."""
    docs = [("big one " * 5_000, "en")] + [("rare pair", "en")] * 30
    assert sorted(map(tuple, P.mine(table(spark, docs, 30), support=25).collect())) == brute(docs, 25, 2000)


def test_empty(spark):
    assert P.mine(table(spark, [], 1)).collect() == []
    assert P.mine(table(spark, [(None, None), ("", "en"), (" .\n", "en")], 1)).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    frequent = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big - 7), ("en", "a b", 2, big - 9), ("en", "b c", 2, 100), ("en", "c", 1, 101)],
        "lang string, phrase string, words int, a bigint",
    )
    totals = spark.createDataFrame([("en", 900_000_000_000_000)], "lang string, n bigint")
    rows = {r.phrase: r for r in P.collocations(frequent, totals).collect()}
    n = 900_000_000_000_000
    assert rows["a b"].score == 1000 * (big - 9) * n // (big * (big - 7))
    assert rows["b c"].score == 1000 * 100 * n // ((big - 7) * 101)


def test_filter_has_no_false_negatives(spark):
    rng = random.Random(4)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(30_000)]
    bloom = P.bloom_filter(spark.createDataFrame([(h,) for h in hashes], "hash bigint"), P.bloom_bits(len(hashes)))
    import numpy as np

    assert P._holds(bloom, np.array(hashes, np.int64).view(np.uint64)).all()
    others = np.array([rng.getrandbits(64) for _ in range(30_000)], np.uint64)
    assert P._holds(bloom, others).mean() < 0.05


def test_longer_phrases_need_frequent_parts(spark, monkeypatch):
    """Frequent pairs, no frequent triples: no shard counts four or five words in a row."""
    counted, plain = [], P.shard_counts

    def spy(docs, known, lengths, longest):
        out = plain(docs, known, lengths, longest)
        if lengths[-1] >= 4:
            counted.append(out.count())
        return out

    monkeypatch.setattr(P, "shard_counts", spy)
    rng = random.Random(6)
    docs = [(" ".join(f"v{rng.randrange(20)}" for _ in range(200)), "en") for _ in range(100)]
    assert sorted(map(tuple, P.mine(table(spark, docs, 1), support=12).collect())) == brute(docs, 12, 2000)
    assert counted and sum(counted) < 100


def test_shard_counts_are_passed_on_in_bounded_batches():
    """A run's counts of one length leave the task a bounded batch at a time, all of them, in order."""
    import numpy as np

    found, counts = np.arange(10, 110, dtype=np.uint64), np.arange(100, dtype=np.int64)
    names = np.array(["en", "de"], dtype=object)
    batches = list(P._shard_batches(3, found, counts, lambda some: names[np.arange(100)[some] % 2], 7))
    assert max(b.num_rows for b in batches) == 7 and sum(b.num_rows for b in batches) == 100
    assert [h for b in batches for h in b.column("hash").to_pylist()] == list(range(10, 110))
    assert [x for b in batches for x in b.column("lang").to_pylist()] == ["en", "de"] * 50
    assert {x for b in batches for x in b.column("shard").to_pylist()} == {3}
    unnamed = list(P._shard_batches(0, found, counts, None, 7))
    assert all(b.column("lang").null_count == b.num_rows for b in unnamed)


def test_small_batches_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "WRITTEN", 5)
    docs = made(8, 300)
    assert sorted(map(tuple, P.mine(table(spark, docs, 3), support=12, most=40).collect())) == brute(docs, 12, 40)
