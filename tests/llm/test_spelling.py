import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beneflow.llm import spelling as S
from beneflow.llm.frames import stored


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, typos=True):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for own, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            h = crc32(f"{'' if own is None else own}:{word}".encode())
            if typos and h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 5:
                counts[word] += 1
    n = {word: k for word, k in counts.items() if k >= 3}
    form, near = {}, {w: [v for v in n if one_edit(w, v)] for w in n}
    for word, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], 0)) for w in n)


def found(df, **options):
    rows = S.spelling_variants(df, **options).collect()
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in rows)


SCHEMA = "doc_id bigint, text string, word string, n int, root string"


def family(seed, size):
    rng, words = random.Random(seed), []
    for base in ("colour", "straße", "aaaaaaa", "banana", "ÿþýüûúù", "abababab"):
        variants = [base]
        for _ in range(size):
            w, i = rng.choice(variants), rng.randrange(5)
            variants.append(rng.choice([w[:i] + rng.choice("abÿ×") + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + rng.choice("abñ") + w[i:]]))
        for i, w in enumerate(variants):
            words += [w] * rng.choice([1, 3, 3 + i % 4, 40 // (1 + i)])
    rng.shuffle(words)
    return words


def test_equals_brute_force(spark):
    words = family(1, 25)
    docs = [(i, " ".join(words[i * 20 : (i + 1) * 20])) for i in range(-(-len(words) // 20))]
    docs += [(None, "Colour, COLOUR; colour!"), (None, None), (7, ""), (7, docs[7][1]), (8, "x" * 3_000 + " " + "x" * 2_999 + "y " + "x" * 3_000),
             (9, f"{'x' * 3000} {'x' * 3000} " + ("x" * 2_999 + "y ") * 3)]
    df = spark.createDataFrame([(i, t, "w", 1, None) for i, t in docs], SCHEMA).repartition(5)
    want = brute(docs)
    assert found(df) == want and any(row[1] for row in want) and any(row[2] not in (row[0], row[1]) for row in want)
    assert found(df, typo_one_in=None) == brute(docs, typos=False)


def test_empty(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, "one two", None, None, None), (None, None, None, None, None)], SCHEMA)) == []


def test_groups(spark):
    text = "colour " * 9 + "color " * 3 + "other " * 5
    variants = S.spelling_variants(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), typo_one_in=None)
    assert sorted(tuple(r) for r in S.groups(variants).collect()) == [("colour", "color", 3, 2), ("colour", "colour", 9, 2)]


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 12), min_size=3, max_size=7), st.integers(0, 1000))
def test_pivots_are_the_cheapest_that_do_not_overlap(places, seed):
    rng = random.Random(seed)
    grams = [(place, rng.randrange(1, 9)) for place in sorted(places)]
    apart = [c for c in itertools.combinations(range(len(grams)), 2) if grams[c[1]][0] - grams[c[0]][0] >= 2]
    chosen = S.pivots(grams)
    assert tuple(chosen) in apart
    assert sum(grams[i][1] for i in chosen) == min(sum(grams[i][1] for i in c) for c in apart)


@pytest.mark.parametrize("hot", [2_000])
def test_one_word_in_most_rows_is_a_row_a_task(spark, hot):
    df = spark.createDataFrame([(i, "hundred hundred") for i in range(hot)], "doc_id bigint, text string").repartition(4)
    assert found(df) == brute([(i, "hundred hundred") for i in range(hot)])


def test_words_and_what_is_made_of_them_are_not_broadcast(spark):
    """rows made of words are many times what their file tells, so no side is sized by it."""
    words = stored(spark.createDataFrame([("gabriel", 9), ("gabriele", 3)], "word string, n bigint"), "few-words")
    near = S.near_words(S.signatures(words, S.gram_order(words)))
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in near.collect()} == {("gabriel", "gabriele"), ("gabriele", "gabriel")}
    assert "rightHint=(strategy=merge)" in S.forms(words, near)._jdf.queryExecution().optimizedPlan().toString()
