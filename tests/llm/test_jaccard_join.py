import random

import pytest

from beneflow.llm import jaccard_join as J
from beneflow.llm.frames import Steps

SCHEMA = "doc_id bigint, text string, cls string, n int, component_id string"


def split(text):
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in
            "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def shingle_set(text, size=3):
    w = split(text)
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def brute(rows, percent):
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    out = []
    for i, r in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((r[0], len(sets[i]), r[0] if not sets[i] else min(same, default=None)))
    return sorted(out, key=str)


def corpus():
    """Families round a text, each copy with a few words changed; one family is large, some texts share a passage."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts = [None, "", " \n", "one", "One", "one two", "two one", "one two three", "é ü x y", passage, passage.upper()]
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice([12, 40, 90, 150]))
        for _ in range(90 if family == 0 else rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words[rng.randrange(3):]) + (" " + passage if family % 3 == 1 else ""))
    texts += [" ".join(rng.choices(vocabulary, k=60)) + " " + passage for _ in range(60)]
    texts.append(" ".join(rng.choices(vocabulary, k=30_000)))
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (3, texts[20], None, None, None), (None, texts[30], None, None, None), (None, "without any id", None, None, None),
            (40, texts[40], "x", 1, "y")]


@pytest.mark.parametrize(("percent", "small"), [(90, False), (90, True), (60, True)])
def test_equals_brute_force(spark, monkeypatch, percent, small):
    if small:
        for name, value in (("GROUP_TOKENS", 500), ("GROUP_CLASSES", 5), ("CHUNK_TOKENS", 700), ("CHUNK_VISITORS", 6)):
            monkeypatch.setattr(J, name, value)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = J.similar_classes(df, percent=percent).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, percent)
    if percent == 90:
        kept = J.one_of_each(df)
        assert kept.columns == df.columns
        ids = [r.doc_id for r in kept.collect()]
        # Id 3 stands for two texts, neither of which copies the other.
        first = {d for d, _, c in brute(rows, percent) if d is not None and d == c}
        assert sorted(i for i in ids if i is not None) == sorted([*first, 3])


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (3, 60), (5, 80)])
def test_connecting_links_give_the_same_components(spark, monkeypatch, size, percent):
    """Small groups, so that families are connected by first visits; with and without the numbers of links."""
    for name, value in (("GROUP_TOKENS", 500), ("GROUP_CLASSES", 4), ("CHUNK_TOKENS", 700), ("CHUNK_VISITORS", 6)):
        monkeypatch.setattr(J, name, value)
    df = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    found = J.similar_classes(df, size=size, percent=percent).collect()
    every = J.similar_classes(df, size=size, percent=percent, counts=True).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, every), key=str)


def test_visits_of_a_family_grow_in_proportion(spark, monkeypatch):
    """Near copies of one text, each with one word changed: all are one component."""
    rng, made, keep = random.Random(4), [], Steps.keep

    def counting(self, df, name):
        kept = keep(self, df, name)
        if name in ("first-visits", "visits"):
            made[-1] += kept.count()
        return kept

    monkeypatch.setattr(Steps, "keep", counting)
    base = [f"w{i}" for i in range(200)]
    for copies in (1000, 2000):
        rows = []
        for i in range(copies):
            words = list(base)
            words[rng.randrange(200)] = f"x{i}"
            rows.append((i, " ".join(words)))
        made.append(0)
        found = J.similar_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
        assert {r.component_id for r in found.collect()} == {0}
    assert made[0] < 3 * 1000 and made[1] < 3 * 2000


def test_empty_table(spark):
    assert J.similar_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_least_overlap():
    assert [J.least_overlap(n, m) for n, m in ((10, 10), (9, 10), (10, 9), (19, 19))] == [10, 9, 9, 18]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 999)], "a bigint, b bigint")
    roots = {r.node: r.root for r in J.components(edges, Steps(spark, "chain")).collect()}
    assert {roots[i] for i in range(201)} == {0} and roots[1000] == roots[999] == 999


@pytest.mark.parametrize(("size", "percent", "small"), [(3, 90, False), (3, 90, True), (3, 60, True), (5, 80, True)])
def test_all_links_and_their_counts(spark, monkeypatch, size, percent, small):
    if small:
        for name, value in (("GROUP_TOKENS", 500), ("GROUP_CLASSES", 5), ("CHUNK_TOKENS", 700), ("CHUNK_VISITORS", 6)):
            monkeypatch.setattr(J, name, value)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    least = {}
    for doc_id, text, *_ in rows:
        own = frozenset(shingle_set(text, size))
        least[own] = min((i for i in (least.get(own), doc_id) if i is not None), default=None)
    sets = [s for s in least if s]
    expected = [(a, b) for i, a in enumerate(sets) for b in sets[:i] if 100 * len(a & b) >= percent * len(a | b)]
    pairs = J.similar_pairs(df, size=size, percent=percent).collect()
    assert len({frozenset((r.class_a, r.class_b)) for r in pairs}) == len(pairs)
    in_order = lambda links: sorted((sorted(x, key=str) for x in links), key=str)
    assert in_order((r.id_a, r.id_b) for r in pairs) == in_order((least[a], least[b]) for a, b in expected)

    of_set = {s: sum(s in link for link in expected) for s in least}
    found = J.similar_classes(df, size=size, percent=percent, counts=True).collect()
    assert sorted(((r.doc_id, r.n_links) for r in found), key=str) == sorted(
        ((r[0], of_set[frozenset(shingle_set(r[1], size))]) for r in rows), key=str
    )
    named = [(r.doc_id, r.class_id) for r in found if r.n_shingles]
    assert sorted(named, key=str) == sorted(((r[0], least[s]) for r in rows if (s := frozenset(shingle_set(r[1], size)))), key=str)
    of_component = {}
    for links, own in {r["class"]: (r.component_links, r) for r in found if r["class"] is not None}.values():
        of_component.setdefault((own.component_id, links), []).append(own.n_links)
    assert all(sum(own) == 2 * links for (_, links), own in of_component.items())


def test_one_of_each_decides_by_row(spark):
    """Repeated ids with other texts, a null id that copies a kept text, clashing names, texts without words."""
    a, b, c = ("alpha one two three four five six", "beta one two three four five six", "gamma one two three four five six")
    rows = [(1, a, 0, "x"), (1, b, 1, "x"), (2, c, 2, "x"), (None, c, 3, "x"), (None, None, 4, "x"), (5, "", 5, "x"), (5, "", 6, "x"),
            (9, a, 7, "x"), (None, "only here one two three", 8, "x"), (None, "only here one two three", 8, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, class bigint, _stays string").repartition(3)
    kept = J.one_of_each(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    found = sorted(((r.doc_id, r.text, r["class"]) for r in kept.collect()), key=str)
    assert found == sorted([(1, a, 0), (1, b, 1), (2, c, 2), (None, None, 4), (5, "", 5), (5, "", 6), (None, "only here one two three", 8)], key=str)
    again = sorted(((r.doc_id, r.text, r["class"]) for r in J.one_of_each(df.repartition(7)).collect()), key=str)
    assert again == found
    assert J.one_of_each(df.limit(0)).collect() == []
