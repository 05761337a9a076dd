from collections import Counter, defaultdict

import numpy as np
import plain
import pytest

import corpus_pipeline
from beneflow.llm import packing, toxicity
from beneflow.llm.frames import held_out, stored


@pytest.fixture(scope="module")
def folder():
    """The smallest tables have too few toxic labels to learn from."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Every stage's input and output, written and read as a driver would."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = stored(stage(spark, docs, folder), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert 0 < after.count()


def test_toxicity(spark, folder, stages):
    """Scores of the stage's model in plain Python; what reaches one half goes."""
    before, after = stages["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{folder}/labels.parquet"), ~held_out())
    rows = before.select("doc_id", "text").collect()
    rejected = {r.doc_id for r, s in zip(rows, plain.toxicity_scores(model, [r.text for r in rows]), strict=True) if s >= 0.5}
    assert rejected and ids(after) == sorted(r.doc_id for r in rows if r.doc_id not in rejected)


def test_near_duplicates_of_five_words(stages):
    """Pairs by their shingle sets, five words and 0.8."""
    before, after = stages["near_duplicates"]
    sets, holders, group = {}, defaultdict(list), {}
    for row in before.select("doc_id", "text").collect():
        w = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in row.text or "").split(" ")
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in w if x]
        sets[row.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def root(i):
        while group.get(i, i) != i:
            i = group[i]
        return i

    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    assert ids(after) == [i for i in sorted(sets) if root(i) == i]


def test_decontamination(spark, folder, stages):
    before, after = stages["decontamination"]
    windows = plain.benchmark_windows([r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    clean = [r.doc_id for r in before.collect() if not plain.is_contaminated(r.text, windows)]
    assert ids(after) == sorted(clean) != ids(before)


def test_mixing(stages):
    """Every text the mix gives, as often as it gives it."""
    before, after = stages["mixing"]
    expected = plain.mixture([(r.doc_id, r.source, r.text) for r in before.collect()])
    rows = after.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(expected)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_packing(stages):
    before, after = stages["packing"]
    pieces = list(packing.unpacked(after.collect()))
    with open(packing.VOCABULARY, "rb") as file:
        encoding = packing.encoder(file.read(), packing.PATTERN)
    expected = [len(encoding.encode_ordinary(r.text)) + 1 for r in before.collect()]
    assert sum(len(p) for _, _, p in pieces) == sum(expected)
    assert np.sort([d for d, offset, _ in pieces if offset == 0]).tolist() == ids(before)


def test_run_gives_the_last_stage(spark, folder, stages):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == stages["packing"][1].columns
    used = lambda df: sum(len(p) for _, _, p in packing.unpacked(df.collect()))
    assert used(rows) == used(stages["packing"][1])
