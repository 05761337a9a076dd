"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are labels; all other texts are unlabelled and may be toxic. With class prior
``p``, the risk of calling unlabelled texts clean counts toxic ones wrongly by ``p`` times the risk of
calling the confirmed ones clean, so that part is subtracted. Where the corrected risk of a mini-batch
turns negative, the classifier is overfitting and steps back (the non-negative estimator).

A text's features are its distinct words, and the first bytes of longer words, as 64-bit hashes. Features
of at least ``MIN_POSITIVE`` confirmed texts that are enriched among them are kept; on these, linear
classifiers are trained in numpy with the logistic loss and averaged. A score of one half is put where the
same corrected risk, with the 0-1 loss, is least. Scoring is one narrow pass with the
model broadcast, at most ``MAX_FEATURES`` hashes and weights.

Sample bounds: at most ``max_positive`` confirmed and ``max_unlabelled`` other texts, those with the
smallest hash of their id. The class prior is the toxic share of all labelled rows that may be learned from.

Defined results: a null or empty text has no features and gets the score of the bias alone. Without any
confirmed text every score is 0. Repeated rows are scored alike; rows without an id are not learned from.
A null label is no label; a document labelled twice counts as toxic if one label says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps, by_slice, keep_rows, record_batch
from beneflow.llm.words import BY_LETTER, mix, shingles, slices, words

PREFIXES = (4, 5, 6, 7, 8)
MAX_POSITIVE = 3000
MAX_UNLABELLED = 8000
MAX_FEATURES = 1 << 16
MIN_POSITIVE = 3
MIN_Z = 5.0
CLASSIFIERS = 3
THRESHOLD = 0.5


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts, repeats included, and the text each is of."""
    found = words(column, BY_LETTER, PREFIXES)
    owner, lengths = found.owner, found.ends - found.starts
    hashes, owners = [found.hashes], [owner]
    for length, prefix in zip(PREFIXES, found.prefixes, strict=True):
        longer = lengths > length
        # The prefix of a word is another feature than the same word on its own.
        hashes.append(prefix[longer] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(length))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners)


def distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], owners[new]


@dataclass
class Vocabulary:
    """Sorted hashes, with a table of their low bits that rules most others out at once."""

    hashes: np.ndarray

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self._low(self.hashes)] = True

    @staticmethod
    def _low(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << 20) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature number, text) of each distinct feature of a text that is known."""
        near = self.maybe[self._low(hashes)]
        hashes, owners = hashes[near], owners[near]
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        pairs = np.unique(owners[known] * (len(self.hashes) + 1) + at[known])
        return pairs % (len(self.hashes) + 1), pairs // (len(self.hashes) + 1)


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(column), _sigmoid(self.bias))
        number, owner = self.vocabulary.find(*features(column))
        return _sigmoid(np.bincount(owner, self.weights[number], len(column)) + self.bias)


#: The model when there is nothing to learn from.
NOTHING = Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), -np.inf)


def _sigmoid(margin):
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700))) if np.any(np.isfinite(margin)) else np.zeros_like(margin)


@dataclass
class Sample:
    """Features of a number of texts: text i has ``numbers[first[i]:first[i + 1]]``."""

    numbers: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def only(self, kept: np.ndarray) -> Sample:
        """The same texts with the kept features alone, numbered anew."""
        keep = kept[self.numbers]
        return Sample(
            (np.cumsum(kept) - 1)[self.numbers[keep]], np.concatenate([[0], np.cumsum(keep)])[self.first]
        )

    def rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.first[chosen + 1] - self.first[chosen]
        at = np.repeat(self.first[chosen] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        return self.numbers[at], np.repeat(np.arange(len(chosen)), lengths)


def enriched(positive: Sample, unlabelled: Sample, n: int) -> np.ndarray:
    """Features in more confirmed texts than chance allows: at least ``MIN_Z`` deviations."""
    in_p, in_u = (np.bincount(s.numbers, minlength=n) for s in (positive, unlabelled))
    n_p, n_u = max(len(positive), 1), max(len(unlabelled), 1)
    both = (in_p + in_u + 1) / (n_p + n_u + 2)
    return (in_p / n_p - in_u / n_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u)) >= MIN_Z


def fit_one(
    positive: Sample, unlabelled: Sample, prior: float, n: int, seed: int, epochs: int = 30, rate: float = 0.1,
    decay: float = 1e-4, batch: int = 256,
) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with the logistic loss; weights and bias."""
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(n), 0.0
    first_moment, second_moment = np.zeros(n + 1), np.zeros(n + 1)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(unlabelled))
        for at in range(0, len(order), batch):
            sides = []
            for side, chosen in (
                (positive, rng.integers(0, len(positive), batch)), (unlabelled, order[at : at + batch])
            ):
                own, owner = side.rows(chosen)
                margin = np.bincount(owner, weights[own], len(chosen)) + bias
                sides.append((own, owner, margin, _sigmoid(margin) / len(chosen)))
            p, u = sides
            clean_risk = np.logaddexp(0, u[2]).mean() - prior * np.logaddexp(0, p[2]).mean()
            if clean_risk >= 0:
                # Confirmed texts are called toxic, and the corrected risk of unlabelled ones falls.
                by_margin = (-prior / batch * np.ones(batch), u[3])
            else:  # step back along the corrected part alone
                by_margin = (prior * p[3], -u[3])
            gradient = np.zeros(n + 1)
            for (own, owner, *_), d in zip(sides, by_margin, strict=True):
                gradient[:-1] += np.bincount(own, d[owner], n)
                gradient[-1] += d.sum()
            gradient[:-1] += decay * weights
            step += 1
            first_moment += 0.1 * (gradient - first_moment)
            second_moment += 0.001 * (gradient**2 - second_moment)
            move = rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second_moment / (1 - 0.999**step)) + 1e-8)
            # Enriched features speak for toxicity or not at all.
            weights = np.maximum(weights - move[:-1], 0)
            bias -= move[-1]
    return weights, bias


def best_cut(confirmed: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The margin with the least corrected 0-1 risk, in the middle of the gap it lies in.

    Above a cut, ``prior`` times the share of confirmed texts estimates the toxic share of all texts, and
    the rest of the unlabelled share is clean texts called toxic.
    """
    cuts = np.unique(np.concatenate([confirmed, unlabelled]))
    above = lambda side: 1 - np.searchsorted(np.sort(side), cuts, "left") / len(side)
    at = int(np.argmax(2 * prior * above(confirmed) - above(unlabelled)))
    return float(cuts[at] + cuts[at - 1]) / 2 if at else float(cuts[0]) - 1


def fit(hashes: np.ndarray, positive: Sample, unlabelled: Sample, prior: float, classifiers: int = CLASSIFIERS) -> Model:
    kept = enriched(positive, unlabelled, len(hashes))
    if not kept.any():
        return Model(Vocabulary(hashes[:0]), np.zeros(0), float(np.log(prior / (1 - prior))) if 0 < prior < 1 else -np.inf)
    p, u = positive.only(kept), unlabelled.only(kept)
    fitted = [fit_one(p, u, prior, int(kept.sum()), seed) for seed in range(classifiers)]
    weights, bias = np.mean([w for w, _ in fitted], axis=0), float(np.mean([b for _, b in fitted]))
    margins = []
    for side in (p, u):
        own, owner = side.rows(np.arange(len(side)))
        margins.append(np.bincount(owner, weights[own], len(side)) + bias)
    bias -= best_cut(*margins, prior)
    return Model(Vocabulary(hashes[kept]), weights, bias)


def without_copies(sample: DataFrame, chance: Column) -> DataFrame:
    """One text of near copies for each side of the sample; a copied text is one confirmation, not many.

    Copies agree in two smallest shingle hashes of four with high probability. The sample is bounded,
    so its windows are too.
    """

    def keyed(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = shingles(words(part.column("text"), BY_LETTER), 3)
        full = np.flatnonzero(np.diff(first))
        least = np.zeros((4, part.num_rows), dtype=np.uint64)
        for i in range(4 if len(full) else 0):
            least[i, full] = np.minimum.reduceat(mix(hashes + np.uint64(i * 0x632BE59BD9B4E019 & (1 << 64) - 1)), first[full])
        pairs = mix(least[::2]) + least[1::2]
        return record_batch(
            doc_id=part.column("doc_id"), positive=part.column("positive"), text=part.column("text"),
            one=pairs[0].view(np.int64), two=pairs[1].view(np.int64),
        )

    schema = f"doc_id {dict(sample.dtypes)['doc_id']}, positive boolean, text string, one bigint, two bigint"
    found = by_slice(sample, keyed, schema)
    for key in ("one", "two"):
        order = Window.partitionBy("positive", key).orderBy(chance, "doc_id")
        found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).drop("place")
    return found.select("doc_id", "positive", "text")


def train(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """A model of ``label`` from rows for which ``may_learn``, an expression over ``doc_id``, holds."""
    spark = docs.sparkSession
    chance = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & may_learn)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    counted = known.agg(F.count("*").alias("n"), F.sum(F.col("label").cast("int")).alias("toxic")).first()
    if not counted.toxic:
        return NOTHING
    prior = counted.toxic / counted.n
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("doc_id").isNotNull() & may_learn)
    picked = known.where(F.col("label") == 1).orderBy(chance, "doc_id").limit(max_positive).select("doc_id", F.lit(True).alias("positive"))
    others = texts.select("doc_id").orderBy(chance, "doc_id").limit(max_unlabelled).select("doc_id", F.lit(False).alias("positive"))
    # At most max_positive + max_unlabelled ids.
    sample = texts.join(F.broadcast(picked.union(others)), "doc_id").select("doc_id", "positive", "text")
    steps = Steps(spark, "toxicity")
    sample = steps.keep(without_copies(sample, chance), "sample")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, times = np.unique(distinct(*features(part.column("text")))[0], return_counts=True)
                yield record_batch(feature=hashes.view(np.int64), n=times.astype(np.int64))

    common = (
        sample.where("positive").select("text").mapInArrow(seen, "feature bigint, n bigint")
        .groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_POSITIVE)
        .orderBy(F.desc("n"), "feature").limit(MAX_FEATURES).toArrow()
    )
    vocabulary = Vocabulary(np.sort(np.asarray(common.column("feature").combine_chunks()).view(np.uint64)))
    sent = spark.sparkContext.broadcast(vocabulary)

    def numbered(part: pa.RecordBatch) -> pa.RecordBatch:
        number, owner = sent.value.find(*features(part.column("text")))
        first = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(first), pa.array(number.astype(np.int32)))
        return record_batch(doc_id=part.column("doc_id").cast(pa.string()), positive=part.column("positive"), numbers=lists)

    rows = by_slice(sample, numbered, "doc_id string, positive boolean, numbers array<int>").toArrow()
    steps.drop()
    rows = rows.combine_chunks().sort_by([("doc_id", "ascending")])
    sides = []
    for positive in (True, False):
        lists = rows.filter(pc.equal(rows.column("positive"), positive)).column("numbers").combine_chunks()
        first = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)), dtype=np.int64)])
        sides.append(Sample(np.asarray(pc.list_flatten(lists)), first))
    if not len(sides[0]):
        return NOTHING
    return fit(vocabulary.hashes, *sides, prior)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        return record_batch(doc_id=part.column("doc_id"), score=sent.value.scores(part.column("text")))

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return by_slice(chosen, make, "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda part: sent.value.scores(part.column(text)) < threshold, text)
