"""Quality by a sparse rule ensemble over text statistics.

Statistics are Spark expressions, taken in one pass over the texts and stored. Shallow trees of a random
forest are grown on the labelled rows; every node's path from the root is a conjunctive rule of bounds on
statistics. A logistic model with lasso penalty gives the rules weights, most of them 0, and the rest are
compiled back into one Spark expression, so scoring runs no Python.

All of training runs in Spark on all labelled rows; the driver sees trees and weights.

Defined results: a null or empty text has all statistics 0 and is scored by the rules that hold for it. A
null label is no label; a document labelled or stored twice counts as often. With labels of one class only
every score is that class, without labels one half.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps, stored

TREES = 24
DEPTH = 3
LASSO = 5e-4
THRESHOLD = 0.3
SEED = 11


def statistics(text: Column) -> dict[str, Column]:
    """Measures of a text that is not null; shares are of its characters, words or lines."""
    chars = F.length(text)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x != "")
    left = lambda other: F.length(F.regexp_replace(text, other, ""))  # noqa: E731  characters outside a class
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    return {
        "chars": chars.cast("double"),
        "words": F.size(words).cast("double"),
        "lines": F.size(lines).cast("double"),
        "word_length": share(left(r"[\x20\x09-\x0D]+"), F.size(words)),
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)).cast("double"),
        "short_words": share(F.size(F.filter(words, lambda w: F.length(w) <= 2)), F.size(words)),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_length": share(chars, F.size(lines)),
        "capitals": share(left("[^A-Z]+"), chars),
        "digits": share(left("[^0-9]+"), chars),
        "sentence_ends": share(left("[^.!?]+"), chars),
        "commas": share(left("[^,;:]+"), chars),
        "other_signs": share(left(r"[A-Za-z0-9\x20\x09-\x0D.,;:!?\x{80}-\x{10FFFF}]+"), chars),
        "beyond_ascii": share(left(r"[\x00-\x7F]+"), chars),
    }


NAMES = (
    "chars", "words", "lines", "word_length", "longest_word", "short_words", "distinct_words", "distinct_lines",
    "line_length", "capitals", "digits", "sentence_ends", "commas", "other_signs", "beyond_ascii",
)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, one column per statistic) of every row, stored."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stored(chosen.select("doc_id", *[c.alias(n) for n, c in statistics(F.col("text")).items()]), "statistics")


# --- rules --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics, all of which hold: (name, above, up to)."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, above, up_to in self.bounds:
            if above > -math.inf:
                holds &= F.col(name) > above
            if up_to < math.inf:
                holds &= F.col(name) <= up_to
        return holds


def _rule(path: list[tuple[int, str, float]]) -> Rule:
    """A path's conditions, those on one statistic drawn together."""
    bounds: dict[int, tuple[float, float]] = {}
    for feature, sign, value in path:
        above, up_to = bounds.get(feature, (-math.inf, math.inf))
        bounds[feature] = (above, min(up_to, value)) if sign == "<=" else (max(above, value), up_to)
    return Rule(tuple((NAMES[f], *bounds[f]) for f in sorted(bounds)))


_CONDITION = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def rules_of(tree: str) -> list[Rule]:
    """The rule of every node but the root, from a tree's printed form; indentation tells its depth."""
    out, path = [], []
    for line in tree.splitlines():
        if found := _CONDITION.match(line):
            while path and path[-1][0] >= len(found[1]):
                path.pop()
            path.append((len(found[1]), (int(found[2]), found[3], float(found[4]))))
            out.append(_rule([condition for _, condition in path]))
    return out


@dataclass(frozen=True)
class Model:
    weighted: tuple[tuple[Rule, float], ...]
    bias: float

    def score(self) -> Column:
        margin = F.lit(self.bias)
        for rule, weight in self.weighted:
            margin = margin + F.when(rule.column(), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def train(
    stats: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    doc_id: str = "doc_id",
    label: str = "quality",
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
    seed: int = SEED,
) -> Model:
    """A model of ``label`` from rows for which ``may_learn``, an expression over ``doc_id``, holds."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & may_learn)
    rows = VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(stats.join(known, "doc_id"))
    steps = Steps(stats.sparkSession, "rule-ensemble")
    try:
        return _fitted(steps.keep(rows.select("features", "label", *NAMES), "labelled"), trees, depth, lasso, seed)
    finally:
        steps.drop()


def _fitted(rows: DataFrame, trees: int, depth: int, lasso: float, seed: int) -> Model:
    counts = rows.agg(F.count("*").alias("n"), F.sum("label").alias("good")).first()
    if not counts.n:
        return Model((), 0.0)
    if counts.good in (0, counts.n):
        return Model((), math.inf if counts.good else -math.inf)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, subsamplingRate=0.5, featureSubsetStrategy="0.5", seed=seed,
        minInstancesPerNode=max(2, min(20, counts.n // 100)),
    ).fit(rows)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in rules_of(tree.toDebugString)))
    if not rules:
        return Model((), math.log(counts.good / (counts.n - counts.good)))
    holds = F.array(*[rule.column().cast("double") for rule in rules])
    lasso_rows = rows.select(array_to_vector(holds).alias("features"), "label")
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, tol=1e-5).fit(lasso_rows)
    weights = fitted.coefficients.toArray()
    return Model(tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w), float(fitted.intercept))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every measured row."""
    return stats.select("doc_id", model.score().alias("score"))
