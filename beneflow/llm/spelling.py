"""Spelling variants: words one edit apart, found by pivotal grams, and the form each word stands for.

Words are runs of letters with A-Z lower-cased. Two words are near if one inserted, deleted or replaced code
point makes one the other. Near words are found without comparing all words:

* The bigrams of a word, each with its place, are ordered by how many words hold them, rarest first. The first
  three are its prefix. Of these, two that do not overlap are its pivots, chosen by dynamic programming so
  that as few words as possible hold them.
* One edit cannot touch both pivots. So of two near words, the one whose prefix ends earlier in the order has a
  pivot that is in the other's prefix, at the same place or moved by the edit; what one edit can move is known
  from the two lengths. Pivots are joined with prefixes on bigram, length and place, all three equal.
* What meets is verified by its edit distance within the join, so only near words leave it.

A word's form is its most frequent near word if that is at least twice as frequent; following forms to the
last gives its root. Forms grow in frequency, so there are no cycles, and following doubles its step each round.

Bigrams are at most 8,100, as words are of 90 letters; nothing else is broadcast or reaches the driver. Words
are counted within tasks before they are shuffled, so a word that makes a third of the corpus is one row a task.

Defined results: a null or empty text has no words; a null id is written as nothing before the colon; repeated
rows count as often; words may be of any length. An empty table has no words. Other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps
from beneflow.llm.words import slices

# Letters after lower-casing, one typo in so many words, the least length and count of a word.
LETTERS = "a-zÀ-ÿ"
TYPO_ONE_IN = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

EDITS = 1
GRAM = 2
# Words a task counts before it passes them on.
COUNTED_AT_ONCE = 1 << 18


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", typo_one_in: int | None = TYPO_ONE_IN) -> DataFrame:
    """word, n: words of ``LEAST_LENGTH`` letters or more that occur ``LEAST_COUNT`` times or more.

    Where the checksum of id and word is divisible by ``typo_one_in``, the word lost a letter; None takes
    all words as they are.
    """
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")

    def words_of(own: bytes, raw: bytes) -> Iterator[tuple[str, int]]:
        for word, n in Counter(runs.findall(raw.lower().decode())).items():
            if typo_one_in is not None:
                h = crc32(word.encode(), own)
                if h % typo_one_in == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < LEAST_LENGTH:
                        continue
            yield word, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        for batch in batches:
            for part in slices(batch):
                # bytes.lower changes A to Z and nothing else.
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for own, raw in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    if raw:
                        for word, n in words_of(crc32(f"{'' if own is None else own}:".encode()), raw):
                            counts[word] = counts.get(word, 0) + n
                if len(counts) >= COUNTED_AT_ONCE:
                    yield out()
                    counts = {}
        if counts:
            yield out()

    chosen = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counted = chosen.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the order, and number of words, of every bigram."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - GRAM + 1))
    grams = words.select("word", at.alias("at")).select(F.expr(f"substring(word, at, {GRAM})").alias("gram"))
    counted = grams.groupBy("gram").agg(F.count("*").alias("n")).collect()
    ordered = sorted((row["n"], row["gram"]) for row in counted)
    return {gram: (place, n) for place, (n, gram) in enumerate(ordered)}


def pivots(grams: list[tuple[int, int]], edits: int = EDITS) -> list[int]:
    """Of (place, cost) ordered by place, the ``edits + 1`` that do not overlap and cost least, by number.

    cheapest[j][i] is the least cost of j grams among the first i; a gram joins those that end before it.
    """
    n, most = len(grams), float("inf")
    cheapest = [[0.0] * (n + 1)] + [[most] * (n + 1) for _ in range(edits + 1)]
    fits = [sum(1 for place, _ in grams[:i] if place + GRAM <= grams[i][0]) for i in range(n)]
    for j in range(1, edits + 2):
        for i in range(1, n + 1):
            cheapest[j][i] = min(cheapest[j][i - 1], cheapest[j - 1][fits[i - 1]] + grams[i - 1][1])
    chosen, i = [], n
    for j in range(edits + 1, 0, -1):
        while cheapest[j][i] == cheapest[j][i - 1]:
            i -= 1
        chosen.append(i - 1)
        i = fits[i - 1]
    return chosen[::-1]


SIGNATURE = "word string, length int, last int, pivot boolean, gram int, at int"


def signatures(words: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """A row for each pivot of a word, and one for each gram of its prefix.

    The last prefix gram counts wherever the word holds it, as any of its places may be the one that
    an edit leaves.
    """
    sent = words.sparkSession.sparkContext.broadcast(order)

    def of(word: str) -> Iterator[tuple[bool, int, int, int]]:
        known = sent.value
        grams = sorted((known[word[i : i + GRAM]][0], i) for i in range(len(word) - GRAM + 1))
        prefix = grams[: GRAM * EDITS + 1]
        last = prefix[-1][0]
        by_place = sorted((i, known[word[i : i + GRAM]][1], gram) for gram, i in prefix)
        for k in pivots([(i, cost) for i, cost, _ in by_place]):
            yield True, by_place[k][2], by_place[k][0], last
        for gram, i in grams:
            if gram > last:
                break
            yield False, gram, i, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(word, len(word), last, pivot, gram, at) for word in batch.column("word").to_pylist() for pivot, gram, at, last in of(word)]
            if rows:
                names = [part.split()[0] for part in SIGNATURE.split(", ")]
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return words.select("word").mapInArrow(run, SIGNATURE)


# What one edit does to the length of a word and to the place of a gram it leaves: replaced; inserted behind or
# before it; deleted behind or before it.
MOVES = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def near_words(signed: DataFrame) -> DataFrame:
    """word, near: every two words that one edit tells apart, both ways round."""
    moves = F.explode(F.array(*(F.struct(F.lit(a).alias("longer"), F.lit(b).alias("moved")) for a, b in MOVES)))
    held = signed.filter("pivot").select("word", "gram", "last", "length", "at", moves.alias("move")).select(
        "word", "gram", F.col("last").alias("own_last"), (F.col("length") + F.col("move.longer")).alias("length"),
        (F.col("at") + F.col("move.moved")).alias("at"),
    )
    index = signed.filter("NOT pivot").select(F.col("word").alias("near"), "gram", "last", "length", "at")
    # Spark sizes both sides by the words' file, not by the rows made of them, and would broadcast far too much.
    met = held.join(
        index.hint("merge"),
        (held["gram"] == index["gram"]) & (held["length"] == index["length"]) & (held["at"] == index["at"])
        & (F.col("own_last") <= F.col("last")) & (F.col("word") != F.col("near"))
        & (F.levenshtein("word", "near", 1) == 1),
    ).select("word", "near")
    both = met.select(F.explode(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))).alias("pair"))
    return both.select("pair.*").distinct()


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n: near words counted, and the one a word is a variant of."""
    # A row for every word: joined by a shuffle, as its file says little of its size in memory.
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    counted = near.join(known, "near").groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(counted, "word", "left")
    frequent = -F.col("best.less") >= 2 * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame, steps: Steps) -> DataFrame:
    """word, root of words that have a form; each round's table is stored."""
    linked = steps.keep(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots-0")
    # A form is twice as frequent, so a chain of words is at most 63 long, and six rounds double past that.
    number = 0
    while True:
        ahead = linked.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = linked.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        number += 1
        linked = steps.keep(step, f"roots-{number}")
        moved = linked.filter("moved").limit(1).count()
        linked = linked.drop("moved")
        if not moved:
            return linked


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", typo_one_in: int | None = TYPO_ONE_IN) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words."""
    steps = Steps(docs.sparkSession, "spelling")
    words = steps.keep(counted_words(docs, doc_id, text, typo_one_in), "words")
    near = steps.keep(near_words(signatures(words, gram_order(words))), "near")
    formed = steps.keep(forms(words, near), "forms")
    out = formed.join(roots(formed, steps), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def groups(variants: DataFrame) -> DataFrame:
    """variants of each root, most frequent first, with their number; words without any are left out."""
    by_root = Window.partitionBy("root")
    return variants.withColumn("size", F.count("*").over(by_root)).filter("size > 1").select("root", "word", "n", "size")
