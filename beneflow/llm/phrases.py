"""Collocations: phrases of two to five words that occur often and more often than their parts let expect.

Phrases are mined by SON partitioning. Read splits are dealt over ``SHARDS`` shards, and a shard may be as many
tasks as it needs, so its share of the support does not sink as the corpus grows:

1. Each shard is mined completely, at the global support lowered to its share of all words: a phrase that
   occurs ``support`` times must reach that in some shard. Words are counted first, which gives the shares;
   then pairs of words, then each longer length in a pass of its own, only where both its parts are
   candidates already, so that what a shard counts grows with its frequent phrases, not with all of them.
2. The union of what the shards find holds every frequent phrase. Where a shard did not find a phrase, it has
   at most one less than its share; what cannot reach the support even so is left out of the union.
3. All occurrences of the union's phrases are counted exactly. What a task looks up is a Bloom filter of the
   union, of a bounded size; what that lets through by chance is counted as exactly and falls below the
   support like any other false candidate.

Counts are joined and summed by language and words, never by hash. All that follows, cuts, scores and
containment, are joins over frequent phrases. Products are decimals of 38 digits.

A text is lower-cased from A to Z, split into pieces at sentence signs and line breaks, and pieces into
words at blanks and tabs. Defined results: a null or empty text has no words; a null language is ``und``
and so one with it; repeated rows count as often; very long texts are cut into buffers between pieces, or
within one piece with the words of the longest phrase repeated, so that nothing is lost or counted twice.
An empty table has no phrases. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps
from beneflow.llm.words import _classes, mix, slices, words

# Fixed values of the splitting rule.
PIECE_SIGNS = (*b".,;:!?", *range(10, 14))
WORD_SIGNS = (9, 32)
UNKNOWN_LANG = "und"

LONGEST = 5
SUPPORT = 100
BEST = 2000
SHARDS = 10
# Words a task counts at a time, up to twice as many at last; fewer where their texts are needed too. Phrases
# whose counts a task keeps before it passes them on, and phrases written at a time.
RUN_WORDS = 2_000_000
COUNTED_WORDS = 1_000_000
KEPT = 400_000
WRITTEN = 1 << 15
# Bits of the filter for each candidate, and bits at most (64 MB).
BITS_EACH = 16
MOST_BITS = 1 << 29
PAGE_BITS = 1 << 16
_WORDS = _classes([*PIECE_SIGNS, *WORD_SIGNS])


@dataclass
class Run:
    """Words in a row: hashes that tell languages apart, and where new pieces begin."""

    hashes: np.ndarray
    new_piece: np.ndarray
    lang: np.ndarray  # number in ``langs``
    start: np.ndarray  # in ``data``, end exclusive; empty where texts are not needed
    end: np.ndarray
    data: np.ndarray
    langs: list[str]

    def cut(self, lo: int, hi: int) -> Run:
        own = slice(lo, hi)
        return Run(self.hashes[own], self.new_piece[own], self.lang[own], self.start[own], self.end[own], self.data, self.langs)


def _of_slice(part: pa.RecordBatch, langs: dict[str, int], with_text: bool) -> Run:
    found = words(part.column("text"), _WORDS)
    names = part.column("lang").to_pylist()
    own = np.array([langs.setdefault(name, len(langs)) for name in names], dtype=np.int32)
    lang = np.repeat(own, found.counts)
    signs = np.zeros(256, dtype=bool)
    signs[list(PIECE_SIGNS)] = True
    before = np.concatenate([[0], np.cumsum(signs[found.data], dtype=np.int64)])
    new = np.ones(len(found.hashes), dtype=bool)
    new[1:] = before[found.starts[1:]] > before[found.ends[:-1]]
    new[found.first[:-1][found.counts > 0]] = True
    salt = _lang_hashes(list(langs))
    hashes = mix(found.hashes ^ salt[lang]) if len(lang) else found.hashes
    text = (found.starts, found.ends, found.data) if with_text else [np.zeros(0, np.uint8)] * 3
    return Run(hashes, new, lang, *text, list(langs))


def _lang_hashes(langs: list[str]) -> np.ndarray:
    """A number per language that is the same in every task."""
    return np.frombuffer(b"".join(blake2b(name.encode(), digest_size=8).digest() for name in langs), np.uint64)


def _joined(runs: list[Run]) -> Run:
    shift = np.cumsum([0, *(len(r.data) for r in runs)])
    place = np.int32 if shift[-1] < 1 << 31 else np.int64
    cat = lambda get: np.concatenate([get(r) for r in runs])
    return Run(
        cat(lambda r: r.hashes), cat(lambda r: r.new_piece), cat(lambda r: r.lang),
        np.concatenate([(r.start + s).astype(place) for r, s in zip(runs, shift, strict=False)]),
        np.concatenate([(r.end + s).astype(place) for r, s in zip(runs, shift, strict=False)]),
        cat(lambda r: r.data), runs[-1].langs,
    )


def _runs(batches: Iterator[pa.RecordBatch], most: int, with_text: bool) -> Iterator[tuple[Run, int]]:
    """Runs of ``most`` words or more, fewer only if the whole task has fewer; each with how many of its last
    words only continue phrases and begin none, as they begin the next run."""
    langs: dict[str, int] = {}
    waiting: list[Run] = []
    for batch in batches:
        for part in slices(batch):
            waiting.append(_of_slice(part, langs, with_text))
            ends = np.cumsum([len(run.hashes) for run in waiting])
            if ends[-1] >= 2 * most:
                # Slices hold whole texts, so a run ends where a text ends; what is left makes a whole run too.
                first = int(np.searchsorted(ends, most)) + 1
                run, waiting = _joined(waiting[:first]), waiting[first:]
                yield from _bounded(run, most)
    if waiting:
        yield from _bounded(_joined(waiting), most)


def _bounded(run: Run, most: int) -> Iterator[tuple[Run, int]]:
    """Cuts a run of many times ``most`` words, which one text can give; a cut within a piece is bridged."""
    n = len(run.hashes)
    parts = max(1, n // most) if n > 4 * most else 1
    for at in range(parts):
        lo, hi = at * n // parts, (at + 1) * n // parts
        to = min(n, hi + LONGEST - 1)
        yield run.cut(lo, to), to - hi


def _levels(run: Run, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every length: the places where a phrase of it may begin, and its hash there. After each, the
    consumer sends which of these are kept; longer phrases begin only where both parts were kept."""
    n = len(run.hashes)
    places, hashes = np.arange(n, dtype=np.int32), run.hashes
    for length in range(1, longest + 1):
        kept = yield length, places, hashes
        if length == longest:
            return
        alive = np.zeros(n + 1, dtype=bool)
        alive[places[kept]] = True
        places, hashes = places[kept], hashes[kept]
        more = alive[places + 1]
        last = np.minimum(places + length, n - 1)
        more &= (places + length < n) & ~run.new_piece[last]
        places, last = places[more], last[more]
        hashes = mix(hashes[more] * np.uint64(0xD1B54A32D192ED03) + run.hashes[last])


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, a place of each, number of each)"""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    return ordered[first], order[first], np.diff(np.append(first, len(hashes)))


def _shard_batches(shard: int, found: np.ndarray, counts: np.ndarray, langs, written: int) -> Iterator[pa.RecordBatch]:
    """(shard, lang, hash, n) of one length's counts, ``written`` rows a batch; ``langs`` gives the languages of
    a slice of them, or is None where they are not told."""
    for lo in range(0, len(found), written):
        some = slice(lo, lo + written)
        own = len(found[some])
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array(np.full(own, shard, np.int32)),
            "lang": pa.nulls(own, pa.string()) if langs is None else pa.array(langs(some), pa.string()),
            "hash": found[some].view(np.int64), "n": pa.array(counts[some].astype(np.int64)),
        })


def shard_counts(docs: DataFrame, known: np.ndarray | None, lengths: range, longest: int) -> DataFrame:
    """shard, lang, hash, n: of phrases of these lengths whose shorter parts are all known.

    Without ``known`` every word counts. The language is told for words only.
    """
    sent = None if known is None else docs.sparkSession.sparkContext.broadcast(known)
    written = WRITTEN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % SHARDS
        for words_run, bridge in _runs(batches, RUN_WORDS, False):
            own, names = len(words_run.hashes) - bridge, np.array(words_run.langs, dtype=object)
            levels = _levels(words_run, min(longest, lengths[-1]))
            step = next(levels, None)
            while step is not None:
                length, places, hashes = step
                if length in lengths:
                    # Phrases that begin in the bridge are counted with the next run.
                    found, at, counts = _counted(hashes[places < own])
                    langs = (lambda some: names[words_run.lang[places[at[some]]]]) if length == 1 else None
                    yield from _shard_batches(shard, found, counts, langs, written)
                    kept = np.ones(len(places), dtype=bool)
                else:
                    kept = _holds(sent.value, hashes)
                try:
                    step = levels.send(kept)
                except StopIteration:
                    step = None

    return docs.mapInArrow(run, "shard int, lang string, hash bigint, n bigint")


def union_of_shards(counted: DataFrame, share: list[float], support: int) -> DataFrame:
    """hash: of phrases that some shard finds at its share of the support, and that may reach it as a whole."""
    # The least whole number that is not below the share; a float below it does no harm.
    least = [max(1, math.ceil(s - 1e-6)) for s in share]
    own = F.element_at(F.array(*map(F.lit, least)), F.col("shard") + 1)
    missed = sum(n - 1 for n in least)
    found = counted.groupBy("shard", "hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= own)
    above = found.groupBy("hash").agg(F.sum(F.col("n") - own + 1).alias("above"))
    return above.filter(F.col("above") + missed >= support).select("hash")


def bloom_bits(candidates: int) -> int:
    """A power of two with at least ``BITS_EACH`` bits a candidate, ``MOST_BITS`` at most."""
    return min(MOST_BITS, max(PAGE_BITS, 1 << (candidates * BITS_EACH).bit_length()))


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits for every hash."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(29)) & mask


def bloom_filter(candidates: DataFrame, bits: int) -> np.ndarray:
    """The filter's bytes, made in pages, one a group; the driver gets each page once."""

    def page(rows: pa.Table) -> pa.Table:
        own = np.zeros(PAGE_BITS, dtype=bool)
        own[rows.column("bit").to_numpy()] = True
        return pa.table({
            "page": rows.column("page").slice(0, 1), "bytes": pa.array([np.packbits(own).tobytes()], pa.binary()),
        })

    low, high = (F.col("hash").bitwiseAND(bits - 1), F.shiftrightunsigned("hash", 29).bitwiseAND(bits - 1))
    placed = candidates.select(F.explode(F.array(low, high)).alias("slot")).select(
        F.shiftright("slot", PAGE_BITS.bit_length() - 1).alias("page"), F.col("slot").bitwiseAND(PAGE_BITS - 1).alias("bit")
    )
    pages = placed.distinct().groupBy("page").applyInArrow(page, "page bigint, bytes binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in pages.toLocalIterator():
        at = row["page"] * (PAGE_BITS // 8)
        out[at : at + PAGE_BITS // 8] = np.frombuffer(bytes(row["bytes"]), np.uint8)
    return out


def _holds(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    kept = np.ones(len(hashes), dtype=bool)
    for slot in _slots(hashes, len(bloom) * 8):
        kept &= (bloom[(slot >> np.uint64(3)).astype(np.int64)] >> (7 - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return kept


def phrase_counts(docs: DataFrame, bloom: np.ndarray, support: int, longest: int) -> DataFrame:
    """lang, phrase, words, a: all phrases that occur ``support`` times or more, single words too."""
    sent = docs.sparkSession.sparkContext.broadcast(bloom)
    fold = _WORDS[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A phrase's number, and by number what it is and how often it was met.
        numbers: dict[int, int] = {}
        langs, phrases, lengths, met = [], [], [], np.zeros(0, np.int64)

        def kept_ones() -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(phrases), WRITTEN):
                some = slice(lo, lo + WRITTEN)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array(langs[some], pa.string()),
                    "phrase": pa.array(phrases[some], pa.binary()).cast(pa.string()),
                    "words": pa.array(lengths[some], pa.int32()), "a": pa.array(met[some]),
                })

        for shard, bridge in _runs(batches, COUNTED_WORDS, True):
            data = fold[shard.data].tobytes()
            own = len(shard.hashes) - bridge
            names = np.array(shard.langs, dtype=object)
            levels = _levels(shard, longest)
            step = next(levels, None)
            while step is not None:
                length, places, hashes = step
                kept = _holds(sent.value, hashes)
                # Phrases that begin in the bridge are counted with the next run.
                begins = kept & (places < own)
                found, at, counts = _counted(hashes[begins])
                # New ones get the next numbers, in the order they are found.
                which = np.array([numbers.setdefault(h, len(numbers)) for h in found.tolist()], dtype=np.int64)
                first = places[begins][at][which >= len(phrases)]
                met = np.concatenate([met, np.zeros(len(first), np.int64)])
                met[which] += counts
                langs += names[shard.lang[first]].tolist()
                lengths += [length] * len(first)
                for lo in range(0, len(first), WRITTEN):
                    some = first[lo : lo + WRITTEN]
                    spans = [(shard.start[some + i].tolist(), shard.end[some + i].tolist()) for i in range(length)]
                    texts = [[data[s:e] for s, e in zip(*span, strict=True)] for span in spans]
                    phrases += map(b" ".join, zip(*texts, strict=True))
                try:
                    step = levels.send(kept)
                except StopIteration:
                    step = None
            if len(phrases) >= KEPT:
                yield from kept_ones()
                numbers.clear()
                langs, phrases, lengths, met = [], [], [], np.zeros(0, np.int64)
        yield from kept_ones()

    counted = docs.mapInArrow(run, "lang string, phrase string, words int, a bigint")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= support)


def frequent_phrases(
    docs: DataFrame,
    support: int = SUPPORT,
    longest: int = LONGEST,
    text: str = "text",
    lang: str = "lang",
    steps: Steps | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a of all frequent phrases up to ``longest`` words; lang, n of all languages).

    Both are stored tables, in the folder of ``steps``.
    """
    steps = steps or Steps(docs.sparkSession, "phrases")
    chosen = docs.select(
        F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang")
    )
    counted = shard_counts(chosen, None, range(1, 2), longest)
    counted = steps.keep(counted.groupBy("shard", "lang", "hash").agg(F.sum("n").alias("n")), "words")
    totals = steps.keep(counted.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    # A number for each shard. Shares add up to the support, whatever the language.
    own = {row["shard"]: row["n"] for row in counted.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    share = [support * own.get(i, 0) / max(1, sum(own.values())) for i in range(SHARDS)]
    union = steps.keep(union_of_shards(counted, share, support), "union-1")
    # One length a pass: a phrase is counted only where both its parts one word shorter are in the union.
    for length in range(2, longest + 1):
        longer = shard_counts(chosen, bloom_filter(union, bloom_bits(union.count())), range(length, length + 1), longest)
        union = union.union(steps.keep(union_of_shards(longer, share, support), f"union-{length}"))
    bloom = bloom_filter(union, bloom_bits(union.count()))
    return steps.keep(phrase_counts(chosen, bloom, support, longest), "frequent"), totals


def collocations(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of phrases of two words or more that no equally frequent
    longer phrase contains. The lowest score of all cuts into two parts counts, of equal ones the first."""
    part = lambda lo, n: F.array_join(F.slice("parts", lo, n), " ")
    longer = frequent.filter("words > 1").withColumn("parts", F.split("phrase", " "))
    cuts = longer.select(
        "lang", "phrase", "words", "a", "parts", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    ).select(
        "lang", "phrase", "words", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"),
        part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("tail"),
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    big = lambda c: F.col(c).cast("decimal(18,0)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("above", big("a") * big("n") * F.lit(1000).cast("decimal(4,0)"))
        .withColumn("below", big("l") * big("r"))
        .withColumn("score", F.expr("above div below"))
        .groupBy("lang", "phrase", "words", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")
    )
    # Whatever contains a phrase is at most as frequent as what contains it with one word more.
    inner = longer.filter("words > 2").select(
        "lang", "a", F.explode(F.array(part(F.lit(1), F.col("words") - 1), part(F.lit(2), F.col("words") - 1))).alias("phrase")
    )
    outer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("a"))
    return scored.join(outer, ["lang", "phrase", "a"], "left_anti")


def best(scored: DataFrame, most: int = BEST) -> DataFrame:
    """The first ``most`` of every language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, support: int = SUPPORT, most: int = BEST, **options) -> DataFrame:
    """The best collocations of every language."""
    frequent, totals = frequent_phrases(docs, support, **options)
    return best(collocations(frequent, totals), most)
