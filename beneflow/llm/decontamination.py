"""Benchmark passages in texts, found by Wu-Manber multi-pattern search over words.

A pattern is a window of ``window`` consecutive words of a benchmark item; an item with fewer words is one
pattern. Patterns of equal length are searched together. A table tells for every block of two words
how far a window may move on before it could end in that block; it is large where no pattern holds the
block, so most words are never looked at. Where the shift is 0, the block's hash selects the patterns that
end in it, and those are compared word by word, then byte by byte. Searching starts in many runs of
positions at once, each moving on by its own shifts.

Patterns are broadcast in blocks of at most ``BLOCK_PATTERNS`` windows, and ``ROUND_BLOCKS`` blocks are searched
in one narrow pass over the texts, which bounds what a worker holds. What the passes before have found goes
along with the rows; no text is ever shuffled.

Words are runs of letters, digits and code points from 0x80 on, with A-Z lower-cased. A null or empty
text has no words and no hits; an item without words or id has no windows. Items with the same id count
as one. Repeated rows are each judged for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from beneflow.llm.frames import stored
from beneflow.llm.words import BY_LETTER, Words, mix, slices, words

WINDOW = 13
BLOCK_PATTERNS = 100_000
ROUND_BLOCKS = 4
# A text is contaminated if at least one of so many of its words is hit.
ONE_IN = 20
RUN = 128
SLOTS = 1 << 18
_PAIR = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Patterns:
    """Patterns of one length with their shift table and suffix buckets."""

    length: int
    hashes: np.ndarray  # a row of word hashes for each pattern, by suffix
    suffixes: np.ndarray  # hash of the last block of each pattern, sorted
    texts: list[bytes]
    items: list[tuple[str, ...]]
    shifts: np.ndarray

    @property
    def block(self) -> int:
        return min(2, self.length)


def block_hashes(hashes: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    if block == 1:
        return hashes[ends]
    return mix(hashes[ends - 1] * _PAIR + hashes[ends])


def make_patterns(found: dict[bytes, tuple[np.ndarray, set[str]]], length: int) -> Patterns:
    texts = list(found)
    hashes = np.array([found[t][0] for t in texts], dtype=np.uint64).reshape(len(texts), length)
    block = min(2, length)
    flat, at = hashes.ravel(), np.arange(len(texts)) * length
    shifts = np.full(SLOTS, length - block + 1, dtype=np.int64)
    for end in range(block - 1, length):
        slots = (block_hashes(flat, at + end, block) % np.uint64(SLOTS)).astype(np.int64)
        np.minimum.at(shifts, slots, length - 1 - end)
    suffixes = block_hashes(flat, at + length - 1, block)
    order = np.argsort(suffixes)
    return Patterns(
        length, hashes[order], suffixes[order], [texts[i] for i in order],
        [tuple(sorted(found[texts[i]][1])) for i in order], shifts,
    )


def _word_bytes(found: Words, first: int, last: int) -> bytes:
    """The words joined by blanks, as they were compared."""
    whole = [found.data[found.starts[i] : found.ends[i]].tobytes() for i in range(first, last)]
    return b" ".join(whole).lower()


def search(found: Words, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first word, pattern) of every occurrence."""
    length, block = patterns.length, patterns.block
    # Positions a window may end at, cut into runs that are searched side by side.
    lengths = np.maximum(found.counts - length + 1, 0)
    runs = -(-lengths // RUN)
    owner = np.repeat(np.arange(len(lengths)), runs)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    at = found.first[owner] + length - 1 + nth * RUN
    stop = np.minimum(at + RUN, found.first[owner + 1])
    ends = []
    while len(at):
        shift = patterns.shifts[(block_hashes(found.hashes, at, block) % np.uint64(SLOTS)).astype(np.int64)]
        ends.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        on = at < stop
        at, stop = at[on], stop[on]
    ends = np.sort(np.concatenate(ends)) if ends else np.zeros(0, np.int64)
    suffixes = block_hashes(found.hashes, ends, block) if len(ends) else np.zeros(0, np.uint64)
    low = np.searchsorted(patterns.suffixes, suffixes, "left")
    many = np.searchsorted(patterns.suffixes, suffixes, "right") - low
    # A frequent suffix may lead to many patterns: compare a bounded number of pairs at a time.
    firsts, which = [], []
    total = np.cumsum(many)
    begin = 0
    while begin < len(ends):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + (1 << 20), "right")))
        n = many[begin:end]
        first = np.repeat(ends[begin:end] - length + 1, n)
        pattern = np.repeat(low[begin:end], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        for j in range(length):
            same = found.hashes[first + j] == patterns.hashes[pattern, j]
            first, pattern = first[same], pattern[same]
        firsts.append(first)
        which.append(pattern)
        begin = end
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, pattern = np.concatenate(firsts), np.concatenate(which)
    right = [
        _word_bytes(found, f, f + length) == patterns.texts[p]
        for f, p in zip(first.tolist(), pattern.tolist(), strict=True)
    ]
    keep = np.array(right, dtype=bool)
    return first[keep], pattern[keep]


def pattern_blocks(
    benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_PATTERNS, item_id: str = "item_id", text: str = "text"
) -> Iterator[list[Patterns]]:
    """Patterns of all items, at most about ``size`` windows at a time; only these are ever held."""
    chosen = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text"))
    chosen = chosen.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    windows: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
    count = 0
    for row in chosen.toLocalIterator():
        found = words(pa.array([row.text], pa.string()), BY_LETTER)
        total = len(found.hashes)
        length = min(window, total)
        for at in range(total - length + 1 if total else 0):
            known = windows.setdefault(length, {})
            key = _word_bytes(found, at, at + length)
            known.setdefault(key, (found.hashes[at : at + length], set()))[1].add(row.id)
            count += 1
            if count >= size:
                yield [make_patterns(found, length) for length, found in windows.items()]
                windows, count = {}, 0
    if count:
        yield [make_patterns(found, length) for length, found in windows.items()]


@dataclass
class Hits:
    """Per text: number of words, hit runs of words as (first, end) pairs, ids of found items."""

    n_words: np.ndarray
    runs: list[list[int]]
    items: list[list[str]]


def _merged(pairs: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for first, end in sorted(pairs):
        if out and first <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [first, end]
    return out


def hits(column: pa.Array, blocks: list[Broadcast]) -> Hits:
    """Occurrences of all patterns in a slice of texts."""
    found = words(column, BY_LETTER)
    n = len(found.counts)
    runs: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    items: list[set[str]] = [set() for _ in range(n)]
    for block in blocks:
        for patterns in block.value:
            first, which = search(found, patterns)
            owners = np.searchsorted(found.first, first, "right") - 1
            for f, p, i in zip(first.tolist(), which.tolist(), owners.tolist(), strict=True):
                start = f - int(found.first[i])
                if runs[i] and start <= runs[i][-1][1] and start >= runs[i][-1][0]:
                    runs[i][-1] = (runs[i][-1][0], max(runs[i][-1][1], start + patterns.length))
                else:
                    runs[i].append((start, start + patterns.length))
                items[i].update(patterns.items[p])
    return Hits(found.counts, [_merged(r) for r in runs], [sorted(x) for x in items])


#: Columns that go along with the rows, under names no table has.
_RUNS, _ITEMS, _WORDS = "__benchmark_runs", "__benchmark_items", "__benchmark_words"


def _searched(
    docs: DataFrame, benchmark: DataFrame, window: int, size: int, item_id: str, text: str
) -> DataFrame:
    """The rows with all their columns, number of words, hit runs and items found."""
    kinds = {_WORDS: pa.int64(), _RUNS: pa.list_(pa.int64()), _ITEMS: pa.list_(pa.string())}
    types = {_WORDS: LongType(), _RUNS: ArrayType(LongType()), _ITEMS: ArrayType(StringType())}
    schema = StructType([*docs.schema.fields, *(StructField(name, kind) for name, kind in types.items())])

    def one_pass(blocks: list[Broadcast], first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text):
                    found = hits(part.column(text), blocks)
                    if not first:
                        known = zip(part.column(_RUNS).to_pylist(), part.column(_ITEMS).to_pylist(), strict=True)
                        for i, (runs, items) in enumerate(known):
                            pairs = [*zip(runs[::2], runs[1::2], strict=True)]
                            pairs += zip(found.runs[i][::2], found.runs[i][1::2], strict=True)
                            found.runs[i], found.items[i] = _merged(pairs), sorted({*items, *found.items[i]})
                        part = part.drop_columns(list(kinds))
                    values = (found.n_words, found.runs, found.items)
                    new = [pa.array(v, kind) for v, kind in zip(values, kinds.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *kinds])

        return run

    context, out, first = docs.sparkSession.sparkContext, docs, True
    blocks = pattern_blocks(benchmark, window, size, item_id, text)
    while (own := [context.broadcast(b) for b in islice(blocks, ROUND_BLOCKS)]) or first:
        if not first:
            out = stored(out, "benchmark-rounds")
        out, first = out.mapInArrow(one_pass(own, first), schema), False
    return out


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    size: int = BLOCK_PATTERNS,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, runs, items) for every row of ``docs``.

    ``runs`` holds the hit words as first, end, first, end, ...; ``items`` the sorted ids found.
    """
    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(item_id, F.col(text).alias("text"))
    return _searched(chosen, items, window, size, item_id, "text").select(
        "doc_id", F.col(_WORDS).alias("n_words"), F.col(_RUNS).alias("runs"), F.col(_ITEMS).alias("items")
    )


def n_hit(runs: str) -> Column:
    """Words inside the hit runs."""
    ends = F.filter(runs, lambda _, i: i % 2 == 1)
    begins = F.filter(runs, lambda _, i: i % 2 == 0)
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return total(ends) - total(begins)


def is_contaminated(n_words: str, runs: str) -> Column:
    return (n_hit(runs) > 0) & (n_hit(runs) * ONE_IN >= F.col(n_words))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the item ids and the verdict, per row."""
    return found.select(
        "doc_id", "n_words", n_hit("runs").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated("n_words", "runs").alias("contaminated"),
    )


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    size: int = BLOCK_PATTERNS,
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    found = _searched(docs, benchmark, window, size, item_id, text)
    return found.where(~is_contaminated(_WORDS, _RUNS)).drop(_WORDS, _RUNS, _ITEMS)
