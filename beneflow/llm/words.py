"""Words of whole Arrow text batches as 64-bit hashes, without a Python object per word.

A text is cut into words by byte class. Every class used here keeps all bytes from 0x80 on together,
so UTF-8 characters are never cut and a byte class says the same as the character class it stands for.
A word's hash is a polynomial over random byte values modulo 2^64, taken from prefix sums, and then
mixed; equal words have equal hashes in every task and every run. Where a wrong match would show in a
result, callers compare bytes too, or rely on 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Bytes hashed at a time: temporary arrays take about 50 bytes for each.
SEGMENT = 1 << 20
# Text bytes a caller works on at a time.
SLICE = 4 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _classes(separators) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, byte after A-Z were lower-cased)"""
    keep = np.ones(256, dtype=bool)
    keep[list(separators)] = False
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return keep, fold


SPACES = (*range(9, 14), 32)
#: Words between white space: space and code points 9 to 13.
BY_SPACE = _classes(SPACES)
#: Words of letters and digits; every code point from 0x80 on counts as a letter.
BY_LETTER = _classes([*range(48), *range(58, 65), *range(91, 97), *range(123, 128)])


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random value per byte, powers of the base and their inverses modulo 2^64."""
    values = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
    values |= np.uint64(1)

    def powers(base: int) -> np.ndarray:
        steps = np.full(SEGMENT, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return values, powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values, after which all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of texts; text i has words ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # byte positions in ``data``, end exclusive
    ends: np.ndarray
    data: np.ndarray
    prefixes: list[np.ndarray]  # hashes of the first bytes of each word, one array per asked length

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``size`` bytes of text, or one longer text, each."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        # Rows without text take no bytes, but memory all the same.
        end = min(end, at + 65536)
        yield batch.slice(at, end - at)
        at = end


def words(column: pa.Array, classes=BY_SPACE, prefixes: tuple[int, ...] = ()) -> Words:
    """Words of all texts; the hash of a prefix of a whole word is that word's hash."""
    data, offsets = utf8(column)
    keep, fold = classes
    values, powers, inverses = _tables()
    values = np.where(keep, values[fold], np.uint64(0))
    hashes, starts, ends = [], [], []
    short: list[list[np.ndarray]] = [[] for _ in prefixes]
    lo = 0
    while lo < len(data):
        hi = _cut(data, offsets, keep, lo)
        part = data[lo:hi]
        inside = keep[part]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        inner = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        begin[inner] |= inside[inner]
        end = np.zeros(len(part) + 1, dtype=bool)
        end[1:] = inside
        end[1:-1] &= ~inside[1:] | begin[1:]
        s, e = np.flatnonzero(begin), np.flatnonzero(end)
        if len(part) <= SEGMENT:
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(values[part] * powers[: len(part)], out=total[1:])
            h = (total[e] - total[s]) * inverses[s]
            for found, length in zip(short, prefixes, strict=True):
                found.append(mix((total[np.minimum(s + length, e)] - total[s]) * inverses[s]))
        else:  # one word of more than a segment
            h = np.array([_long(values[part[a:b]], powers) for a, b in zip(s, e, strict=True)], dtype=np.uint64)
            for found, length in zip(short, prefixes, strict=True):
                cut = [_long(values[part[a : min(a + length, b)]], powers) for a, b in zip(s, e, strict=True)]
                found.append(mix(np.array(cut, dtype=np.uint64)))
        hashes.append(mix(h))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    starts = join(starts, np.int64)
    return Words(
        join(hashes, np.uint64), np.searchsorted(starts, offsets), starts, join(ends, np.int64), data,
        [join(found, np.uint64) for found in short],
    )


def _cut(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray, lo: int) -> int:
    """Where a segment from ``lo`` ends: at a text's end, else behind a separator, else behind the word."""
    if len(data) - lo <= SEGMENT:
        return len(data)
    hi = int(offsets[np.searchsorted(offsets, lo + SEGMENT, side="right") - 1])
    if hi > lo:
        return hi
    gaps = np.flatnonzero(~keep[data[lo : lo + SEGMENT]])
    if len(gaps):
        return lo + int(gaps[-1]) + 1
    end = int(offsets[np.searchsorted(offsets, lo, side="right")])
    gaps = np.flatnonzero(~keep[data[lo:end]])
    return lo + int(gaps[0]) + 1 if len(gaps) else end


def _long(values: np.ndarray, powers: np.ndarray) -> int:
    """The same polynomial, a segment at a time."""
    total, scale = 0, 1
    for at in range(0, len(values), SEGMENT):
        part = values[at : at + SEGMENT]
        total += int(np.add.reduce(part * powers[: len(part)])) * scale
        scale = scale * pow(_BASE, SEGMENT, 1 << 64) & (1 << 64) - 1
    return total & (1 << 64) - 1


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of ``size``-word shingles of all texts: sorted distinct hashes, and where each text's begin.

    A text with fewer words has one shingle, all its words in order; a text without words has none.
    """
    counts = found.counts
    rolled = found.hashes.copy()
    n = len(rolled)
    many = np.maximum(counts - size + 1, 0)
    for i in range(1, size):
        rolled[: n - i] = mix(rolled[: n - i] * np.uint64(0xD1B54A32D192ED03) + found.hashes[i:])
    at = np.repeat(found.first[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    owner = np.repeat(np.arange(len(counts)), many)
    hashes = rolled[at]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        whole = []
        for i in few:
            h = int(counts[i])
            for w in found.hashes[found.first[i] : found.first[i + 1]].tolist():
                h = (h * 0xD1B54A32D192ED03 + w ^ 0x5851F42D4C957F2D) & (1 << 64) - 1
            whole.append(h)
        hashes = np.concatenate([hashes, mix(np.array(whole, dtype=np.uint64))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((hashes, owner)) if len(few) else _by_owner(hashes, many)
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def _by_owner(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order by text, then by hash; hashes stand in text order already."""
    order = np.empty(len(hashes), dtype=np.int64)
    at = 0
    for n in counts.tolist():
        order[at : at + n] = np.argsort(hashes[at : at + n]) + at
        at += n
    return order
