"""Byte-pair encoding of whole texts, cut where no token can reach across, and decoding.

A text is cut at special tokens, then into words by the vocabulary's pattern, then by force: two neighbouring
bytes that stand next to each other inside no token of the vocabulary can never be merged into one, so
between them is a certain cut. The fragments are encoded independently and their ids put in a row; that
equals encoding the whole, since merges on one side of a cut neither need nor change the other side.

Cuts are found by arrays over about a megabyte of text at a time, fragments are told apart by a hash of their
bytes, compared byte by byte, and each different one is encoded once. It is encoded by merging the pair of
lowest rank wherever it occurs, from left to right, until no known pair is left. Long fragments are merged
by arrays, all places of a pair at a time, so millions of equal letters or blanks take no more than a few
passes. Fragments a task has met before are looked up.

Defined results: a null or empty text has no ids and decodes to an empty one. Repeated rows are encoded each
for themselves. Texts of any length are encoded whole. Nothing is shuffled.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from copy import copy
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beneflow.llm.words import SEGMENT, _tables, mix, slices, utf8

# Fixed values of the byte-level pre-tokenizer: a word is a contraction's ending; or a run of letters, of numbers
# or of other signs, each with a blank before it; or a run of Unicode's white space, the last of which goes
# with what follows.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, OTHER = range(4)
# Fragments of so many bytes or more are merged one by one, and not remembered.
LONG = 256
# Fragments a task remembers.
REMEMBERED = 1 << 18


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary's file.

    Visible Latin-1 characters stand for themselves; the others, in order, for letters from U+0100 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class BytePairs:
    """A vocabulary, with what is needed to cut, merge and decode."""

    tokens: dict[bytes, int]
    merges: dict[tuple[int, int], tuple[int, int]]  # two ids: (rank, id of both together)
    special: dict[str, int]
    joined: np.ndarray = field(init=False)  # [a, b]: some token holds byte a before byte b

    def __post_init__(self):
        self.joined = np.zeros((256, 256), dtype=bool)
        for token in self.tokens:
            raw = np.frombuffer(token, np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self.first = np.array([self.tokens[bytes([b])] for b in range(256)], dtype=np.int32)
        known = sorted((a << 32 | b, rank, to) for (a, b), (rank, to) in self.merges.items())
        # One more that is no pair, so that every search ends at an entry.
        self.pairs, self.ranks, self.to = (
            np.array([*(k[i] for k in known), -1], dtype=np.int64) for i in range(3)
        )
        self.pairs[-1] = np.iinfo(np.int64).max
        self.pieces = {to: token for token, to in self.tokens.items()} | {
            to: token.encode() for token, to in self.special.items()
        }
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self.known: dict[bytes, bytes] = {}
        self.token_bytes = np.frombuffer(b"".join(self.pieces[i] for i in range(len(self.pieces))), np.uint8)
        self.token_ends = np.cumsum([0, *(len(self.pieces[i]) for i in range(len(self.pieces)))])

    def fragment_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where fragments of texts in a row begin: at word starts and at forced cuts."""
        begin = word_starts(data, offsets)
        begin[1:] |= ~self.joined[data[:-1], data[1:]]
        return np.flatnonzero(begin)

    def encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of each text in them); special tokens are text like any other."""
        starts = self.fragment_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        which, examples = same_bytes(data, starts, ends)
        raw = data.tobytes()
        spans = zip(starts[examples].tolist(), ends[examples].tolist(), strict=True)
        encoded = self.merged([raw[a:b] for a, b in spans])
        flat = np.frombuffer(b"".join(encoded), "<u4")
        many = np.array([len(e) for e in encoded]) // 4
        ids, after = gathered(flat, np.cumsum(many) - many, many, which)
        return ids, after[np.searchsorted(starts, offsets)]

    def merged(self, fragments: list[bytes]) -> list[bytes]:
        """Ids of different fragments; those not met before are merged together."""
        if len(self.known) + len(fragments) > REMEMBERED:
            self.known.clear()
        unmet = [fragment for fragment in fragments if fragment not in self.known and len(fragment) < LONG]
        self.known.update(zip(unmet, self.merged_together(unmet), strict=True))
        return [self.known[f] if len(f) < LONG else self.merged_by_arrays(f) for f in fragments]

    def merged_together(self, fragments: list[bytes]) -> list[bytes]:
        """Each round merges the lowest pair of every fragment; fragments without one are done."""
        done = [b""] * len(fragments)
        size = np.array([len(f) for f in fragments], dtype=np.int64)
        ids = self.first[np.frombuffer(b"".join(fragments), np.uint8)]
        own = np.arange(len(fragments))
        none = len(self.ranks)
        while len(own):
            begin = np.cumsum(size) - size
            rank, to = np.full(len(ids), none), np.zeros(len(ids), dtype=np.int64)
            pair = ids[:-1].astype(np.int64) << 32 | ids[1:]
            found = np.searchsorted(self.pairs, pair)
            hit = self.pairs[found] == pair
            hit[begin[1:] - 1] = False  # a fragment's last id and the next one's first
            rank[:-1][hit], to[:-1][hit] = self.ranks[found[hit]], self.to[found[hit]]
            lowest = np.minimum.reduceat(rank, begin)
            left = np.flatnonzero((rank == np.repeat(lowest, size)) & (rank < none))
            left = left[_every_second(left, left + 1)]
            ids[left] = to[left]
            stay = np.ones(len(ids), dtype=bool)
            stay[left + 1] = False
            ended = lowest == none
            raw = ids.astype("<u4").tobytes()
            for i, a, n in zip(own[ended].tolist(), begin[ended].tolist(), size[ended].tolist(), strict=True):
                done[i] = raw[4 * a : 4 * (a + n)]
            stay &= ~np.repeat(ended, size)
            size = np.add.reduceat(stay, begin, dtype=np.int64)[~ended]
            ids, own = ids[stay], own[~ended]
        return done

    def merged_by_arrays(self, fragment: bytes) -> bytes:
        """The same, over arrays: pairs wait by rank with all their places, and the lowest rank goes first."""
        ids = self.first[np.frombuffer(fragment, np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        alive = np.ones(n, dtype=bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(left: np.ndarray) -> None:
            left = left[after[left] < n]
            pair = ids[left].astype(np.int64) << 32 | ids[after[left]]
            found = np.searchsorted(self.pairs, pair)
            hit = self.pairs[found] == pair
            left, found = left[hit], found[hit]
            order = np.argsort(found, kind="stable")
            left, found = left[order], found[order]
            starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else []
            for part, entry in zip(np.split(left, starts[1:]), found[starts], strict=True) if len(found) else ():
                rank = int(self.ranks[entry])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(ranks, rank)
                waiting[rank].append((int(entry), part))

        wait(np.arange(n, dtype=np.int32))
        while ranks:
            parts = waiting.pop(heapq.heappop(ranks))
            entry = parts[0][0]
            a, b = int(self.pairs[entry] >> 32), int(self.pairs[entry] & 0xFFFFFFFF)
            left = np.unique(np.concatenate([part for _, part in parts]))
            left = left[alive[left] & (ids[left] == a) & (after[left] < n)]
            left = left[ids[after[left]] == b]
            left = left[_every_second(left, after[left])]
            if not len(left):
                continue
            right = after[left]
            ids[left], alive[right] = self.to[entry], False
            after[left] = after[right]
            inner = after[left] < n
            before[after[left][inner]] = left[inner]
            previous = before[left]
            wait(np.unique(np.concatenate([left, previous[previous >= 0]])))
        return ids[alive].astype("<u4").tobytes()

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text, four little-endian bytes each."""
        texts = texts.fill_null("")
        if self.at_special is not None and any(pc.any(pc.match_substring(texts, token)).as_py() for token in self.special):
            return self.encode_with_special(texts.to_pylist())
        out = []
        for data, offsets, joins in pieces(texts):
            ids, at = self.encode_plain(data, offsets)
            raw, at = ids.tobytes(), (4 * at).tolist()
            own = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
            if joins:
                out[-1] += own.pop(0)
            out += own
        return out

    def encode_with_special(self, texts: list[str]) -> list[bytes]:
        parts = [self.at_special.split(text) for text in texts]
        between = [part for own in parts for part in own[::2]]
        rest = iter(BytePairs.encode_all(self.plain, pa.array(between, pa.string())))
        ids = lambda i, part: self.special[part].to_bytes(4, "little") if i % 2 else next(rest)
        return [b"".join([ids(i, part) for i, part in enumerate(own)]) for own in parts]

    @property
    def plain(self) -> BytePairs:
        """The same vocabulary, for text between special tokens."""
        if self.special and not hasattr(self, "_plain"):
            self._plain = copy(self)
            self._plain.at_special = None
        return self._plain if self.special else self

    def decode_all(self, encoded: list[bytes]) -> list[str]:
        """The texts of ids; bytes that are no UTF-8 become replacement characters."""
        out = []
        for ids in encoded:
            parts = []
            for at in range(0, len(ids), 4 * SEGMENT):
                numbers = np.frombuffer(ids[at : at + 4 * SEGMENT], "<u4")
                raw, _ = gathered(self.token_bytes, self.token_ends[:-1], np.diff(self.token_ends), numbers)
                parts.append(raw.tobytes())
            out.append(b"".join(parts).decode("utf-8", errors="replace"))
        return out


def _every_second(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where equal letters in a row make pairs that overlap, every second of them, from the left."""
    linked = np.r_[False, right[:-1] == left[1:]][: len(left)]
    number = np.arange(len(left))
    return (number - np.maximum.accumulate(np.where(linked, 0, number))) % 2 == 0


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """White space, letter, number or other, of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    some = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, some))
    for kind, name in ((SPACE, "White_Space"), (LETTER, "L"), (NUMBER, "N")):
        for run in regex.finditer(rf"\p{{{name}}}+", every):
            # Surrogates are left out of the text, and are no runs of these kinds.
            out[some[run.start()] : some[run.end() - 1] + 1] = kind
    return out


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte of texts in a row, whether a word begins there."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    n = len(codes)
    out = np.zeros(len(data), dtype=bool)
    if not n:
        return out
    width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
    place = np.cumsum(width, dtype=np.int64) - width
    first = np.zeros(n + 1, dtype=bool)
    first[np.searchsorted(place, offsets[:-1][offsets[:-1] < len(data)])] = True
    first[n] = True
    kind = kinds()[codes]
    space, blank = kind == SPACE, codes == 0x20
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # A blank goes with the word behind it.
    start[1:] &= first[1:n] | space[1:] | ~blank[:-1]
    # The last of a run of white space goes its own way, unless the text ends there.
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    marks = np.flatnonzero((codes == 0x27) & start & ~first[1:])
    for ending in ENDINGS:
        letters = [ord(c) for c in ending]
        at = marks[marks + len(letters) < n]
        for i, letter in enumerate(letters, 1):
            at = at[(codes[at + i] == letter) & ~first[at + i]]
        start[at + 1] = False
        at = at[at + len(letters) + 1 < n]
        start[at + len(letters) + 1] = True
    out[place[start]] = True
    return out


def pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(bytes, offsets, whether the first text continues the last of before) of about a ``SEGMENT`` each.

    A longer text is cut before white space behind something else, where a word ends whatever follows.
    """
    data, offsets = utf8(texts)
    row, at = 0, 0
    while row < len(offsets) - 1:
        joins = at > offsets[row]
        end = int(np.searchsorted(offsets, at + SEGMENT, side="right")) - 1
        if end > row:
            yield data[at : offsets[end]], np.concatenate([[at], offsets[row + 1 : end + 1]]) - at, joins
            row, at = end, int(offsets[end])
            continue
        whole = int(offsets[row + 1])
        cut, size = whole, SEGMENT
        while at + size < whole:
            part = data[at : at + size]
            plain = (part == 0x20) | (part == 0x0A)
            places = np.flatnonzero(plain[1:] & (part[:-1] > 0x20) & (part[:-1] < 0x7F)) + 1
            if len(places):
                cut = at + int(places[-1])
                break
            size *= 2
        yield data[at:cut], np.array([0, cut - at]), joins
        row, at = (row, cut) if cut < whole else (row + 1, whole)


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the different fragments each is, an example of each): equal hashes, then equal bytes."""
    if len(data) <= SEGMENT:
        values, powers, inverses = _tables()
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * inverses[starts])
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        which = np.empty(len(starts), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        examples = order[new]
        size = ends - starts
        if (size == size[examples][which]).all():
            # Fragments have no gaps between them, so this is the whole text put together from examples.
            if (gathered(data, starts[examples], size[examples], which)[0] == data[starts[0] :]).all():
                return which, examples
    raw, known = data.tobytes(), {}
    fragments = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    which = np.array([known.setdefault(fragment, len(known)) for fragment in fragments])
    _, examples = np.unique(which, return_index=True)
    return which, examples


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretches of ``flat`` in the order of ``which``, put in a row; where each ends, after a 0)"""
    own = size[which]
    ends = np.concatenate([[0], np.cumsum(own)])
    return flat[np.repeat(begin[which] - ends[:-1], own) + np.arange(ends[-1])], ends


@lru_cache(maxsize=2)
def from_json(raw: bytes) -> BytePairs:
    """A byte-level vocabulary of the tokenizers library."""
    whole = json.loads(raw)
    model, letters = whole["model"], byte_letters()
    special = {token["content"]: token["id"] for token in whole["added_tokens"]}
    as_bytes = lambda token: bytes(letters[c] for c in token)
    ids = {token: number for token, number in model["vocab"].items() if token not in special}
    merges = {}
    for rank, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        merges[ids[a], ids[b]] = rank, ids[a + b]
    return BytePairs({as_bytes(token): number for token, number in ids.items()}, merges, special)


def _with(docs: DataFrame, vocabulary: str, make: Callable, out: str, doc_id: str, text: str) -> DataFrame:
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = from_json(sent.value)
        for batch in batches:
            for part in slices(batch):
                yield make(pairs, part.column("doc_id"), part.column("text"))

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, out)


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian, four bytes each) of all texts. The vocabulary's file is read by the
    driver and sent along."""

    def make(pairs: BytePairs, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, pa.array(pairs.encode_all(texts), pa.binary())], names=["doc_id", "ids"])

    return _with(docs, vocabulary, make, f"doc_id {_kind(docs, doc_id)}, ids binary", doc_id, text)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text of what ``encode`` gave."""
    with open(vocabulary, "rb") as file:
        sent = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = from_json(sent.value)
        for batch in batches:
            texts = pairs.decode_all([ids or b"" for ids in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_kind(encoded, 'doc_id')}, text string")


def digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts are encoded, and their ids decoded, in one pass."""

    def make(pairs: BytePairs, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        encoded = pairs.encode_all(texts)
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(raw) // 4 for raw in encoded], pa.int64()),
            pa.array([sha256(raw).hexdigest() for raw in encoded], pa.string()),
            pa.array([sha256(whole.encode()).hexdigest() for whole in pairs.decode_all(encoded)], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = f"doc_id {_kind(docs, doc_id)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _with(docs, vocabulary, make, out, doc_id, text)
