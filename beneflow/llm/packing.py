"""Token ids of documents packed into matrices of equal rows, for training.

Documents are encoded with a public vocabulary and closed by ``end_id``. One longer than a row is split
into pieces of a row each and a rest; nothing is dropped. Pieces are packed best-fit decreasing: longest
first, each into the row with the least room that still holds it. A segment tree over room sizes finds
that row in as many steps as the row length has bits.

Every task packs what it reads, in buffers of a bounded number of tokens, so documents are not shuffled
and no task holds more than a buffer. A table row is a matrix:

* ``shard``, ``matrix``: the task's number and the matrix's number within it
* ``n_rows``, ``ids``: that many rows of ``row_length`` ids, little-endian, 2 bytes each if the vocabulary
  allows it, else 4; the end of a row is filled with ``end_id``
* ``cu_seqlens``: 0 and the ends of all segments in the flattened matrix, filling included
* ``position_resets``: where position ids start again from 0, the beginnings of all segments
* ``doc_ids``, ``offsets``: for each segment its document, null for filling, and the place of its first
  token in the document

Long runs of white space, on which the tokenizer would run out of stack, are one word each by the vocabulary's
pattern, all but the last character where text follows; they are cut out and encoded as that.

Defined results: a null or empty text has no tokens and is in no matrix. Texts are of any length. Repeated rows are packed as often.
A null id is told from filling by its offset, which is null for filling only. Packing depends on how rows
are spread over tasks; a task that runs again over the same rows gives the same matrices.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beneflow.llm.words import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of the public vocabulary: how it cuts texts into words, and its id for the end of a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_ID = 50256

# White space of so many characters or more is encoded apart.
LONG_BLANK = 100_000
_BLANKS = regex.compile(rf"\p{{White_Space}}{{{LONG_BLANK},}}+")

ROW_LENGTH = 2048
MATRIX_ROWS = 32
BUFFER_TOKENS = 1 << 22
BUFFER_PIECES = 1 << 17
SCHEMA = (
    "shard int, matrix int, n_rows int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, offsets array<bigint>"
)


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids ``encode_ordinary`` gives, for texts with any run of white space."""
    if len(text) < LONG_BLANK:
        return encoding.encode_ordinary(text)
    out, at = [], 0
    for run in _BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += encoding.encode_ordinary(text[at : run.start()])
        out += encoding._encode_single_piece(text[run.start() : end].encode())
        at = end
    return out + encoding.encode_ordinary(text[at:])


class RoomTree:
    """Rows by their room: a segment tree over rooms 0 to ``most`` that tells where any row is left."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.any = np.zeros(2 * self.size, dtype=bool).tolist()
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.size + room
        while node and not self.any[node]:
            self.any[node] = True
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of ``least`` or more; it is taken out."""
        node = self.size + least
        if not self.any[node]:
            # Up to the first subtree on the right with a row, then down to its first leaf.
            while node & 1 or not self.any[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[node] = False
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = False
                node >>= 1
        return room, row


def best_fit_decreasing(lengths: list[int], row_length: int) -> list[list[int]]:
    """Rows of piece numbers; pieces in the given order among equally long ones."""
    tree, rows = RoomTree(row_length), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[piece])
        room, row = found or (row_length, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            tree.add(room - lengths[piece], row)
    return rows


@dataclass
class Buffer:
    """Pieces waiting to be packed."""

    row_length: int
    end_id: int
    matrix_rows: int
    kind: np.dtype
    pieces: list[tuple[int | None, int, np.ndarray]] = field(default_factory=list)
    tokens: int = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for at in range(0, len(ids), self.row_length):
            self.pieces.append((doc_id, at, ids[at : at + self.row_length]))
        self.tokens += len(ids)

    @property
    def full(self) -> bool:
        return self.tokens >= BUFFER_TOKENS or len(self.pieces) >= BUFFER_PIECES

    def matrices(self) -> Iterator[dict]:
        """Packs all pieces; a dictionary of columns for each matrix."""
        self.pieces.sort(key=lambda p: (p[0] is None, p[0] or 0, p[1]))
        rows = best_fit_decreasing([len(ids) for _, _, ids in self.pieces], self.row_length)
        for at in range(0, len(rows), self.matrix_rows):
            own = rows[at : at + self.matrix_rows]
            matrix = np.full((len(own), self.row_length), self.end_id, dtype=self.kind)
            ends, docs, offsets = [0], [], []
            for i, row in enumerate(own):
                place = 0
                for piece in row:
                    doc_id, offset, ids = self.pieces[piece]
                    matrix[i, place : place + len(ids)] = ids
                    place += len(ids)
                    ends.append(i * self.row_length + place)
                    docs.append(doc_id)
                    offsets.append(offset)
                if place < self.row_length:
                    ends.append((i + 1) * self.row_length)
                    docs.append(None)
                    offsets.append(None)
            yield {"n_rows": len(own), "ids": matrix.tobytes(), "cu_seqlens": ends, "position_resets": ends[:-1],
                   "doc_ids": docs, "offsets": offsets}
        self.pieces, self.tokens = [], 0


def id_type(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    end_id: int = END_ID,
    row_length: int = ROW_LENGTH,
    matrix_rows: int = MATRIX_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Matrices of all documents. The vocabulary's file is read by the driver and sent along."""
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(sent.value, pattern)
        kind = id_type(max(encoding.max_token_value, end_id) + 1)
        buffer, shard, number = Buffer(row_length, end_id, matrix_rows, kind), TaskContext.get().partitionId(), 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for matrix in buffer.matrices():
                yield pa.RecordBatch.from_pylist([{"shard": shard, "matrix": number, **matrix}], schema=_ARROW)
                number += 1

        for batch in batches:
            for part in slices(batch):
                for own, whole in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if whole:
                        buffer.add(own, np.array([*ids_of(encoding, whole), end_id], dtype=kind))
                    if buffer.full:
                        yield from packed()
        yield from packed()

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, SCHEMA)


_ARROW = pa.schema([
    ("shard", pa.int32()), ("matrix", pa.int32()), ("n_rows", pa.int32()), ("ids", pa.binary()),
    ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
])


def write_packed(packed: DataFrame, folder: str) -> DataFrame:
    """The matrices as Parquet files below ``folder``, read back."""
    packed.write.option("compression", "zstd").parquet(folder)
    return packed.sparkSession.read.schema(packed.schema).parquet(folder)


def matrix_of(row, row_length: int = ROW_LENGTH) -> np.ndarray:
    """The ids of a table row, ``n_rows`` by ``row_length``."""
    raw = bytes(row["ids"])
    return np.frombuffer(raw, f"<u{len(raw) // (row['n_rows'] * row_length)}").reshape(row["n_rows"], row_length)


def positions_of(row) -> np.ndarray:
    """Position ids of the flattened matrix."""
    lengths = np.diff(row["cu_seqlens"])
    return np.arange(row["cu_seqlens"][-1]) - np.repeat(row["position_resets"], lengths)


def unpacked(rows: Iterable, row_length: int = ROW_LENGTH) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, offset, ids) of every piece."""
    for row in rows:
        flat = matrix_of(row, row_length).ravel()
        for start, end, doc_id, offset in zip(row["cu_seqlens"], row["cu_seqlens"][1:], row["doc_ids"], row["offsets"], strict=False):
            if offset is not None:
                yield doc_id, offset, flat[start:end]
