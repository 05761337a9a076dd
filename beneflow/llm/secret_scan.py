"""Secrets in texts: keyword automaton, then anchored expressions near its hits, then checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds every place where a secret could
begin; a kind's expression is only ever tried at such a place. A run of 32 hexadecimal digits has no
keyword, so it is looked for in a copy of the text in which every such digit is the same byte. All
matching is on UTF-8 bytes; the patterns are ASCII, so it says the same as on characters. Spans are in
code points, their end exclusive.

Kinds: ``assign``, ``access`` and ``hex`` are the base kinds; their matches are those of a leftmost
non-overlapping scan per kind. ``github`` and ``npm`` are tokens that carry a CRC-32 of their own body;
they are reported only if it is right.

A null or empty text has no secret. Repeated rows are scanned each for itself; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beneflow.llm.frames import by_slice, record_batch
from beneflow.llm.words import utf8

# Fixed values of the contract: kinds in the order in which they are listed, keywords and patterns.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_HEX_RUN = b"x" * HEX_LENGTH


def checksum(body: bytes) -> bytes:
    """CRC-32 as six base-62 digits."""
    value, digits = zlib.crc32(body), bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits))


def _valid(match: re.Match) -> bool:
    return checksum(match[1]) == match[2]


_EXPRESSIONS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_LENGTH),
    "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_LENGTH),
    "github": (GITHUB, _valid),
    "npm": (NPM, _valid),
}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


@lru_cache(maxsize=1)
def _hex_table() -> bytes:
    return bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def byte_spans(raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes of every secret of one text, by start, then kind."""
    found: list[tuple[int, int, str]] = []
    free = dict.fromkeys(KEYWORDS, 0)  # where the next match of a kind may begin
    # One character for each byte, so places in it are places in the bytes.
    for last, (kind, length) in _automaton().iter(raw.lower().decode("latin-1")):
        at = last - length + 1
        if at < free[kind]:
            continue
        expression, accept = _EXPRESSIONS[kind]
        if match := expression.match(raw, at):
            if kind in BASE_KINDS:
                free[kind] = match.end()
            if accept(match):
                free[kind] = match.end()
                found.append((at, match.end(), kind))
    runs = raw.translate(_hex_table())
    at = runs.find(_HEX_RUN)
    while at >= 0:
        end = HEX.match(raw, at).end()
        found.append((at, end, "hex"))
        at = runs.find(_HEX_RUN, end)
    found.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return found


def _in_code_points(raw: bytes, spans: list[tuple[int, int, str]]) -> list[dict]:
    if not raw.isascii():
        first_bytes = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        place = lambda i: int(first_bytes[i - 1]) if i else 0
        spans = [(place(s), place(e), k) for s, e, k in spans]
    return [{"kind": k, "start": s, "end": e} for s, e, k in spans]


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for every row; ``spans`` is empty where there is no secret."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(part.column("text"))
        whole = memoryview(data)
        spans = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            raw = bytes(whole[a:b])
            spans.append(_in_code_points(raw, byte_spans(raw)) if raw else [])
        return record_batch(doc_id=part.column("doc_id"), spans=pa.array(spans, _SPANS))

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return by_slice(chosen, make, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and all spans as text, per row."""
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )
