"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source's documents stand in a seeded order, dealt over a fixed number of shards. The mix has a seat for
every word; sources get them by highest quotients ``target / (2 * seats + 1)``, and a source's shards get its
seats in the same way by their words, so each shard has an integer quota of words, whatever its size. A quota
takes every word once for each full round; the rest are blocks of ``block_words`` words that follow each other
from a seeded one, the last of them cut to the word. As the order of the documents is seeded itself, that is
a random choice of documents, and at most four of a shard are cut.

Targets share the size of all sources by weight; one stops at ``max_repeats`` times its source's words,
and what is left over is shared again by weight until none is above. Weights repeat over the sources in
code point order, a null source last.

At scale: texts are read once for their sizes. The driver holds a row for each source, and for each
source and shard; more than ``MAX_SOURCES`` sources are refused. Documents are ordered within buckets of
about ``bucket_words`` words or rows, found by id and text, so a source with most rows is spread as finely as
any other, also where its rows have no ids or no words.

Defined results: a null or empty text has size 0 and is taken 0 times. Documents that share an id are told
apart by text; equal ones are interchangeable. A null id is an id like any other.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beneflow.llm.frames import free_name, stored
from beneflow.llm.words import SLICE, slices, words

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
MAX_SOURCES = 100_000
BLOCK_WORDS = 64
SHARDS = 16
BUCKET_WORDS = 50_000
SEED = 17


def word_count(text: str) -> Column:
    """Words between white space, by the contract's character class."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times its size."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    open_ones = {i for i, size in enumerate(sizes) if size}
    left = sum(sizes)
    out = [0.0] * len(sizes)
    while open_ones:
        per_weight = sum(weight[i] for i in open_ones)
        above = {i for i in open_ones if left * weight[i] > most * sizes[i] * per_weight}
        if not above:
            for i in open_ones:
                out[i] = left * weight[i] / per_weight
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= most * sizes[i]
        open_ones -= above
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients ``vote / (2 * seat + 1)``, ties to the first party, none above ``most``."""
    seats = min(seats, sum(m for v, m in zip(votes, most, strict=True) if v > 0))
    low, high = 0.0, 2.0 * max([*votes, 0.0]) + 1

    def rounded(divisor: float) -> list[int]:
        return [min(m, int(v / divisor + 0.5)) if v > 0 else 0 for v, m in zip(votes, most, strict=True)]

    # The same seats as dividing and rounding: halve towards a divisor that gives hardly too few.
    for _ in range(200):
        middle = (low + high) / 2
        given = sum(rounded(middle)) if middle > low else seats + 1
        if given > seats:
            low = middle
        else:
            high = middle
        if given == seats:
            break
    out = rounded(high)
    heap = [(-v / (2 * s + 1), i) for i, (v, s, m) in enumerate(zip(votes, out, most, strict=True)) if v > 0 and s < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def seeded(text: str, n: int) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % n


@dataclass
class Quota:
    """What the mix takes of one shard of a source: full rounds, and word ranges once more."""

    source: int
    shard: int
    rounds: int
    ranges: list[tuple[int, int]]


def quotas(shard_words: list[list[int]], aims: list[float], block: int, most: int, seed: int) -> list[Quota]:
    """Words to sources, then to each source's shards, then blocks of a shard from a seeded one."""
    sizes = [sum(shards) for shards in shard_words]
    by_source = sainte_lague(aims, sum(sizes), [most * size for size in sizes])
    out = []
    for source, (shards, seats) in enumerate(zip(shard_words, by_source, strict=True)):
        given = sainte_lague([float(w) for w in shards], seats, [most * w for w in shards])
        for shard, (total, quota) in enumerate(zip(shards, given, strict=True)):
            rounds, rest = divmod(quota, total) if total else (0, 0)
            start = block * seeded(f"{seed}:{source}:{shard}", -(-total // block)) if total else 0
            ranges = [(start, min(start + rest, total)), (0, max(0, start + rest - total))]
            out.append(Quota(source, shard, rounds, [r for r in ranges if r[0] < r[1]]))
    return out


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    bucket_words: int = BUCKET_WORDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rounds, pieces) for every row.

    ``pieces`` are the word ranges taken besides the ``rounds`` whole copies. With ``carry`` the row
    itself follows as struct ``row``.
    """
    spark = docs.sparkSession
    own = [F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text), F.lit("")))]
    key = F.md5(F.concat_ws(":", F.lit(seed), *own))
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"),
        key.alias("key"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    # Sizes alone for all that is counted; rows are only read again where they are carried along.
    narrow = stored(sized.drop("row"), "sizes")
    if not carry:
        sized = narrow
    spread = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    rows = narrow.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.size for r in rows]
    aims = targets(sizes, weights, max_repeats)
    subs = [max(1, -(-max(r.size, r.n) // (shards * bucket_words))) for r in rows]
    # One row for each source: bounded by MAX_SOURCES.
    sources = F.broadcast(spark.createDataFrame(
        [(i, r.source, r.size, aim, sub) for i, (r, aim, sub) in enumerate(zip(rows, aims, subs, strict=True))],
        "src int, name string, source_size bigint, target double, sub bigint",
    ))

    def placed(rows: DataFrame) -> DataFrame:
        known = rows.join(sources, F.col("source").eqNullSafe(F.col("name")))
        return known.withColumn("bucket", spread % (F.col("sub") * shards))

    buckets = placed(narrow).groupBy("src", "bucket").agg(
        F.sum("size").alias("words"), F.first((F.col("bucket") / F.col("sub")).cast("int")).alias("shard")
    )
    buckets = stored(buckets, "buckets")
    totals = buckets.groupBy("src", "shard").agg(F.sum("words").alias("words")).collect()
    shard_words = [[0] * shards for _ in rows]
    for r in totals:
        shard_words[r.src][r.shard] = r.words
    given = quotas(shard_words, aims, block_words, max_repeats, seed)
    # One row for each source and shard.
    given = F.broadcast(spark.createDataFrame(
        [(q.source, q.shard, q.rounds, [list(r) for r in q.ranges]) for q in given],
        "src int, shard int, rounds bigint, ranges array<array<bigint>>",
    ))
    before = Window.partitionBy("src", "shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    inside = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    at = placed(sized).withColumn("end", F.sum("size").over(inside)).join(bases, ["src", "bucket"]).join(given, ["src", "shard"])
    start = F.col("base") + F.col("end") - F.col("size")

    def piece(r: Column) -> Column:
        first = F.greatest(r[0] - start, F.lit(0))
        return F.array(first, F.greatest(first, F.least(r[1] - start, F.col("size"))))

    pieces = F.filter(F.transform("ranges", piece), lambda p: p[1] > p[0])
    at = at.withColumn("pieces", pieces)
    extra = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda a, p: a + p[1] - p[0])
    return at.select(
        "doc_id", "size", "source_size", "target", (F.col("rounds") * F.col("size") + extra).alias("taken"),
        "rounds", "pieces", *(["row"] if carry else []),
    )


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix: every row as often as it is taken, with its columns; a piece has its words of the text."""
    planned = plan(docs, text=text, carry=True, **options)
    whole = F.transform(F.sequence(F.lit(1), F.col("rounds")), lambda _: F.array(F.lit(0).cast("bigint"), F.col("size")))
    copies = F.concat(F.when(F.col("rounds") > 0, whole).otherwise(F.array()), F.col("pieces"))
    taken = planned.where(F.col("taken") > 0).select("row", "size", F.explode(copies).alias("piece"))
    wanted_piece = free_name(docs, "piece")
    flat = taken.select(
        F.col("row.*"),
        F.when((F.col("piece")[0] > 0) | (F.col("piece")[1] < F.col("size")), F.col("piece")).alias(wanted_piece),
    )

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        wanted = part.column(wanted_piece).to_pylist()
        out = part.drop_columns([wanted_piece])
        at = out.schema.get_field_index(text)
        if any(w is not None for w in wanted):
            texts = [
                t if w is None else words_between(t, *w) for t, w in zip(out.column(at).to_pylist(), wanted, strict=True)
            ]
            out = out.set_column(at, out.schema.field(at), pa.array(texts, out.schema.field(at).type))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield cut(part)

    return flat.mapInArrow(run, docs.schema)


def words_between(text: str, first: int, end: int) -> str:
    """The text from its word ``first`` up to word ``end``, white space between them kept."""
    found = words(pa.array([text], pa.string()))
    return found.data[found.starts[first] : found.ends[end - 1]].tobytes().decode("utf-8", "replace")
