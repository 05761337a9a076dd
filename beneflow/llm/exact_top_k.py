"""Exact best inner products: one KD-tree per shard, searched best-first.

Every task cuts the vectors it reads into shards and builds a KD-tree over each: median splits along the
widest side, with tight bounding boxes. For a query q no vector of a box can score more than
``sum(max(q_i * low_i, q_i * high_i))``. Boxes are opened in the order of that bound until it falls below
the k-th score found so far. That score is carried from shard to shard, and starts from the query block
itself, whose vectors are candidates too. So vectors are never shuffled; only the k best of each query
and task are.

Queries are broadcast in blocks of at most about ``query_block`` rows, each a pass over all vectors whose
result is written before the next block is sent; the driver never holds more than one.

Defined results: vectors that are null, or hold a null or non-finite component, or have no id, take no
part. A query is compared with vectors of its own length only. Rows with the query's own id are its own
row, not candidates. Repeated candidate rows each count. Ties go to the smaller id. Fewer than k
candidates: all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beneflow.llm.frames import record_batch
from beneflow.session import shared_folder

SHARD_ROWS = 16384
LEAF_ROWS = 256
QUERY_BLOCK = 8192
PILOT_ROWS = 1024
# Below any score.
NO_SCORE = np.iinfo(np.int64).min
SCHEMA = "query_id bigint, query_row int, vec_id bigint, score bigint"


@dataclass
class Tree:
    points: np.ndarray  # in leaf order
    ids: np.ndarray
    low: np.ndarray  # boxes, one row per node
    high: np.ndarray
    children: list[tuple[int, int] | None]
    spans: list[tuple[int, int]]


def build_tree(points: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    order = np.arange(len(points))
    low, high, children, spans = [], [], [], []
    todo = [(0, len(points), None, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        node = len(spans)
        own = points[order[start:end]]
        low.append(own.min(axis=0))
        high.append(own.max(axis=0))
        spans.append((start, end))
        children.append(None)
        if parent is not None:
            children[parent][side] = node
        if end - start > leaf_rows and (high[-1] > low[-1]).any():
            axis = int(np.argmax(high[-1] - low[-1]))
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own[:, axis], middle)]
            children[node] = [None, None]
            todo.append((start, start + middle, node, 0))
            todo.append((start + middle, end, node, 1))
    return Tree(points[order], ids[order], np.array(low), np.array(high), children, spans)


class Best:
    """The k best (score, id) of one query so far, and the score below which nothing matters."""

    __slots__ = ("floor", "ids", "k", "scores")

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        self.scores = np.concatenate([self.scores, scores.astype(np.int64)])
        self.ids = np.concatenate([self.ids, ids])
        if len(self.scores) > self.k:
            order = np.lexsort((self.ids, -self.scores))[: self.k]
            self.scores, self.ids = self.scores[order], self.ids[order]
        if len(self.scores) == self.k:
            self.floor = max(self.floor, self.scores.min())


def search(tree: Tree, query: np.ndarray, own_id: int, bounds: np.ndarray, best: Best) -> None:
    """Best-first: boxes by their bound; an equal bound may still hold a tie with a smaller id."""
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound < best.floor:
            return
        if (below := tree.children[node]) is not None:
            for child in below:
                if bounds[child] >= best.floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        start, end = tree.spans[node]
        scores, ids = tree.points[start:end] @ query, tree.ids[start:end]
        if len(good := np.flatnonzero((scores >= best.floor) & (ids != own_id))):
            best.add(scores[good], ids[good])


@dataclass
class Queries:
    """Queries of one length, with a first floor for each."""

    ids: np.ndarray
    rows: np.ndarray
    vectors: np.ndarray
    floors: np.ndarray


def _largest(vectors: np.ndarray) -> float:
    return float(np.abs(vectors.astype(float)).max(initial=0))


def as_numbers(largest: float, other: float, length: int):
    """Doubles hold every sum exactly below 2^53; beyond that 64-bit integers are used, as far as they reach."""
    bound = largest * other * max(length, 1)
    if bound >= 2**63 * (1 - 1e-9):
        raise OverflowError(f"scores of {length} components up to {largest:.4g} and {other:.4g} pass 64 bits")
    return np.float64 if bound < 2**53 else np.int64


def make_queries(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int) -> Queries:
    pilot = vectors[:PILOT_ROWS]
    largest = _largest(vectors)
    kind = as_numbers(largest, largest, vectors.shape[1])
    floors = np.full(len(ids), NO_SCORE)
    for at in range(0, len(ids), 1024):
        scores = (vectors[at : at + 1024].astype(kind) @ pilot.astype(kind).T).astype(np.int64)
        scores[ids[at : at + 1024, None] == ids[None, : len(pilot)]] = NO_SCORE
        if (candidates := scores.shape[1]) > k:
            floors[at : at + 1024] = np.partition(scores, candidates - k, axis=1)[:, candidates - k]
    return Queries(ids, rows, vectors, floors)


def _by_length(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, ids, matrix) for each vector length."""
    offsets = np.asarray(vectors.offsets)
    values = np.asarray(vectors.values)
    lengths = np.diff(offsets)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield at, np.asarray(ids)[at], values[offsets[at][:, None] + np.arange(length)]


def _search_task(sent: Broadcast, k: int, shard_rows: int, leaf_rows: int):
    def one_shard(rows: pa.Table, queries: dict[int, Queries], best: dict[int, list[Best]]) -> None:
        rows = rows.combine_chunks()
        ids, vectors = (rows.column(c).chunk(0) for c in ("id", "vector"))
        for _, own_ids, points in _by_length(ids, vectors):
            length = points.shape[1]
            if length not in queries:
                continue
            q = queries[length]
            kind = as_numbers(_largest(points), _largest(q.vectors), length)
            tree = build_tree(points.astype(kind), own_ids, leaf_rows)
            for at in range(0, len(q.ids), 1024):
                asked = q.vectors[at : at + 1024].astype(kind)
                bounds = np.maximum(asked, 0) @ tree.high.T + np.minimum(asked, 0) @ tree.low.T
                for i, (vector, bound) in enumerate(zip(asked, bounds, strict=True), at):
                    search(tree, vector, q.ids[i], bound, best[length][i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[int, Queries] = sent.value
        best = {length: [Best(k, floor) for floor in q.floors] for length, q in queries.items()}
        waiting: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                waiting.append(batch.slice(at, shard_rows))
                count += waiting[-1].num_rows
                if count >= shard_rows:
                    one_shard(pa.Table.from_batches(waiting), queries, best)
                    waiting, count = [], 0
        if count:
            one_shard(pa.Table.from_batches(waiting), queries, best)
        for length, found in best.items():
            q = queries[length]
            counts = [len(b.scores) for b in found]
            if not sum(counts):
                continue
            yield record_batch(
                query_id=np.repeat(q.ids, counts),
                query_row=np.repeat(q.rows, counts).astype(np.int32),
                vec_id=np.concatenate([b.ids for b in found]),
                score=np.concatenate([b.scores for b in found]),
            )

    return run


def quantised(df: DataFrame, scale: int, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) with integer components; rows that take no part are gone."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return df.where(
        F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, finite)
    ).select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint")).alias("vector"),
    )


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row for which ``is_query`` holds.

    ``query_block`` bounds what is collected and broadcast at a time.
    """
    spark = vectors.sparkSession
    all_rows = quantised(vectors, scale, vec_id, vector)
    asked = quantised(vectors.where(is_query), scale, vec_id, vector)
    blocks = max(1, math.ceil(asked.count() / query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    folder, schema = shared_folder(spark, "top-k"), "query_id bigint, rank int, vec_id bigint, score bigint"
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).select("id", "vector").toArrow().combine_chunks()
        queries = {}
        if rows.num_rows:
            ids, found = (rows.column(c).chunk(0) for c in ("id", "vector"))
            for at, own_ids, points in _by_length(ids, found):
                queries[points.shape[1]] = make_queries(own_ids, at, points, k)
        sent = spark.sparkContext.broadcast(queries)
        found = all_rows.mapInArrow(_search_task(sent, k, shard_rows, leaf_rows), SCHEMA)
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(folder)
        sent.destroy()
    return spark.read.schema(schema).parquet(folder)
