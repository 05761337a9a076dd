"""Exact Jaccard self-join of word shingle sets by a token-group matrix; connected classes of documents.

Equal sets are one class, so copies never meet each other. For the rest:

1. Tokens (shingle hashes) get a global order: rarest first by a fixed-size count sketch of the whole
   corpus, then by hash. Any order gives the same result; this one keeps passages that many documents
   share out of the prefixes below. Two sets that are similar enough share ``SHARED`` tokens among the
   first ``n - ceil(t * n) + SHARED`` of each (or all they have to share, if that is less). So only those
   are compared at first, and only classes of which that many are held by a second class too.
2. Classes are grouped with those that share their most common such token and are about as large. A group
   holds a bounded number of tokens; beyond that it is split by hash.
3. The token-group matrix holds the union of each group's prefix tokens, one row for each token and
   group, with the group's sizes and the token's first position. A class looks its prefix up there, and
   visits the groups where sizes and positions still allow a link. Its cost is groups, not pairs.
4. Where a class visits a group, its overlap with the union of the group's whole sets is counted first;
   only if that could be enough the group is opened and the overlaps with its members are counted, all
   at once. Visitors of a group come in bounded chunks. Of the links found in a chunk, those that
   connect what was not connected yet are kept; the classes come out the same.
5. Connected components of those links by repeated contraction.

Where only the components are asked for, a family of near copies is connected first: classes that share a token
with more classes than a group holds make one visit each, to a group that the whole family names. Steps 3 and 4
then leave out what would meet its own component only, so visits grow with the family and not with its square.

Whole sets are not stored for all documents: those of classes that visit or are visited are made from the
texts a second time, found by a fixed-size bitmap, and joined by class.

Tokens and classes are told apart by 64-bit hashes. Words are runs without white space, A-Z lower-cased. A
text with fewer words than a shingle has one shingle, all its words.

Defined results: a null or empty text has no shingles and is linked with nothing. Rows that share an id are
judged each by its text; the class id is the smallest id of all rows connected. A null id is never the
smallest; if no row of a class has an id, its class id is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from beneflow.llm.frames import Steps, by_slice, free_name, record_batch, stored
from beneflow.llm.words import mix, shingles, slices, words

SHINGLE = 3
# Links have 100 * intersection >= PERCENT * union.
PERCENT = 90
SLOTS = 1 << 20
SLOT_BLOCK = 1 << 12
BITMAP = 1 << 20
GROUP_TOKENS = 50_000
GROUP_CLASSES = 64
CHUNK_TOKENS = 400_000
CHUNK_VISITORS = 256
ROUNDS = 100
# Prefix tokens that a link needs in common. More make prefixes longer and chance visits rarer.
SHARED = 8


def least_overlap(n, m, percent: int = PERCENT):
    """Shared tokens that sets of these sizes need, for numbers, arrays and columns alike."""
    need = percent * (n + m)
    if isinstance(need, Column):
        return F.ceil(need / (100 + percent))
    return -(-need // (100 + percent))


def _sets(part: pa.RecordBatch, size: int, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    return shingles(words(part.column(text)), size)


def _class_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


# --- 1. token order and signatures ------------------------------------------------------------


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def token_ranks(texts: DataFrame, size: int) -> np.ndarray:
    """Rank 0 to 255 of every slot of the sketch, by how many shingles of the corpus fall into it."""
    blocks = SLOTS // SLOT_BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                counts += np.bincount(_slot(_sets(part, size)[0]), minlength=SLOTS)
        if counts.any():
            some = [counts[b * SLOT_BLOCK : (b + 1) * SLOT_BLOCK].tobytes() for b in range(blocks)]
            salt = TaskContext.get().partitionId() % 64
            yield record_batch(
                block=pa.array(range(blocks), pa.int32()), salt=pa.array([salt] * blocks, pa.int32()), counts=some
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLOT_BLOCK, dtype=np.int64)
        for row in table.column("counts"):
            total += np.frombuffer(row.as_buffer(), np.int64)
        return pa.table({
            "block": table.column("block").slice(0, 1), "salt": table.column("salt").slice(0, 1),
            "counts": pa.array([total.tobytes()], pa.binary()),
        })

    schema = "block int, salt int, counts binary"
    # Two rounds, so that no task adds the counters of all others.
    counted = texts.select("text").mapInArrow(count, schema)
    counted = counted.groupBy("block", "salt").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    totals = np.zeros(SLOTS)
    for row in counted.toLocalIterator():
        totals[row.block * SLOT_BLOCK : (row.block + 1) * SLOT_BLOCK] = np.frombuffer(row.counts, np.int64)
    return np.minimum(255, 8 * np.log2(1 + totals)).astype(np.uint8)


def signatures(texts: DataFrame, ranks: np.ndarray, size: int, percent: int) -> DataFrame:
    """(doc_id, n, class, prefix): set size, hash of the set, its first tokens in the global order."""
    sent = texts.sparkSession.sparkContext.broadcast(ranks)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = _sets(part, size)
        # A rank, then 56 bits of the hash: still a name for the token, now in order.
        keys = (sent.value[_slot(hashes)].astype(np.uint64) << np.uint64(56)) | (mix(hashes) >> np.uint64(8))
        sizes = np.diff(first)
        classes, prefixes = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            classes.append(_class_of(hashes[a:b]) if b > a else None)
            take = min(b - a, b - a - -(-percent * (b - a) // 100) + SHARED)
            own = keys[a:b]
            prefixes.append(np.sort(np.partition(own, take - 1)[:take] if take < b - a else own))
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
        flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
        return record_batch(
            doc_id=part.column("doc_id"), n=sizes.astype(np.int64), cls=pa.array(classes, pa.int64()),
            prefix=pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
        )

    return by_slice(texts, make, "doc_id bigint, n bigint, cls bigint, prefix array<bigint>")


# --- 2. to 4. groups, visits, links -----------------------------------------------------------


def grouped(classes: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """(cls, n, group_token, group_size, salt, tokens): classes that share a prefix token with another."""
    postings = classes.select("cls", "n", F.posexplode("prefix").alias("pos", "token"))
    counts = postings.groupBy("token").agg(F.count("*").alias("classes")).where(F.col("classes") > 1)
    live = postings.join(steps.keep(counts, "common-tokens"), "token")
    members = live.groupBy("cls", "n").agg(
        F.collect_list(F.struct("pos", "token")).alias("tokens"),
        F.max(F.struct("classes", "token")).alias("most"),
    ).where(F.size("tokens") >= F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100)))
    # About as large: within a quarter. Beyond its bound of tokens or classes a group is split.
    size = F.floor(F.log("n") / F.log(F.lit(1.25))).cast("int")
    parts = F.ceil(F.col("most.classes") / F.greatest(F.lit(1), F.least(F.lit(GROUP_CLASSES), F.floor(GROUP_TOKENS / F.col("group_n")))))
    return (
        members.withColumn("group_size", size)
        .withColumn("group_n", F.ceil(F.pow(F.lit(1.25), F.col("group_size") + 1)))
        .select("cls", "n", F.col("most.token").alias("group_token"), "group_size",
                F.pmod(F.xxhash64("cls"), parts).cast("int").alias("salt"), "tokens")
    )


GROUP = ["group_token", "group_size", "salt"]


def postings_of(members: DataFrame, *more: str) -> DataFrame:
    """(cls, n, group, more, pos, token): a row for each prefix token that a member shares with another class."""
    rows = members.select("cls", "n", *GROUP, *more, F.explode("tokens").alias("t"))
    return rows.select("cls", "n", *GROUP, *more, "t.pos", "t.token")


def first_visits(members: DataFrame) -> DataFrame:
    """(cls, n, group): for classes with tokens that more than a group's number of classes have, one group to visit first.

    Every such token names the fullest of the groups that have it, and a class visits the one that most of its
    tokens name. So a family of near copies meets in one group, and each of its classes makes one visit there.
    """
    full = members.groupBy(*GROUP).agg(F.count("*").alias("full"))
    rows = postings_of(members.join(full, GROUP), "full")
    group = F.struct("full", F.xxhash64(*GROUP).alias("place"), *GROUP)
    named = rows.groupBy("token").agg(F.count("*").alias("classes"), F.max(group).alias("named"))
    named = named.where(F.col("classes") > GROUP_CLASSES).select("token", "named")
    tokens = rows.select("cls", "n", "token").join(named, "token").groupBy("cls", "n", "named").agg(F.count("*").alias("tokens"))
    first = tokens.groupBy("cls", "n").agg(F.max(F.struct("tokens", "named")).alias("most"))
    return first.select("cls", "n", *[F.col(f"most.named.{c}").alias(c) for c in GROUP])


def visits(members: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """(cls, n, group): groups that a class may have a link in, by shared prefix tokens, sizes and positions.

    The tokens shared with the union of a group are at least those shared with any member. Of two sets the larger one visits.
    Members may have a ``root``, which says what is connected by now. Then only what could connect different roots
    is visited: tokens that one root alone has are left out, and so are groups whose holders of a token share the visitor's root.
    """
    rooted = ["root"] if "root" in members.columns else []
    rows = postings_of(members, *rooted)
    if rooted:
        apart = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
        rows = steps.keep(rows.join(apart, "token"), "tokens-apart")
    n = F.col("n")
    looked_up = F.col("pos") < n - least_overlap(n, n, percent) + SHARED
    matrix = rows.where(looked_up).groupBy("token", *GROUP).agg(
        F.min("pos").alias("first"), F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.count("*").alias("having"),
        *([F.min("root").alias("root_low"), F.max("root").alias("root_high")] if rooted else []),
    )
    least = F.greatest(F.col("n_low"), F.ceil(n * percent / 100))
    most = F.least(F.col("n_high"), n)
    own = F.lit(True)
    for c in GROUP:
        own &= F.col(f"q.{c}") == F.col(f"m.{c}")
    may_link = (
        (least <= most)
        & (F.col("pos") < n - least_overlap(n, least, percent) + SHARED)
        & (F.col("first") < most - least_overlap(n, most, percent) + SHARED)
        # A class does not visit its own group for a token that only it is looked up by there.
        & ~(own & (F.col("having") == 1) & looked_up)
    )
    if rooted:
        may_link &= (F.col("root_low") != F.col("q.root")) | (F.col("root_high") != F.col("q.root"))
    found = rows.alias("q").join(steps.keep(matrix, "token-groups").alias("m"), (F.col("q.token") == F.col("m.token")) & may_link)
    needed = F.least(F.lit(SHARED), F.min(least_overlap(n, least, percent)))
    return (
        found.groupBy("cls", "n", *[F.col(f"m.{c}").alias(c) for c in GROUP])
        .agg(F.count("*").alias("shared"), needed.alias("needed"))
        .where(F.col("shared") >= F.col("needed"))
        .drop("shared", "needed")
    )


def whole_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, tokens) of at least the ``wanted`` classes, once each."""
    slot = F.pmod("cls", F.lit(BITMAP)).cast("int")
    bitmap = np.zeros(BITMAP, dtype=bool)
    bitmap[[r.slot for r in wanted.select(slot.alias("slot")).distinct().collect()]] = True
    sent = texts.sparkSession.sparkContext.broadcast(bitmap)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = _sets(part, size)
        classes, tokens = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b > a and sent.value[(own := _class_of(hashes[a:b])) % BITMAP]:
                classes.append(own)
                tokens.append(hashes[a:b].tobytes())
        return record_batch(cls=pa.array(classes, pa.int64()), set=pa.array(tokens, pa.binary()))

    found = by_slice(texts.select("text"), make, "cls bigint, set binary")
    return found.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("set").alias("set"))


class Forest:
    """Which of a few things are connected so far."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def open_group(
    members: list[tuple[int, np.ndarray]], visitors: list[tuple[int, np.ndarray]], percent: int, both_ways: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, new): links of visitors a with members b of a smaller size or hash (``both_ways``: with any but
    themselves); whether one connects anything new.
    """
    sizes = np.array([len(s) for _, s in members])
    names = np.array([c for c, _ in members], dtype=np.int64)
    flat, owner = np.concatenate([s for _, s in members]), np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    union, begin = np.unique(flat, return_index=True)
    many = np.diff(np.append(begin, len(flat)))
    forest, a, b, new = Forest(), [], [], []
    for cls, tokens in visitors:
        at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
        at = at[union[at] == tokens]
        # The overlap with the union bounds that with any member.
        if not both_ways and 100 * len(at) < percent * len(tokens):
            continue
        n = many[at]
        hits = owner[np.repeat(begin[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        shared = np.bincount(hits, minlength=len(members))
        similar = 100 * shared >= percent * (len(tokens) + sizes - shared)
        partner = (names != cls) if both_ways else (sizes < len(tokens)) | (sizes == len(tokens)) & (names < cls)
        found = names[similar & partner].tolist()
        a += [cls] * len(found)
        b += found
        new += [forest.join(cls, other) for other in found]
    return np.array(a, np.int64), np.array(b, np.int64), np.array(new, bool)


def links(
    texts: DataFrame, members: DataFrame, visiting: DataFrame, size: int, percent: int, steps: Steps, every: bool = False,
    both_ways: bool = False,
) -> DataFrame:
    """(a, b, links): links between classes that connect all that any link connects, with 0, and (a, a) with
    numbers of links that add up to those of a. ``every``: each link once instead, with 1. ``both_ways``: visitors are
    linked with larger sets too, so that a link may be found twice.
    """
    load = F.greatest(F.ceil(F.sum("n") / CHUNK_TOKENS), F.ceil(F.count("*") / CHUNK_VISITORS)).cast("int")
    chunks = steps.keep(visiting.groupBy(*GROUP).agg(load.alias("chunks")), "visited")
    inside = members.join(chunks, GROUP)
    guests = visiting.join(chunks, GROUP).select(
        "cls", *GROUP, F.pmod(F.xxhash64(F.lit("chunk"), F.col("cls")), "chunks").cast("int").alias("chunk"), F.lit(True).alias("visits")
    )
    hosts = inside.select(
        "cls", *GROUP, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("visits")
    )
    present = steps.keep(guests.unionByName(hosts), "present")
    # Sets stay dealt out by class for the join, so they are shuffled to their class and to their groups only.
    sets = whole_sets(texts, steps.keep(present.select("cls").distinct(), "wanted"), size)

    def make(table: pa.Table) -> pa.Table:
        sides: tuple[list, list] = ([], [])
        for cls, own, visits in zip(*(table.column(c) for c in ("cls", "set", "visits")), strict=True):
            sides[visits.as_py()].append((cls.as_py(), np.frombuffer(own.as_buffer(), np.uint64)))
        a, b, new = open_group(*sides, percent, both_ways) if all(sides) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        counts = np.ones(len(a), np.int64)
        if not every:
            linked, counts = np.unique(np.concatenate([a, b]), return_counts=True)
            a, b = np.concatenate([a[new], linked]), np.concatenate([b[new], linked])
            counts = np.concatenate([np.zeros(new.sum(), np.int64), counts.astype(np.int64)])
        return pa.table({"a": a, "b": b, "links": counts})

    seated = present.join(sets, "cls").select(*GROUP, "chunk", "cls", "visits", "set")
    return seated.groupBy(*GROUP, "chunk").applyInArrow(make, "a bigint, b bigint, links bigint")


# --- 5. components ------------------------------------------------------------------------------


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the smallest node connected.

    Nodes are merged with the first of their neighbours in a random order, and edges between the merged
    nodes are all that is left for the next round, so edges become few quickly.
    """
    node = lambda c: F.struct(F.xxhash64(c).alias("place"), F.col(c).alias("id"))

    def open_edges(df: DataFrame) -> DataFrame:
        """Edges between different nodes, each once."""
        return df.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    left = steps.keep(open_edges(edges.select(node("a").alias("a"), node("b").alias("b"))), "edges-0")
    roots = steps.keep(left.select("a").union(left.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("root")), "roots-0")
    for i in range(1, ROUNDS + 1):
        if left.isEmpty():
            break
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        first = both.groupBy("node").agg(F.least("node", F.min("other")).alias("up"))
        # A node's first neighbour has one itself: two steps at once.
        next_up = first.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        ups = steps.keep(first.join(next_up, "up").select("node", F.col("upper").alias("up")), f"ups-{i}")
        moved = left
        for end in ("a", "b"):
            moved = moved.join(ups.withColumnsRenamed({"node": end, "up": f"{end}_up"}), end)
        left = steps.keep(open_edges(moved.select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))), f"edges-{i}")
        higher = roots.join(ups.withColumnsRenamed({"node": "root"}), "root", "left")
        roots = steps.keep(higher.select("node", F.coalesce("up", "root").alias("root")), f"roots-{i}")
    else:
        raise RuntimeError(f"components are not done after {ROUNDS} rounds")
    smallest = roots.groupBy("root").agg(F.min("node.id").alias("smallest"))
    return roots.join(smallest, "root").select(F.col("node.id").alias("node"), F.col("smallest").alias("root"))


def connecting(texts: DataFrame, members: DataFrame, size: int, percent: int, steps: Steps) -> DataFrame:
    """(a, b): links that connect all classes that any links connect, in visits that do not grow with a family's square.

    One visit of each class of a family first; then only what that has left apart is looked for.
    """
    spark, early = texts.sparkSession, None
    visiting = steps.keep(first_visits(members), "first-visits")
    if not visiting.isEmpty():
        own = Steps(spark, "first-links")
        early = steps.keep(links(texts, members, visiting, size, percent, own, both_ways=True).where("a != b").select("a", "b"), "first-links")
        roots = components(early, own).withColumnRenamed("node", "cls")
        members = steps.keep(members.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
        own.drop()
    visiting = steps.keep(visits(members, percent, steps), "visits")
    found = steps.keep(links(texts, members, visiting, size, percent, steps).where("a != b").select("a", "b"), "links")
    return found if early is None else early.union(found)


def _linked(
    docs: DataFrame, size: int, percent: int, doc_id: str, text: str, steps: Steps, every: bool = False, counts: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of the rows, their classes with the smallest id, and the ``links``; without ``every`` or ``counts``
    only ``connecting`` ones.
    """
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = steps.keep(signatures(texts, token_ranks(texts, size), size, percent), "signatures")
    classes = steps.keep(
        signed.where(F.col("cls").isNotNull()).groupBy("cls", "n").agg(F.min("doc_id").alias("least"), F.first("prefix").alias("prefix")),
        "classes",
    )
    members = steps.keep(grouped(classes, percent, steps), "members")
    if not (every or counts):
        return signed, classes, connecting(texts, members, size, percent, steps)
    visiting = steps.keep(visits(members, percent, steps), "visits")
    return signed, classes, steps.keep(links(texts, members, visiting, size, percent, steps, every), "links")


def similar_classes(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", counts: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    With ``counts`` also (class, class_id, n_links, component_links): the hash of its set, the smallest id that has
    the same set, with how many other sets that one is linked, and how many links its component has.
    """
    steps = Steps(docs.sparkSession, "jaccard-join")
    signed, classes, found = _linked(docs, size, percent, doc_id, text, steps, counts=counts)
    rows = stored(signed.select("doc_id", "n", "cls"), "rows")
    roots = components(found.select("a", "b"), steps)
    linked = classes.select("cls", "least").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    # The root stands for its class; classes without a link are their own.
    linked = linked.withColumn("root", F.coalesce("root", "cls"))
    more = []
    if counts:
        each = found.where(F.col("a") == F.col("b")).groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("n_links"))
        linked = linked.join(each, "cls", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("bigint")))
        # Both ends have counted a link.
        more = [(F.sum("n_links") / 2).cast("bigint").alias("component_links")]
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"), *more)
    names = linked.join(smallest, "root").select("cls", "component_id", *(["least", "n_links", "component_links"] if counts else []))
    names = stored(names, "names")
    steps.drop()
    none = F.lit(0).cast("bigint")
    return rows.join(names, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        *([F.col("cls").alias("class"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
           *(F.coalesce(c, none).alias(c) for c in ("n_links", "component_links"))] if counts else []),
    )


def similar_pairs(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(class_a, class_b, id_a, id_b): every link between different sets once, with the smallest id that holds each.

    Rows belong to a class by ``class`` of ``similar_classes``. The links of a family grow with its square.
    """
    steps = Steps(docs.sparkSession, "jaccard-pairs")
    _, classes, found = _linked(docs, size, percent, doc_id, text, steps, every=True)
    pairs = found.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"))
    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cls").alias(f"class_{end}"), F.col("least").alias(f"id_{end}")), f"class_{end}")
    pairs = stored(pairs.select("class_a", "class_b", "id_a", "id_b"), "pairs")
    steps.drop()
    return pairs


def with_class(docs: DataFrame, name: str, size: int, text: str) -> DataFrame:
    """The rows with the hash of their set as one more column; NULL where a text has no shingles."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = _sets(part, size, text)
        bounds = zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
        return part.append_column(name, pa.array([_class_of(hashes[a:b]) if b > a else None for a, b in bounds], pa.int64()))

    return by_slice(docs, make, StructType([*docs.schema.fields, StructField(name, LongType())]), text)


def one_of_each(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row, with all its columns, of every connected component of texts, and all rows without a shingle.

    The row with the smallest id stays, a null id being the last; of rows that share it, the one with the
    smallest hash of its set, then the smallest text, then the smallest row as JSON.
    """
    steps = Steps(docs.sparkSession, "one-of-each")
    _, classes, found = _linked(docs, size, percent, doc_id, text, steps)
    roots = components(found.select("a", "b"), steps).withColumnRenamed("node", "cls")
    linked = classes.select("cls", "least").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    cls, chosen, row = (free_name(docs, wish) for wish in ("class", "chosen_id", "row"))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "cls")).alias("first")
    stay = linked.groupBy("root").agg(first).select(F.col("first.cls").alias(cls), F.col("first.least").alias(chosen))
    stay = stored(stay, "staying")
    steps.drop()
    named = with_class(docs, cls, size, text)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own_id = F.col(f"`{doc_id}`").cast("bigint")
    kept = named.join(stay, cls).where(own_id.eqNullSafe(F.col(chosen)))
    order = F.struct(F.col(f"`{text}`").alias("text"), F.to_json(whole).alias("json"))
    kept = kept.groupBy(cls).agg(F.min_by(whole, order).alias(row)).select(f"{row}.*")
    return kept.union(named.where(F.col(cls).isNull()).drop(cls))
