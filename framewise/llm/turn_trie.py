"""Prefix trie of conversations: adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes of a SHA-256 of its role and text, so that a
conversation is a byte string and its depth-d prefix the first 16 d bytes.
Conversations are cut into segments of ``STEP`` turns; a segment's tree is named
by the prefix before it.  Equal segments are folded, dealt by ranges of (place,
prefix, bytes) and every task builds radix trees over its range, giving the
sums of each turn-aligned node; sums of one node from several tasks are added.
No task holds more than ``TOGETHER`` segments, however common a turn, a prefix or a
whole conversation is, and however long a conversation.

Figures of whole subtrees are sums over members too, so no step goes down or up
the depths: every node is charged to its smallest member (from some depth on,
the nodes of a conversation are its own), and a member's tail, less what is its
own, is what sharing saves.

Prefixes are named by four running sums of 32-bit words hashed from (place,
turn id): 128 bits, computed by windows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewise.llm.common import materialize
from framewise.llm.radix_tree import RadixTree
from framewise.session import scratch

WIDTH = 16
STEP = 8
#: Segments in the trees of a task at a time.
TOGETHER = 50_000
#: Turns whose running sums one task makes; 2**BLOCK neighbouring ids are one row of a digest.
CHUNK, BLOCK = 1024, 12
BORROWED = 9

_WORDS = [f"w{i}" for i in range(4)]
_SEGMENT = ["s", "prefix", "key", "ids", "sizes"]


def numbered(turns: DataFrame, kept: list[str]) -> DataFrame:
    """``turns`` with rank (from 1 in conv_id by turn, role, text) and n (turns of conv_id).

    Rows are dealt by ranges of the whole order, repeated rows by their place
    in the table, so a conversation of any size is dealt over many tasks; only
    its count in each range meets in one place.
    """
    order = ["conv_id", "turn", "role", "text", "u"]
    placed = turns.withColumn("u", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("u")
    placed = materialize(placed.withColumn("at", F.monotonically_increasing_id()), "trie_turns", kept)
    placed = placed.withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = W.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           F.sum("n").over(whole).alias("n"))
    return placed.join(counts, ["conv_id", "part"]).select(
        "conv_id", "part", "role", "text", (F.col("base") + F.col("at") - F.col("first") + 1).alias("rank"), "n")


def borrow_heads(conversations: DataFrame, kept: list[str], modulus: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, len) of each, and (conv_id, len, pos, role, text) of their turns.

    Conversation c takes the first h turns of conversation c - c % ``modulus``
    (h = crc32(c) % 9; all if it has fewer) and goes on with its own after its first h.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ranked = numbered(turns, kept)
    parts = ranked.groupBy("conv_id", "part").agg(F.max("n").alias("n"))
    all_ = parts.groupBy("conv_id").agg(F.max("n").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    plan = all_.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % modulus)
    plan = plan.join(all_.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    plan = plan.withColumn("got", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = plan.withColumn("len", F.col("got") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    plan = materialize(plan.select("conv_id", "base", "h", "got", "len"), "trie_plan", kept)
    # A range's rows meet their conversation's plan by (conversation, range), so that no conversation meets it whole.
    by_part = parts.select("conv_id", "part").join(plan, "conv_id").drop("base")
    own = ranked.join(by_part, ["conv_id", "part"]).where("rank > h").select(
        "conv_id", "len", (F.col("rank") - F.col("h") + F.col("got")).alias("pos"), "role", "text")
    heads = ranked.where(F.col("rank") < BORROWED).select(F.col("conv_id").alias("base"), "rank", "role", "text")
    taken = heads.join(plan, "base").where("rank <= h").select("conv_id", "len", F.col("rank").alias("pos"), "role", "text")
    return plan.select("conv_id", "len"), own.union(taken)


def segments(members: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, len, s, prefix, key, ids, sizes, t: segment s of each conversation, t turns long.

    ``key`` holds its turn ids, ``ids`` and ``sizes`` the names and the text
    bytes of the prefixes from its start (``prefix``) on, one more than turns.
    A conversation without turns has one empty segment.
    """
    tid = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * WIDTH)
    rows = turns.select("conv_id", "len", "pos", tid.alias("tid"), F.octet_length("text").cast("bigint").alias("size"))
    hashed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "tid"), 256)
    rows = rows.withColumn("hashed", hashed).select(
        "conv_id", "len", "pos", "tid", "size", F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"),
        *(F.conv(F.substring("hashed", 8 * i + 1, 8), 16, 10).cast("bigint").alias(w) for i, w in enumerate(_WORDS)))
    summed = [*_WORDS, "size"]
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    bases = rows.groupBy("conv_id", "chunk").agg(*(F.sum(c).alias(c) for c in summed)).select(
        "conv_id", "chunk", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_base") for c in summed))
    inside = W.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.join(bases, ["conv_id", "chunk"])
    rows = rows.select("conv_id", "len", "pos", "tid", "size",
                       *((F.col(f"{c}_base") + F.sum(c).over(inside)).alias(f"{c}_sum") for c in summed),
                       *(F.col(w) for w in _WORDS))

    def name(less: bool):
        return F.concat(*(F.lpad(F.hex((F.col(f"{w}_sum") - (F.col(w) if less else F.lit(0))).bitwiseAND(F.lit(0xFFFFFFFF))),
                                 8, "0") for w in _WORDS))

    turn = F.struct("pos", "tid", name(False).alias("id"), F.col("size_sum").alias("sum"), name(True).alias("id_before"),
                    (F.col("size_sum") - F.col("size")).alias("sum_before"))
    cut = rows.select("conv_id", "len", F.floor((F.col("pos") - 1) / STEP).alias("s"), turn.alias("turn")).groupBy(
        "conv_id", "len", "s").agg(F.array_sort(F.collect_list("turn")).alias("t"))

    def bytes_of(hexes):
        return F.unhex(F.array_join(hexes, ""))

    cut = cut.select("conv_id", "len", "s", F.unhex(F.col("t")[0]["id_before"]).alias("prefix"), bytes_of(F.col("t.tid")).alias("key"),
                     bytes_of(F.concat(F.array(F.col("t")[0]["id_before"]), F.col("t.id"))).alias("ids"),
                     F.concat(F.array(F.col("t")[0]["sum_before"]), F.col("t.sum")).alias("sizes"), F.size("t").alias("t"))
    root = F.unhex(F.lit("00" * WIDTH))
    empty = members.where("len = 0").select(
        "conv_id", "len", F.lit(0).cast("bigint").alias("s"), root.alias("prefix"), F.unhex(F.lit("")).alias("key"),
        root.alias("ids"), F.array(F.lit(0).cast("bigint")).alias("sizes"), F.lit(0).alias("t"))
    return cut.union(empty)


class _Sums:
    """What the members below a node add up to: one column for each depth of the segment."""

    __slots__ = ("least", "table", "ids", "sizes")

    def __init__(self, least, table, ids, sizes) -> None:
        self.least, self.table, self.ids, self.sizes = least, table, ids, sizes

    @staticmethod
    def merge(a: _Sums, b: _Sums) -> _Sums:
        return _Sums(min(a.least, b.least), a.table + b.table, a.ids, a.sizes)


def node_sums(folded: DataFrame, values: list[str], kept: list[str], name: str) -> DataFrame:
    """Radix trees over folded segments: flush, real, depth, id, parent, sum_bytes, bytes, least and the sums of ``values``.

    ``folded``: the columns of a segment, ``least`` (a conv_id) and for each of
    ``values`` an array with its sums by depth in the segment.  A flush is one
    filling of a task's trees; rows that are not ``real`` only say that the
    start of a later segment was seen in it.
    """
    k = len(values)

    def given(tree: RadixTree, s: int, flush: int) -> Iterator[tuple]:
        for j, sums in tree.totals(WIDTH):
            here = bytes(sums.ids[WIDTH * j: WIDTH * (j + 1)])
            if j:
                yield (flush, True, s * STEP + j, here, bytes(sums.ids[WIDTH * (j - 1): WIDTH * j]), int(sums.sizes[j]),
                       int(sums.sizes[j] - sums.sizes[j - 1]), sums.least, *sums.table[:, j].tolist())
            else:
                real = s == 0
                yield (flush, real, s * STEP, here, None, 0, 0, sums.least, *(sums.table[:, 0] * real).tolist())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, flush, held, out, tree, unit = TaskContext.get().partitionId() << 32, 0, 0, [], None, None
        names = ["flush", "real", "depth", "id", "parent", "sum_bytes", "bytes", "least", *values]
        rows = itertools.chain.from_iterable(f.itertuples(index=False) for f in frames)
        for r in rows:
            if unit != (r.s, r.prefix) or held >= TOGETHER:
                if tree is not None:
                    out.extend(given(tree, unit[0], base + flush))
                if held >= TOGETHER:
                    flush, held = flush + 1, 0
                if len(out) >= TOGETHER:
                    yield pd.DataFrame(out, columns=names)
                    out = []
                unit, tree = (r.s, r.prefix), RadixTree(_Sums.merge)
            table = np.zeros((k, STEP + 1), np.int64)
            for i, v in enumerate(values):
                own = getattr(r, v)
                table[i, : len(own)] = own
            tree.insert(bytes(r.key), _Sums(r.least, table, r.ids, r.sizes))
            held += 1
        if tree is not None:
            out.extend(given(tree, unit[0], base + flush))
        yield pd.DataFrame(out, columns=names)

    schema = ("flush bigint, real boolean, depth bigint, id binary, parent binary, sum_bytes bigint, bytes bigint, least bigint, "
              + ", ".join(f"{v} bigint" for v in values))
    keys = ["s", "prefix", "key"]
    dealt = materialize(folded, f"{name}_folded", kept).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(dealt.mapInPandas(run, schema), name, kept)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, id, ends_sha256) from (depth, id, conv_id): the ids in ascending order, comma-joined.

    Neighbouring ids are joined first, so a node's task reads one row for up to
    2**BLOCK ids and keeps none of them.
    """
    near = ends.groupBy("depth", "id", F.shiftright("conv_id", BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = itertools.chain.from_iterable(f.itertuples(index=False) for f in frames)
        done = []
        for (depth, node), own in itertools.groupby(rows, key=lambda r: (r.depth, r.id)):
            sha = hashlib.sha256()
            for i, r in enumerate(own):
                sha.update(("," if i else "").encode() + r.ids.encode())
            done.append((depth, node, sha.hexdigest()))
            if len(done) >= TOGETHER:
                yield pd.DataFrame(done, columns=["depth", "id", "ends_sha256"])
                done = []
        yield pd.DataFrame(done, columns=["depth", "id", "ends_sha256"])

    return near.repartition("depth", "id").sortWithinPartitions("depth", "id", "block").mapInPandas(
        run, "depth bigint, id binary, ends_sha256 string")


def trie(members: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``members``: conv_id (unique), len; ``turns``: conv_id, len, pos (1 to len),
    role, text, none of them null.  Conversations without turns are members of
    the root.  Without conversations there is no root either.  Intermediate
    tables are deleted; the result is a table under the shared folder.
    """
    with scratch(members.sparkSession) as kept:
        cut = materialize(segments(members, turns), "trie_segments", kept)
        last = F.col("len") == F.col("s") * STEP + F.col("t")
        places = F.sequence(F.lit(0), F.col("t"))

        counted = cut.groupBy(*_SEGMENT, "t").agg(F.min("conv_id").alias("least"), F.count("*").alias("n"),
                                                  F.sum(last.cast("bigint")).alias("e"))
        counted = counted.select(*_SEGMENT, "least", F.transform(places, lambda j: F.col("n")).alias("n_convs"),
                                 F.transform(places, lambda j: F.when(j == F.col("t"), F.col("e")).otherwise(0)).alias("n_ends"))
        partial = node_sums(counted, ["n_convs", "n_ends"], kept, "trie_counts")
        nodes = materialize(partial.where("real").groupBy("depth", "id", "parent", "sum_bytes", "bytes").agg(
            F.min("least").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"),
            F.min("flush").alias("flush")), "trie_nodes", kept)

        # From depth ``own`` on, a conversation is the smallest member of its nodes; ``upto``: its text bytes before.
        owner = nodes.groupBy("conv_id").agg(
            F.min(F.struct("depth", (F.col("sum_bytes") - F.col("bytes")).alias("upto"))).alias("top"),
            F.max((F.col("n_convs") == F.col("n_ends")).cast("bigint")).alias("leaf"))
        owner = owner.select("conv_id", F.col("top.depth").alias("own"), "top.upto", "leaf")
        whole = cut.where(last).select("conv_id", F.element_at("sizes", -1).alias("all"))
        shares = whole.join(owner, "conv_id", "left").select(
            "conv_id", F.coalesce("own", F.lit((1 << 62))).alias("own"), F.coalesce("upto", "all").alias("upto"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"))
        charged = cut.join(shares, "conv_id")
        depth = F.col("s") * STEP

        def saved(j: int):
            before = F.lit(0) if j == 0 else F.get("sizes", F.lit(j - 1))
            return F.sum(F.greatest(F.lit(0), F.col("upto") - before))

        def child(j: int):
            return F.sum(((F.col("own") <= depth + j + 1) & (depth + j + 1 <= F.col("len"))).cast("bigint"))

        charged = charged.groupBy(*_SEGMENT, "t").agg(
            F.min("conv_id").alias("least"), F.sum("leaf").alias("leaves"),
            *(saved(j).alias(f"saved{j}") for j in range(STEP + 1)), *(child(j).alias(f"child{j}") for j in range(STEP + 1)))
        charged = charged.select(
            *_SEGMENT, "least", F.transform(places, lambda j: F.col("leaves")).alias("n_leaves"),
            *(F.slice(F.array(*(f"{c}{j}" for j in range(STEP + 1))), 1, F.col("t") + 1).alias(to)
              for c, to in (("saved", "saved_tokens"), ("child", "n_children"))))
        sums = node_sums(charged, ["n_leaves", "saved_tokens", "n_children"], kept, "trie_sums").where("real").groupBy("depth", "id").agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_children").alias("n_children"))

        # A node's parent is looked up in the flush that gave the node: a common parent is there once for each flush.
        seen = partial.select("flush", "depth", "id").distinct().join(nodes.select("depth", "id", "conv_id"), ["depth", "id"])
        seen = seen.select("flush", (F.col("depth") + 1).alias("depth"), F.col("id").alias("parent"),
                           F.col("conv_id").alias("parent_conv_id"))
        ends = ends_digest(cut.where(last).select(F.col("len").alias("depth"), F.substring("ids", -WIDTH, WIDTH).alias("id"), "conv_id"))
        out = (nodes.join(seen, ["flush", "depth", "parent"], "left").join(sums, ["depth", "id"])
               .join(ends, ["depth", "id"], "left"))
        return materialize(out.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")), "trie")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``trie`` of the rebuilt conversations (``borrow_heads``) of conv_id, turn, role, text rows.

    Turns are ordered by turn (null first), role and text; repeated rows are
    turns of their own.  Null roles and texts are empty; rows without conv_id
    belong to no conversation and are left out.  Other columns are ignored.
    """
    with scratch(conversations.sparkSession) as kept:
        return trie(*borrow_heads(conversations, kept))
