"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.session import delete_path, materialize

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_P = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, all spans at once.

    The polynomial prefix hash of the buffer is one cumulative sum; a span's
    hash is the difference at its ends times the inverse power of its start,
    so equal bytes hash equally wherever they stand.
    """

    def __init__(self) -> None:
        self._pow = self._inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._pow) < n:
            size = max(n, 2 * len(self._pow), 1 << 16)
            def powers(base: int) -> np.ndarray:
                out = np.full(size, np.uint64(base), np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)
            self._pow, self._inv = powers(_P), powers(_P_INV)

    def __call__(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        b = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        self._grow(len(b) + 1)
        prefix = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(b * self._pow[: len(b)], out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * self._inv[starts])


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``b" ".join(words)`` (no empty words)."""
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))


def shingle_hashes(hasher: SpanHasher, words: list[bytes], k: int) -> np.ndarray:
    """Hashes of all ``k``-word shingles in order; fewer words give one shingle, none give none."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    starts, ends = word_bounds(joined)
    if len(starts) < k:
        return hasher(joined, starts[:1], ends[-1:])
    return hasher(joined, starts[: len(starts) - k + 1], ends[k - 1:])


def runs_of(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of the runs of equal ``by``; rows come sorted by it and runs may span batches."""
    rows = itertools.chain.from_iterable(
        zip(zip(*[pdf[c].tolist() for c in by]), pdf.itertuples(index=False, name=None)) for pdf in batches)
    for key, run in itertools.groupby(rows, key=lambda r: r[0]):
        yield key, [r[1] for r in run]


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns named c0, c1, ..., which no other name here clashes with; and old name -> new name."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def merge_labels(label: np.ndarray, members: np.ndarray) -> bool:
    """Give all that share a label with ``members`` the least of these labels; is all one now?

    ``label`` starts as ``arange``: a label is the least index of its group.
    """
    found = np.unique(label[members])
    if len(found) > 1:
        label[np.isin(label, found)] = found[0]
    return not label.any()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``u``, ``v``), component = least node.

    Alternating large-star / small-star rounds: each is a grouped minimum and a
    join, both partitioned on the node, and each round's edges are written to
    the shared folder, which cuts the lineage and survives lost executors.
    One number per round reaches the driver.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        near = e.union(e.select("v", "u")).toDF("u", "v") if large else \
            e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m"))
        pulled = near.join(low, near.u == low.c)
        if large:
            out = pulled.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("c", "m"))
        return out.where("u <> v").distinct()

    def unfinished(e: DataFrame) -> int:
        """Nodes with two parents, or with a parent and children: 0 if every component is a star."""
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").count()

    kept: list[str] = []
    cur = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), f"{name}_e", kept)
    while unfinished(cur):
        cur = materialize(star(star(cur, True), False), f"{name}_e", kept)
        if len(kept) > 2:
            delete_path(spark, kept.pop(0))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select("v", "v").distinct())


def bounded_parts(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices that hold about ``size`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        widths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(widths.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in itertools.pairwise(cuts):
            if b > a:
                yield batch.slice(a, b - a)
