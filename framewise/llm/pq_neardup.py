"""Embedding near-duplicates by product quantisation.

A coarse quantiser deals unit vectors to inverted lists; within a list every
vector is kept as one code per subspace of its residual, with the length of
what the codes miss.  A vector probes the lists that a vector within the
threshold is likely to lie in, asymmetric table look-ups bound its distance to each
member from below, and the pairs left get exact cosines in double precision.

The bound follows from the triangle inequality: of the probed lists no pair at
the threshold is lost.  A list is probed if a step of the threshold's length
could lead there with its share of ``SPREAD`` standard deviations of a random
direction: in d effective dimensions (of the sample's residuals) a direction
has 1 / sqrt(d) of its length along the way to another centre.  With ``spread``
None the whole length counts, and no pair at all is lost; random vectors then
probe a large part of all lists.  A pair that one side finds counts for both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import connected_components, materialize, merge_labels, runs_of

#: Members and queries of one block of a list.
BLOCK_MEMBERS, BLOCK_QUERIES = 2048, 4096
#: Queries whose look-up tables are held at once.
STEP = 256
#: Slack of the bounds for rounding.
EPS = 1e-6
#: Standard deviations of a random direction that probes allow for.
SPREAD = 4.0


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from evenly spaced points; empty cells keep their centre."""
    k = min(k, len(x))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def _square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_square_distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


@dataclass(frozen=True)
class Quantiser:
    coarse: np.ndarray          # lists x dims
    spans: list[slice]          # the subspaces
    books: list[np.ndarray]     # per subspace: codes x its dims
    along: float                # share of a step that may lead towards another centre

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = 16, spread: float | None = SPREAD) -> Quantiser:
        coarse = _kmeans(sample, lists)
        residual = sample - coarse[_nearest(sample, coarse)]
        spectrum = np.square(np.linalg.svd(residual - residual.mean(0), compute_uv=False))
        dims = spectrum.sum() ** 2 / max(np.square(spectrum).sum(), 1e-300)
        along = 1.0 if spread is None else min(1.0, spread / np.sqrt(max(dims, 1.0)))
        cuts = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
        spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        return cls(coarse, spans, [_kmeans(np.ascontiguousarray(residual[:, s]), codes) for s in spans], along)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes per subspace, and the length of what they miss."""
        codes = np.stack([_nearest(np.ascontiguousarray(residual[:, s]), b) for s, b in zip(self.spans, self.books)], 1)
        back = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], 1)
        return codes.astype(np.uint8), np.linalg.norm(residual - back, axis=1)

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """Vectors x lists: can a vector within ``radius`` of each ``x`` lie there?

        Such a vector lies nearest to its own centre, so ``x`` is at most
        ``radius`` (its part ``along`` the way) beyond the plane half way between that centre and its own.
        """
        d = _square_distances(x, self.coarse)
        own = d.argmin(1)
        gap = np.sqrt(_square_distances(self.coarse, self.coarse))[own]
        beyond = d - d[np.arange(len(x)), own][:, None]
        near = beyond <= 2 * gap * (radius * self.along + EPS) + EPS
        near[np.arange(len(x)), own] = True
        return near

    def lower_bounds(self, residual: np.ndarray, codes: np.ndarray, missed: np.ndarray) -> np.ndarray:
        """Queries x members: asymmetric distances to the coded members, less what the codes miss."""
        total = np.zeros((len(residual), len(codes)))
        for i, (s, b) in enumerate(zip(self.spans, self.books)):
            total += _square_distances(residual[:, s], b)[:, codes[:, i]]
        return np.sqrt(total) - missed


def _unit(raw: list) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in raw])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])  # exact; no square over- or underflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _deal(batches: Iterator[pd.DataFrame], index: dict[int, tuple[int, Quantiser]], radius: float) -> Iterator[pd.DataFrame]:
    """Each class as a member of its list (probe false) and as a query of every list it probes.

    ``index`` has the first list and the quantiser of each vector length.
    """
    for dims, pdf in ((d, part) for whole in batches for d, part in whole.groupby(whole["embedding"].map(len))):
        start, q = index[dims]
        x = _unit(pdf["embedding"].tolist())
        own = _nearest(x, q.coarse)
        codes, missed = q.encode(x - q.coarse[own])
        member = pdf[["label", "node", "size", "embedding"]].assign(
            list=start + own, probe=False, codes=[c.tobytes() for c in codes], missed=missed)
        at, to = np.nonzero(q.probes(x, radius))
        query = pdf.iloc[at][["label", "node", "size", "embedding"]].assign(
            list=start + to, probe=True, codes=None, missed=0.0)
        yield pd.concat([member, query], ignore_index=True)


def _search(batches: Iterator[pd.DataFrame], index: dict[int, tuple[int, Quantiser]], cosine: float) -> Iterator[pd.DataFrame]:
    """(u, v, n): per query its links' number and a member they share a group with; per member its group.

    A member that does not probe the list of a query that found it cannot find
    the query in turn: the link is counted for it here.
    """
    radius = np.sqrt(max(0.0, 2 - 2 * cosine))
    for (_, where, _, _), rows in runs_of(batches, ["label", "list", "mb", "qb"]):
        members, queries = [r for r in rows if not r[8]], [r for r in rows if r[8]]
        if not members or not queries:
            continue
        start, q = index[len(members[0][6])]  # a list has vectors of one length
        centre = q.coarse[where - start]
        names = np.array([r[4] for r in members])
        sizes = np.array([r[5] for r in members])
        x = _unit([r[6] for r in members])
        codes = np.stack([np.frombuffer(r[7], np.uint8) for r in members])
        missed = np.array([r[9] for r in members])
        label = np.arange(len(names))
        unseen = np.zeros(len(names), np.int64)
        us, ats, ns = [], [], []
        for i in range(0, len(queries), STEP):
            part = queries[i:i + STEP]
            y = _unit([r[6] for r in part])
            who = np.array([r[4] for r in part])
            near = q.lower_bounds(y - centre, codes, missed) <= radius + EPS
            near &= who[:, None] != names
            a, b = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(a):
                continue
            found = near[np.ix_(a, b)] & (y[a] @ x[b].T >= cosine)
            hits = np.flatnonzero(found.any(0))
            blind = ~q.probes(x[b[hits]], radius)[:, _nearest(y[a], q.coarse)].T  # queries x members
            unseen[b[hits]] += ((found[:, hits] & blind) * np.array([r[5] for r in part])[a][:, None]).sum(0)
            for row in np.flatnonzero(found.any(1)):
                hit = b[found[row]]
                merge_labels(label, hit)
                us.append(who[a[row]])
                ats.append(hit[0])
                ns.append(sizes[hit].sum())
        if us:
            far = (label != np.arange(len(names))) | (unseen > 0)
            yield pd.DataFrame({"u": np.concatenate((us, names[far])),
                                "v": np.concatenate((names[label[np.array(ats)]], names[label[far]])),
                                "n": np.concatenate((ns, unseen[far])).astype(np.int64)})


def near_duplicates(vectors: DataFrame, *, cosine: float = 0.98, sample: int = 20_000, sample_floats: int = 4_000_000,
                    per_list: int = 800, max_lists: int = 1024, spread: float | None = SPREAD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, from (vec_id, embedding, label).

    Vectors link when their labels and lengths are equal and their cosine is at
    least ``cosine``.  Null, zero and empty vectors, vectors with null or
    non-finite components, and null labels link with nothing.  Equal vectors of a label are
    one class, searched once; every copy counts as a link.  Repeated rows are
    copies too, a null vec_id names a component only where there is no other.
    Each vector length has a quantiser, fitted on its share of ``sample`` classes
    (least hashes first, as many as hold ``sample_floats`` numbers; one class of a length that has none there), with one
    list for ``per_list`` classes, ``max_lists`` at most; every class is
    indexed, and lists of any size are searched in bounded blocks.  ``spread``
    is explained above; at its default the recall is measured in the tests.
    """
    spark = vectors.sparkSession
    e = F.col("embedding")
    fine = (F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
            & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(e, lambda x: x != 0))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"),
                          e.cast("array<double>").alias("embedding")).withColumn("fine", F.coalesce(fine, F.lit(False)))
    node = F.xxhash64("label", "embedding")
    rows = rows.withColumn("node", F.when(F.col("fine"), node))
    classes = materialize(rows.where("fine").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
        F.count("*").alias("size"), F.min("vec_id").alias("vec_id")), "pq_classes")

    lengths = {r.dims: r.n for r in classes.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n")).collect()}
    picked: dict[int, list] = {}
    longest = max(lengths, default=1)
    for r in classes.orderBy("node").limit(max(1, min(sample, sample_floats // longest))).select("embedding").collect():
        picked.setdefault(len(r.embedding), []).append(r.embedding)
    if len(picked) < len(lengths):
        rare = classes.where(~F.size("embedding").isin(*picked)).groupBy(F.size("embedding").alias("dims"))
        picked |= {r.dims: [r.embedding] for r in rare.agg(F.min_by("embedding", "node").alias("embedding")).collect()}
    links = None
    if sum(lengths.values()) > 1:
        index, start = {}, 0
        for dims in sorted(picked):
            q = Quantiser.fit(_unit(picked[dims]), int(np.clip(lengths[dims] // per_list, 8, max_lists)), spread=spread)
            index[dims] = start, q
            start += len(q.coarse)
        held = spark.sparkContext.broadcast(index)
        radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        dealt = materialize(classes.select("label", "node", "size", "embedding").mapInPandas(
            lambda it: _deal(it, held.value, radius),
            "label string, node bigint, size bigint, embedding array<double>, list int, probe boolean, "
            "codes binary, missed double"), "pq_dealt")
        fill = dealt.groupBy("label", "list").agg(
            F.ceil(F.sum((~F.col("probe")).cast("int")) / BLOCK_MEMBERS).cast("int").alias("mbs"),
            F.ceil(F.sum(F.col("probe").cast("int")) / BLOCK_QUERIES).cast("int").alias("qbs"))
        own = F.hash("node")
        blocked = (dealt.join(fill.where("mbs > 0"), ["label", "list"])
                   .withColumn("other", F.explode(F.sequence(F.lit(1), F.when(F.col("probe"), F.col("mbs")).otherwise(F.col("qbs"))))))
        blocked = blocked.select(
            "label", "list",
            F.when(F.col("probe"), F.col("other") - 1).otherwise(F.pmod(own, F.col("mbs"))).alias("mb"),
            F.when(F.col("probe"), F.pmod(own, F.col("qbs"))).otherwise(F.col("other") - 1).alias("qb"),
            "node", "size", "embedding", "codes", "probe", "missed")
        key = ["label", "list", "mb", "qb"]
        links = materialize(blocked.repartition(*key).sortWithinPartitions(*key).mapInPandas(
            lambda it: _search(it, held.value, cosine), "u bigint, v bigint, n bigint"), "pq_links")
    if links is None:
        links = spark.createDataFrame([], "u bigint, v bigint, n bigint")
    parts = connected_components(links.select("u", "v"), "pq_link")
    counted = links.groupBy(F.col("u").alias("_u")).agg(F.sum("n").alias("n"))
    named = (classes.select("node", "size", "vec_id").join(parts.withColumnRenamed("node", "_p"), F.col("node") == F.col("_p"), "left")
             .join(counted, F.col("node") == F.col("_u"), "left")
             .select("node", "vec_id", F.coalesce("component", "node").alias("component"),
                     (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_class = materialize(named.select(F.col("node").alias("_n"), "component", "n_links").join(least, "component"), "pq_named")
    out = rows.select("vec_id", "node").join(of_class, F.col("node") == F.col("_n"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.cast("bigint").alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
