"""Exact Jaccard self-join on word shingles with count-vector R-trees.

1. Profile: every text becomes the set of its shingle hashes; equal sets form
   one class, named by a fingerprint of the set.  A fixed-size table of shingle
   frequencies is summed over all texts.
2. Blocks: linked sets share a shingle among the rarest ``n - ceil(0.75 n) + 1``
   of each (prefix principle, rarest first by the table).  Texts are dealt by
   these shingles; the classes of a run of equal shingles form a unit.
3. Candidates: an R-tree over the group counts of each unit's sets finds the
   pairs whose overlap bound allows a link.  The components of these pairs are
   the clusters within which all links lie.
4. Verification: each cluster, cut into pairs of bounded blocks when large, is
   joined on the full sets, again behind an R-tree.  Only spanning edges leave
   a task, never pairs.
5. Components of the verified edges give every document its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import (SpanHasher, connected_components, materialize, merge_labels, mix64, numbered_columns, runs_of,
                                  shingle_hashes)
from framewise.llm.count_rtree import candidate_lists, groups_for, point

#: Cells of the shingle frequency table: 4 MB of counters whatever the corpus.
CELLS = 1 << 20
_CHUNK = 1 << 14
#: Bits of the filter over the hashes of texts in clusters: 1 MB.
BITMAP = 1 << 23
#: Members and shingles of one block of a large cluster.
BLOCK_SETS, BLOCK_SHINGLES = 2000, 1_000_000
#: Classes of one unit; longer runs become pairs of pieces.
RUN_SETS = 2000


def _words(text: str | None) -> list[bytes]:
    """ASCII-lowered words between ASCII white space."""
    return text.encode().lower().split() if text else []


def _shingle_set(hasher: SpanHasher, text: str | None, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(hasher, _words(text), k))


_NAME = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _fingerprint(s: np.ndarray) -> int:
    """64-bit name of a set; does not depend on order."""
    if not len(s):
        return 0
    parts = np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s + np.uint64(0x51ED27))), len(s)], np.uint64)
    return int(np.bitwise_xor.reduce(mix64(parts * _NAME)).astype(np.int64))


_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.int32}


def _pack(p: np.ndarray) -> bytes:
    """A point as bytes: as few a coordinate as its largest count needs."""
    return p.astype(_WIDTHS[1 if p.max() < 1 << 8 else 2 if p.max() < 1 << 16 else 4]).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, _WIDTHS[len(raw) // groups_for(n)]).astype(np.int32)


def _cell(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(44)).astype(np.int64)


def _profile(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """A row per text (the count vector once per class and task), then the task's frequency table in chunks."""
    hasher, load, seen = SpanHasher(), np.zeros(CELLS, np.int32), set()
    for pdf in batches:
        vs, ns, points = [], [], []
        for text in pdf["text"]:
            s = _shingle_set(hasher, text, k)
            v = _fingerprint(s)
            packed = None
            if v not in seen:
                seen.add(v)
                np.add.at(load, _cell(s), 1)
                packed = _pack(point(s))
            vs.append(v)
            ns.append(len(s))
            points.append(packed)
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "t": pdf["t"].astype("Int64"), "v": vs, "n": ns,
                            "counts": points, "chunk": -1, "load": None})
    for c in range(0, CELLS, _CHUNK):
        part = load[c:c + _CHUNK]
        if part.any():
            yield pd.DataFrame({"doc_id": pd.array([None], "Int64"), "t": pd.array([None], "Int64"), "v": [0],
                                "n": [0], "counts": [None], "chunk": [c // _CHUNK], "load": [part.tobytes()]})


def _sum_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for c, raw in zip(pdf["chunk"], pdf["load"]):
            part = np.frombuffer(raw, np.int32)
            total[c] = np.minimum(total.get(c, 0) + part.astype(np.int64), 2**31 - 1)
    yield pd.DataFrame({"chunk": list(total), "load": [x.astype(np.int32).tobytes() for x in total.values()]})


def _prefixes(batches: Iterator[pd.DataFrame], k: int, num: int, den: int, load: np.ndarray) -> Iterator[pd.DataFrame]:
    """(key, v): the rarest shingles of each distinct set of the task."""
    hasher, seen = SpanHasher(), set()
    for pdf in batches:
        keys, names = [], []
        for text in pdf["text"]:
            s = _shingle_set(hasher, text, k)
            n, v = len(s), _fingerprint(s)
            if n and v not in seen:
                seen.add(v)
                first = n - (-(-num * n // den)) + 1
                weight = load[_cell(s)]
                if first < n:
                    cut = np.partition(weight, first - 1)[first - 1]
                    rare, ties = s[weight < cut], s[weight == cut]  # s is sorted: ties by hash
                    s = np.concatenate((rare, ties[: first - len(rare)]))
                keys.append(s.view(np.int64))
                names.append(np.full(len(s), v, np.int64))
        if keys:
            yield pd.DataFrame({"k": np.concatenate(keys), "v": np.concatenate(names)})


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(cut, vs): the classes of each run of equal ``k``; rows come sorted by (k, v).

    ``cut`` is 0, or for runs beyond ``RUN_SETS`` the length of the first of
    two pieces whose cross pairs the unit stands for.  A unit already given by
    this task is not repeated while it is remembered.
    """
    seen: set[bytes] = set()
    cuts: list[int] = []
    units: list[np.ndarray] = []

    def add(cut: int, vs: np.ndarray) -> None:
        mark = vs.tobytes() + bytes(cut > 0)
        if mark not in seen:
            seen.add(mark)
            cuts.append(cut)
            units.append(vs)

    def run(vs: np.ndarray) -> None:
        if len(vs) <= RUN_SETS:
            if len(vs) > 1:
                add(0, vs)
            return
        pieces = [vs[i:i + RUN_SETS] for i in range(0, len(vs), RUN_SETS)]
        for i, left in enumerate(pieces):
            add(0, left)
            for right in pieces[i + 1:]:
                add(len(left), np.concatenate((left, right)))

    open_k, open_vs = None, []  # the run that may go on in the next batch
    for pdf in batches:
        k, v = pdf["k"].to_numpy(), pdf["v"].to_numpy()
        if not len(k):
            continue
        new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        ends = np.append(new[1:], len(k))
        for a, b in zip(new[(ends - new > 1) | (new == 0) | (ends == len(k))].tolist(),
                        ends[(ends - new > 1) | (new == 0) | (ends == len(k))].tolist()):
            if k[a] != open_k:
                if open_vs:
                    run(np.unique(np.concatenate(open_vs)))
                open_k, open_vs = k[a], []
            open_vs.append(v[a:b])
        if units:
            yield pd.DataFrame({"cut": cuts, "vs": units})
            cuts, units = [], []
            if len(seen) > 300_000:
                seen.clear()
    if open_vs:
        run(np.unique(np.concatenate(open_vs)))
    if units:
        yield pd.DataFrame({"cut": cuts, "vs": units})


def _candidate_edges(batches: Iterator[pd.DataFrame], num: int, den: int) -> Iterator[pd.DataFrame]:
    """Spanning edges (u, v) of the pairs of each unit that its R-tree cannot rule out."""
    for pdf in batches:
        us, vs = [], []
        for cut, points in zip(pdf["cut"], pdf["points"]):
            points = sorted({p["v"]: p for p in points}.values(), key=lambda p: p["pos"])
            names = np.array([p["v"] for p in points])
            sizes = np.array([p["n"] for p in points])
            side = np.array([p["pos"] >= cut > 0 for p in points])
            label = np.arange(len(names))
            for i, near in candidate_lists([_unpack(p["counts"], p["n"]) for p in points], sizes, num, den):
                if merge_labels(label, np.append(near[side[near] != side[i]] if cut else near, i)):
                    break
            far = names[label] != names
            us.append(names[label][far])
            vs.append(names[far])
        if us:
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)})


def link_sets(sets: list[np.ndarray], side: list[int] | None, num: int, den: int) -> list[int]:
    """Least linked index per set: the spanning structure of all links among ``sets``.

    With ``side``, only pairs of different sides are compared.  Candidates come
    from an R-tree over group counts; a pair already connected is not compared.
    """
    m, label = len(sets), np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    side = np.zeros(m, int) if side is None else np.array(side)
    cross = bool(side.any())
    index = None  # inverted index of the block, shingle -> members, for sets with many candidates
    for i, near in candidate_lists([point(s) for s in sets], sizes, num, den):
        near = near[(label[near] != label[i]) & ((side[near] != side[i]) if cross else True)]
        if len(near) > 8:
            if index is None:
                flat = np.concatenate(sets)
                order = np.argsort(flat, kind="stable")
                index = flat[order], np.repeat(np.arange(m), sizes)[order]
            lo = np.searchsorted(index[0], sets[i], "left")
            spans = np.searchsorted(index[0], sets[i], "right") - lo
            at = np.repeat(lo - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            shared = np.bincount(index[1][at], minlength=m)[near]
        else:
            shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in near], int)
        linked = near[den * shared >= num * (sizes[i] + sizes[near] - shared)]
        if len(linked) and merge_labels(label, np.append(linked, i)):
            break
    return label.tolist()


def _verify(batches: Iterator[pd.DataFrame], k: int, num: int, den: int) -> Iterator[pd.DataFrame]:
    """Spanning edges of the links of each block pair."""
    hasher, us, vs = SpanHasher(), [], []
    for (_, i, j), rows in runs_of(batches, ["cluster", "bi", "bj"]):
        texts = {r[3]: (r[4], r[5]) for r in rows}  # one text per class
        names = sorted(texts)
        sets = [_shingle_set(hasher, texts[v][1], k) for v in names]
        side = None if i == j else [int(texts[v][0] == j) for v in names]
        for v, root in zip(names, link_sets(sets, side, num, den)):
            if names[root] != v:
                us.append(names[root])
                vs.append(v)
        if len(us) > 10_000:
            yield pd.DataFrame({"u": us, "v": vs})
            us, vs = [], []
    yield pd.DataFrame({"u": us, "v": vs}, dtype="int64")


def _bitmap(hashes: DataFrame):
    """A test of columns of hashes against ``hashes`` (``h``), true for all of them and few others; None if there are none."""
    word, bit = F.pmod("h", F.lit(BITMAP)), F.expr("shiftleft(1L, int(pmod(h, 64)))")
    bits = np.zeros(BITMAP // 64, np.int64)
    rows = hashes.groupBy(F.shiftright(word, 6).alias("w")).agg(F.bit_or(bit).alias("b")).collect()
    if not rows:
        return None
    for r in rows:
        bits[r.w] = r.b
    held = hashes.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def maybe(column: pd.Series) -> pd.Series:
        h = column.to_numpy(np.int64)
        return pd.Series((held.value[(h % BITMAP) >> 6] >> (h % 64)) & 1 == 1)

    return maybe


def _classes(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, t, v, n) per document, and (v, component, doc_id, t) per class of equal sets.

    ``t`` is the hash of the text, ``v`` names the class; a class has its least
    doc_id (null only if it has no other) and the least ``t`` of that id.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("t"))
    profile = materialize(docs.mapInPandas(
        lambda it: _profile(it, k), "doc_id bigint, t bigint, v bigint, n bigint, counts binary, chunk int, load binary"),
        "jaccard_profile")
    texts = profile.where("chunk = -1").select("doc_id", "t", "v", "n")

    parts = (profile.where("chunk >= 0").select("chunk", "load").repartition(16, "chunk")
             .mapInPandas(_sum_chunks, "chunk int, load binary").collect())
    load = np.zeros(CELLS, np.int32)  # CELLS counters, whatever the corpus
    for r in parts:
        load[r.chunk * _CHUNK:(r.chunk + 1) * _CHUNK] = np.frombuffer(r.load, np.int32)
    held = docs.sparkSession.sparkContext.broadcast(load)

    runs = (docs.select("text").mapInPandas(lambda it: _prefixes(it, k, num, den, held.value), "k bigint, v bigint")
            .repartition("k").sortWithinPartitions("k", "v"))
    points = (profile.where("counts IS NOT NULL AND n > 0").groupBy(F.col("v").alias("_v"))
              .agg(F.max("n").alias("n"), F.max("counts").alias("counts")))
    units = runs.mapInPandas(_units, "cut int, vs array<bigint>").distinct()
    placed = (units.select(F.xxhash64("vs", "cut").alias("unit"), "cut", F.posexplode("vs").alias("pos", "v"))
              .join(points, F.col("v") == F.col("_v")))
    treed = placed.groupBy("unit", "cut").agg(F.collect_list(F.struct("pos", "v", "n", "counts")).alias("points"))
    near = materialize(treed.select("cut", "points").mapInPandas(
        lambda it: _candidate_edges(it, num, den), "u bigint, v bigint").distinct(), "jaccard_near")
    clusters = connected_components(near, "jaccard_cluster")

    # One text per class in a cluster; texts come back by (doc_id, text hash).
    classes = (texts.where("n > 0").groupBy("v").agg(F.min("doc_id").alias("doc_id"),
               F.min_by("t", F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "t")).alias("t"), F.max("n").alias("n")))
    members = materialize(classes.join(clusters, classes.v == clusters.node).select(
        F.col("component").alias("cluster"), "v", "n", F.col("doc_id").alias("d"), F.col("t").alias("h")),
        "jaccard_members")
    # Only texts that may be members are shuffled: a fixed-size bitmap of text hashes sorts out most others.
    # Rows that repeat an id and a text are folded before that, however many they are.
    repeats = texts.groupBy("doc_id", "t").agg(F.count("*").alias("n")).where("n > 1")
    repeats = repeats.join(members, F.col("d").eqNullSafe(repeats["doc_id"]) & (F.col("h") == repeats["t"]), "left_semi").select(F.col("t").alias("h"))
    some_member, some_repeat = _bitmap(members), _bitmap(repeats)
    wanted = docs.where("text IS NOT NULL").where(F.lit(False) if some_member is None else some_member("t"))
    if some_repeat is not None:
        folded = wanted.where(some_repeat("t")).groupBy("doc_id", "t").agg(F.first("text").alias("text"))
        wanted = wanted.where(~some_repeat("t")).unionByName(folded)
    sizes = members.groupBy("cluster").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own, other = F.pmod(F.col("v"), F.col("nb")).cast("int"), F.col("other")
    dealt = (members.join(sizes.select(F.col("cluster").alias("c"), blocks.alias("nb")), F.col("cluster") == F.col("c"))
             .join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("t")))
             .select("cluster", "v", own.alias("own"), "text",
                     F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
             .select("cluster", F.least("own", other).alias("bi"), F.greatest("own", other).alias("bj"), "v", "own", "text"))
    links = (dealt.repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj")
             .mapInPandas(lambda it: _verify(it, k, num, den), "u bigint, v bigint").distinct())
    linked = connected_components(links, "jaccard_link")

    named = classes.join(linked, classes.v == linked.node, "left").select(
        "v", F.coalesce("component", "v").alias("component"), "doc_id", "t")
    return texts, named


def components(docs: DataFrame, *, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links).

    Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of
    distinct ``k``-word shingles (fewer words: one shingle; none: empty set,
    linked with nothing).  Repeated rows keep their rows; a null doc_id counts
    in the links but is never a component's name unless there is no other.
    """
    texts, named = _classes(docs, k, num, den)
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = materialize(named.select(F.col("v").alias("_v"), "component").join(least, "component"), "jaccard_classes")
    return texts.join(of_class, (texts.v == F.col("_v")) & (texts.n > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, *, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id, then the least text hash.

    Documents without shingles all stay.  Of rows repeating the kept id and
    text one stays; a row of null id stays only where its component has no id.
    """
    texts, named = _classes(docs, k, num, den)
    first = named.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("m")).select(
        F.col("m.doc_id").alias("_d"), F.col("m.t").alias("_h"))
    # Copies are counted over hashes, so that only texts that are repeated go through an aggregate.
    kept = materialize(texts.where("n > 0").groupBy("doc_id", "t").agg(F.count("*").alias("_copies"))
                       .join(first, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_h")))
                       .select("_d", "_h", "_copies"), "jaccard_kept")
    full, names = numbered_columns(docs)  # no name of theirs clashes with the ones here
    key, text = names["doc_id"], names["text"]
    blank = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named_rows = full.where(~blank).withColumn("own", F.xxhash64(text))

    def rows_of(some: DataFrame, how: str) -> DataFrame:
        return named_rows.join(some, F.col(key).cast("bigint").eqNullSafe(F.col("_d")) & (F.col("own") == F.col("_h")), how)

    single = rows_of(kept.where("_copies = 1"), "left_semi").select(*names.values())
    folded = (rows_of(kept.where("_copies > 1"), "inner").groupBy("_d", "_h")
              .agg(F.first(F.struct(*names.values())).alias("row")).select("row.*"))
    return full.where(blank).unionByName(single).unionByName(folded).toDF(*docs.columns)
