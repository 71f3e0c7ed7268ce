"""Benchmark decontamination by multi-pattern search of word windows.

The patterns (all windows of ``window`` consecutive words of the benchmark
items) are grouped by length and searched with Wu-Manber matchers inside the
scan of the documents: no shuffle and no join.  The matchers are broadcast in
blocks of bounded size; a benchmark beyond one block takes one narrow pass per
block, each adding its hits to those of the passes before.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import fresh_name, materialize
from framewise.llm.wu_manber import WuManber

#: Bytes that are not part of a word become spaces; letters are lower case by then.
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

_HITS = "struct<n_words:bigint, spans:array<bigint>, items:array<string>>"


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lowered runs of digits, letters and non-ASCII characters, as UTF-8."""
    return text.encode().lower().translate(_TABLE).split() if text else []


def matchers(items, window: int) -> list[WuManber]:
    """One matcher per window length from (item id, text) pairs; ids are kept as text."""
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        words = words_of(text)
        if words:
            m = min(window, len(words))
            for i in range(len(words) - m + 1):
                owners = by_length.setdefault(m, {}).setdefault(tuple(words[i:i + m]), set())
                if item is not None:
                    owners.add(str(item))
    return [WuManber(p) for _, p in sorted(by_length.items())]


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    """Flat [start, end, start, end, ...] of the union of half-open spans."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def search(text: str | None, found: list[WuManber], spans=(), items=()) -> tuple[int, list[int], list[str]]:
    """Words of ``text``, merged hit spans (word positions) and items, with those already known."""
    words = words_of(text)
    hit = list(zip(spans[::2], spans[1::2]))
    owners = set(items)
    for m in found:
        for start, own in m.occurrences(words):
            hit.append((start, start + m.length))
            owners |= own
    return len(words), _merge(hit), sorted(owners)


def find_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", window: int = 10,
              block_chars: int = 2_000_000, to: str = "_hits") -> DataFrame:
    """``docs`` with the struct column ``to``: n_words, merged hit spans, sorted items hit.

    ``block_chars`` bounds the benchmark text behind one broadcast (a single
    longer item makes a block of its own): its matchers take some 130 times that
    in memory, 260 MB at the default.  The number of blocks follows the
    benchmark's size; a table is written after each but the last, so that no
    two blocks' matchers meet in one task.  Null and empty texts have no words; items of null or
    wordless text have no windows; windows of items with a null id hit but
    name no item; repeated items count once.  A column named ``to`` is replaced.
    """
    spark = docs.sparkSession
    bench = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    empty = F.struct(F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("spans"),
                     F.array().cast("array<string>").alias("items"))
    out = docs.withColumn(to, empty)
    for b in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        held = spark.sparkContext.broadcast(matchers(part.toLocalIterator(), window))

        @F.pandas_udf(_HITS)
        def look(texts: pd.Series, known: pd.DataFrame) -> pd.DataFrame:
            found = held.value
            rows = [search(t, found, s, i) for t, s, i in zip(texts, known["spans"], known["items"])]
            return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

        out = out.withColumn(to, look.asNondeterministic()(F.col(text), F.col(to)))
        if b < blocks - 1:
            out = materialize(out, "benchmark_hits")
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Repeated rows and null ids keep their rows.
    """
    hits = find_hits(docs.select("doc_id", "text"), benchmark, **kw)
    items, spans = F.col("_hits.items"), F.col("_hits.spans")
    n_hit = F.aggregate(spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("s")),
                        lambda a, p: F.when(a["s"] < 0, F.struct(a["n"].alias("n"), p.alias("s")))
                        .otherwise(F.struct((a["n"] + p - a["s"]).alias("n"), F.lit(-1).cast("bigint").alias("s"))),
                        lambda a: a["n"])
    return hits.select("doc_id", F.col("_hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
                       F.size(items).cast("bigint").alias("n_items"),
                       F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                       (F.size(spans) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, all columns as they came."""
    to = fresh_name(docs, "_hits")
    hits = find_hits(docs, benchmark, to=to, **kw)
    return hits.where(F.size(F.col(to)["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
