"""Cross-site boilerplate lines by HyperLogLog spread; DataFrame functions only.

1. A count per line hash (one hash aggregate over longs) keeps the lines that
   at least two sites hold at all; the others cannot be boilerplate.
2. For those, one HyperLogLog sketch of the sites per (line, salt) is built
   map-side, then sketches are merged per line by aggregation.
3. Lines whose estimate is clearly at or above ``min_sites`` are boilerplate;
   the near-threshold ones get an exact distinct count.
4. Documents lose these lines, except in the document of least id that holds
   the line: each passage survives there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import materialize, numbered_columns

#: Relative half-width of the band around the threshold that is counted
#: exactly: over five standard errors of a sketch with 2**12 registers (1.6 %).
BAND = 0.1


def _lines(docs: DataFrame, site: str, min_words: int, min_wide: int) -> DataFrame:
    """(doc key, position, line hashes, site) of the lines long enough to judge."""
    line = F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    words = F.size(F.split(line, r"[\x20\x09-\x0D]+"))
    return (docs.select("doc_id", F.xxhash64("text").alias("t"), F.col(site).cast("string").alias("site"),
                        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
            .select("doc_id", "t", "pos", "site", line.alias("line"))
            .where((words >= min_words) | (F.octet_length("line") - F.length("line") >= min_wide))
            .select("doc_id", "t", "pos", "site", F.xxhash64("line").alias("h1"), F.hash(F.lit(7), "line").alias("h2")))


def boilerplate_lines(lines: DataFrame, *, min_sites: int = 5, lg_k: int = 12) -> DataFrame:
    """(h1, h2, n_sites, owner): hashes of the ``lines`` on at least ``min_sites`` sites.

    ``n_sites`` is the estimate, or the exact count near the threshold;
    ``owner`` is the least doc_id holding the line.  Null sites are no site.
    """
    key = ["h1", "h2"]
    spread = lines.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("owner"),
        F.min(F.xxhash64("site")).alias("lo"), F.max(F.xxhash64("site")).alias("hi"))
    wide = materialize(spread.where((F.col("n") >= min_sites) & (F.col("lo") != F.col("hi")))
                       .select(*key, "owner"), "line_wide")
    held = lines.where("site is not null").join(wide, key)
    salt = F.pmod(F.hash("doc_id"), F.lit(16))
    part = held.groupBy(*key, "owner", salt.alias("salt")).agg(F.hll_sketch_agg("site", lg_k).alias("s"))
    est = materialize(part.groupBy(*key, "owner").agg(
        F.hll_sketch_estimate(F.hll_union_agg("s")).alias("n_sites")), "line_estimates")
    margin = min_sites * BAND + 1
    sure = est.where(F.col("n_sites") > min_sites + margin)
    near = est.where(F.col("n_sites").between(min_sites - margin, min_sites + margin)).drop("n_sites")
    exact = (lines.where("site is not null").join(near, key).select(*key, "owner", "site").distinct()
             .groupBy(*key, "owner").agg(F.count("*").alias("n_sites")))
    return sure.unionByName(exact.where(F.col("n_sites") >= min_sites))


def _cut(docs: DataFrame, site: str, min_sites: int, min_words: int, min_wide: int, lg_k: int) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with numbered columns, its texts without boilerplate, n_lines and n_removed; and the columns' names."""
    lines = materialize(_lines(docs, site, min_words, min_wide), "line_hashes")  # the texts are split once
    bad = materialize(boilerplate_lines(lines, min_sites=min_sites, lg_k=lg_k), "line_bad")
    # Positions to take out per text: at most one row per document line.
    gone = (lines.join(bad, ["h1", "h2"])
            .where(~F.coalesce(F.col("doc_id") == F.col("owner"), F.lit(False)))
            .groupBy(F.col("doc_id").alias("d"), F.col("t").alias("t"))
            .agg(F.collect_set("pos").alias("gone")))
    whole, names = numbered_columns(docs)
    key, text = names["doc_id"], names["text"]
    whole = whole.select("*", F.xxhash64(text).alias("own"), F.split(text, "\n", -1).alias("split"))
    out = whole.join(gone, F.col(key).eqNullSafe(F.col("d")) & (F.col("own") == F.col("t")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("split") - 1), "gone")
    cleaned: Column = F.when(F.col("gone").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("split", i)), "\n"))
    return out.select(*[cleaned.alias(c) if c == text else F.col(c) for c in names.values()],
                      F.when(F.col(text).isNull(), 0).otherwise(F.coalesce(F.size("split"), F.lit(0))).alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed")), names


def dedup_report(docs: DataFrame, *, site: str = "source", min_sites: int = 5, min_words: int = 5, min_wide: int = 40,
                 lg_k: int = 12) -> DataFrame:
    """One row per document: doc_id, text without boilerplate lines, n_lines, n_removed.

    Lines are split at ``\\n`` and compared without white space at their ends.
    A line is judged if it has ``min_words`` words, or ``min_wide`` bytes more
    than characters (20 characters of a script without spaces); others stay.
    A text that loses all its lines becomes empty; null texts stay null and
    have no lines.  The document of least id that holds a line keeps it (each time it has it);
    rows that repeat an id and a text get the same result; rows
    of null id own nothing and lose every boilerplate line.  Other columns are ignored whatever their names.
    """
    cut, names = _cut(docs.select("doc_id", "text", site), site, min_sites, min_words, min_wide, lg_k)
    return cut.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"),
                      F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"))


def remaining(docs: DataFrame, *, site: str = "source", min_sites: int = 5, min_words: int = 5, min_wide: int = 40,
              lg_k: int = 12) -> DataFrame:
    """The cleaned documents, all other columns as they came, without those that lost every line they had."""
    cut, names = _cut(docs, site, min_sites, min_words, min_wide, lg_k)
    empty = (F.col("n_removed") > 0) & (F.regexp_replace(names["text"], r"[\x20\x09-\x0D]+", "") == "")
    return cut.where(~F.coalesce(empty, F.lit(False))).select(*[F.col(c).alias(n) for n, c in names.items()])
