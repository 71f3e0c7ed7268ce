r"""Secret scans with corpus-wide ownership frequency; DataFrame functions only.

Every text is scanned for base spans (assignments, access keys, long hex) and
for opaque tokens.  The values found, as hashes, are counted over the corpus:
in how many repositories (documents) and for how many owners (sources) each
occurs.  A value that many owners hold is a copied example; one that stays with
few owners and looks random is live-looking, and an opaque token of that kind
becomes a span of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import materialize

# The base patterns.  Spans of the bounded forms below are the
# runs of at least that length: a run is taken whole or not at all.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Long runs of token characters; ``looks_random`` decides which of them count.
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "opaque"]
_KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]


def _matches(pattern: str, least_value: int = 0) -> Column:
    """array<struct<start, end, value>>: leftmost non-overlapping matches in ``text``, in code points.

    The pieces between matches and the matches themselves alternate, so running
    lengths give the places.  With ``least_value`` the value is group 1, and
    matches whose value is shorter are dropped (after they were matched).
    """
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if least_value else whole
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(whole))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("s")), lambda a, m: F.struct(
        (a["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("at"),
        F.concat(a["s"], F.array(F.struct((a["at"] + F.length(m["gap"])).alias("start"),
                                          (a["at"] + F.length(m["gap"]) + F.length(m["whole"])).alias("end"),
                                          m["value"].alias("value")))).alias("s")), lambda a: a["s"])
    return F.filter(found, lambda m: F.length(m["value"]) >= least_value) if least_value else found


def looks_random(value: Column) -> Column:
    """A digit, a letter and at least 10 different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 10))


def _ranked(matches: Column, rank: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                   m["end"].alias("end"), m["value"].alias("value")))


def _count(spans: str, test) -> Column:
    return F.size(F.filter(spans, test)).cast("bigint")


def _of_rank(spans: str, rank: int) -> Column:
    return _count(spans, lambda m: m["rank"] == rank)


def _listed(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(kinds, m["rank"]), m["start"], m["end"])), ",")


def scan(docs: DataFrame, *, owner: str = "source") -> DataFrame:
    """(row, doc_id, owner, found) per document; found: array<struct<start, rank, end, value>>.

    The patterns only run where cheap tests allow a match: a key word for
    assignments, ``AKIA`` for access keys.
    """
    low = F.lower("text")
    has_key = F.lit(False)
    for k in _KEYWORDS:
        has_key = has_key | low.contains(k)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = {
        0: F.when(has_key, _matches(ASSIGN, 6)).otherwise(none),
        1: F.when(F.col("text").contains("AKIA"), _matches(ACCESS)).otherwise(none),
        2: F.when(F.col("text").rlike(HEX), _matches(HEX)).otherwise(none),
        3: F.when(F.col("text").rlike(OPAQUE), F.filter(_matches(OPAQUE), lambda m: looks_random(m["value"]))).otherwise(none),
    }
    ranked = [_ranked(c, r) for r, c in found.items()]
    texts = docs.select("doc_id", F.col(owner).cast("string").alias("owner"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner",
                        F.array_sort(F.concat(*ranked)).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """(h1, h2, n_repos, n_owners) per value hash, from (h1, h2, doc_id, owner) rows.

    Distinct repositories are folded per owner first, so that a value holding a
    third of all rows is partial sums before it meets in one task.  A null
    owner counts as one owner; a null doc_id as one repository per owner.
    """
    repos = found.groupBy("h1", "h2", "owner", "doc_id").agg(F.count("*").alias("n"))
    owners = repos.groupBy("h1", "h2", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("h1", "h2").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def secrets(docs: DataFrame, *, owner: str = "source", example_owners: int = 3, example_repos: int = 25) -> DataFrame:
    """One row per document: counts and spans of what was found, and how its values are owned.

    doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples.
    Spans read ``kind:start:end`` (code points, end exclusive) by start, then
    kind (assign, access, hex, opaque).  All base spans are listed; an opaque
    token is added when it looks random, is not within a base span, and is no
    example.  An example is a value that ``example_owners`` owners hold, or
    ``example_repos`` repositories, of one owner or more.  ``n_live`` counts the
    values of the document (base and added) that look random and are no
    examples, ``n_examples`` those that are.  Null texts are
    empty, repeated rows keep their rows, and a null owner is one owner.
    """
    found = materialize(scan(docs, owner=owner), "secret_scan")
    each = found.where(F.size("found") > 0).select("row", "doc_id", "owner", F.explode("found").alias("m")).select(
        "row", "doc_id", "owner", "m", F.xxhash64("m.value").alias("h1"), F.hash(F.lit(5), "m.value").alias("h2"))
    freq = ownership(each.select("h1", "h2", "doc_id", "owner"))
    judged = each.select("row", "m", "h1", "h2").join(freq, ["h1", "h2"]).select(
        "row", F.struct("m.start", "m.rank", "m.end",
                        ((F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)).alias("few"), looks_random(F.col("m.value")).alias("random")).alias("m"))
    gathered = judged.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list("m")).alias("ms"))
    base = F.filter("ms", lambda m: m["rank"] < 3)
    added = F.filter("ms", lambda m: (m["rank"] == 3) & m["few"] & ~F.exists(
        "base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    spans = gathered.select("_row", "ms", base.alias("base")).select("_row", "base", added.alias("added")).select(
        "_row", "base", F.array_sort(F.concat("base", "added")).alias("all"))
    spans = spans.select("_row", *[_of_rank("base", r).alias(f"n_{KINDS[r]}") for r in range(3)],
                         _listed("base").alias("base"), _listed("all").alias("spans"),
                         _count("all", lambda m: m["few"] & m["random"]).alias("n_live"),
                         _count("all", lambda m: ~m["few"]).alias("n_examples"))
    out = found.select("row", "doc_id").join(spans, F.col("row") == F.col("_row"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select("doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"),
                      F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_examples"))
