r"""Chat formatting into budgeted, turn-aligned windows; DataFrame functions only.

Prefix sums of the turns' token costs choose the windows: a window owns the
turns whose start falls into its step of the sum.  It opens with the
conversation's system turn and with a limited history, the last turns of the
window before; these repeated turns carry no loss, so each assistant turn is a
target exactly once.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn.  Control strings inside
roles and texts (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a
backslash after their first character; one that already has backslashes there
gets one more, so taking one away restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewise.llm.common import materialize

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|)"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|\|)"
#: Token cost of the marks around a turn; also keeps every cost positive.
TURN_COST = 3
#: Turns per partial sum: bounds what one conversation sorts in one task.
CHUNK = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def token_cost(text: Column) -> Column:
    """A token for every four bytes of UTF-8, in any script, plus the marks."""
    return F.ceil(F.octet_length(text) / 4) + F.lit(TURN_COST)


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """``turns`` with ``first`` (its first turn?) and ``start``: tokens of the conversation before it.

    Two levels: sums per chunk of consecutive turn numbers, a running sum over
    the chunks, and a running sum inside each chunk, so that no task sorts a
    whole long conversation.
    """
    chunk = F.floor(F.col("turn") / CHUNK)
    turns = turns.withColumn("chunk", F.coalesce(chunk, F.lit(-(1 << 62))))
    sums = turns.groupBy("conv_id", "chunk").agg(F.sum("cost").alias("total"))
    before = W.partitionBy("conv_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"),
                       F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    return (turns.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
            .withColumn("start", F.col("base") + F.coalesce(F.sum("cost").over(inside), F.lit(0)))
            .drop("c", "k", "base", "chunk"))


def windows(conversations: DataFrame, *, budget: int = 1024, history: int = 128) -> DataFrame:
    """One row per window: conv_id, start, n_repeated, n_turns, formatted, loss_spans, n_tokens, over_budget.

    ``conversations``: conv_id, turn, role, text; other columns are ignored.
    Rows are ordered by turn, ties by role and text; repeated rows are turns of
    their own.  Null roles and texts count as empty, null turns come first,
    null conv_ids form one conversation.  ``start`` is the window's place in
    the prefix sums, ``n_turns`` counts its turns with the first ``n_repeated``
    ones (system turn and history).  ``loss_spans`` are half-open code point
    spans of ``formatted``: the assistant texts owned by the window.  A window
    keeps to ``budget`` tokens unless the system turn or a single turn is
    larger than half of what history leaves; such a turn stays whole in a
    window of its own, and ``over_budget`` says so.  An empty table gives none.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    cost = token_cost(F.col("text"))
    placed = materialize(_prefix_sums(turns.withColumn("cost", cost.cast("bigint"))), "chat_turns")

    system = placed.where("start = 0 AND role = 'system'").select(
        F.col("conv_id").alias("sc"), F.col("role").alias("s_role"), F.col("text").alias("s_text"),
        F.col("cost").alias("s_cost"))
    # The step: a window's turns start within it, and none but an over-long turn is larger than it.
    sized = placed.join(system.select("sc", "s_cost"), F.col("conv_id").eqNullSafe(F.col("sc")), "left").drop("sc")
    step = F.greatest(F.lit(TURN_COST + 1), F.floor((budget - history - F.coalesce("s_cost", F.lit(0))) / 2))
    sized = sized.withColumn("step", step).withColumn("long", (F.col("cost") > F.col("step")).cast("int"))
    own = W.partitionBy("conv_id", F.floor(F.col("start") / F.col("step")), "long")
    sized = (sized.withColumn("window", F.min("start").over(own))
             .withColumn("after", F.max(F.col("start") + F.col("cost")).over(own)).drop("step", "long"))

    piece = F.struct("start", F.lit(False).alias("repeated"), "role", "text", "cost")
    owned = sized.select("conv_id", "window", piece.alias("piece"))
    again = F.struct("start", F.lit(True).alias("repeated"), "role", "text", "cost")
    # History: the end of a window, repeated in the one that starts there.
    past = sized.where((F.col("after") - F.col("start") <= history) & ~((F.col("start") == 0) & (F.col("role") == "system")))
    past = past.select("conv_id", F.col("after").alias("window"), again.alias("piece"))
    # The system turn, before every window but its own (its start sorts first).
    heads = owned.select("conv_id", "window").where("window > 0").distinct()
    first = heads.join(system, F.col("conv_id").eqNullSafe(F.col("sc"))).select(
        "conv_id", "window", F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(True).alias("repeated"),
                                      F.col("s_role").alias("role"), F.col("s_text").alias("text"),
                                      F.col("s_cost").alias("cost")).alias("piece"))

    gathered = (owned.unionByName(past).unionByName(first).groupBy("conv_id", "window")
                .agg(F.array_sort(F.collect_list("piece")).alias("t"),
                     F.max(~F.col("piece.repeated")).alias("real")).where("real"))
    gathered = gathered.select("conv_id", F.col("window").alias("start"), "t", F.transform("t", lambda p: F.struct(
        F.concat(F.lit("<|turn|>"), escape(p["role"]), F.lit("<|text|>")).alias("head"),
        escape(p["text"]).alias("body"), ((p["role"] == "assistant") & ~p["repeated"]).alias("target"))).alias("f"))
    # Spans of the targets: running lengths over the window's turns.
    spans = F.aggregate("f", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("s")),
                        lambda a, p: F.struct(
        (a["at"] + F.length(p["head"]) + F.length(p["body"]) + len("<|end|>")).alias("at"),
        F.when(p["target"], F.concat(a["s"], F.array(F.struct(
            (a["at"] + F.length(p["head"])).alias("start"),
            (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"))))).otherwise(a["s"]).alias("s")),
        lambda a: a["s"])
    tokens = F.aggregate("t", F.lit(0).cast("bigint"), lambda a, p: a + p["cost"])
    return gathered.select(
        "conv_id", "start", F.size(F.filter("t", lambda p: p["repeated"])).alias("n_repeated"),
        F.size("t").alias("n_turns"),
        F.array_join(F.transform("f", lambda p: F.concat(p["head"], p["body"], F.lit("<|end|>"))), "").alias("formatted"),
        spans.alias("loss_spans"), tokens.alias("n_tokens"), (tokens > budget).alias("over_budget"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from windows alone: the digests of its turns and of its targets.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_windows.  A digest covers a whole conversation, so its text meets in one
    row here; the windows themselves do not need that.
    """
    marked = F.slice(F.split("formatted", r"<\|turn\|>", -1), F.col("n_repeated") + 2, F.col("n_turns"))
    turns = F.array_join(F.transform(marked, lambda t: F.concat(
        unescape(F.substring_index(t, "<|text|>", 1)), F.lit("\n"),
        unescape(F.substring_index(F.substring_index(t, "<|text|>", -1), "<|end|>", 1)), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    parts = formatted.select("conv_id", "start", (F.col("n_turns") - F.col("n_repeated")).alias("n"),
                             turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars"))
    joined = lambda c: F.array_join(F.transform(F.array_sort("parts"), lambda p: p[c]), "")
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"),
        F.collect_list(F.struct("start", "turns", "loss")).alias("parts"))
    whole = whole.select("conv_id", "n_turns", "formatted_chars", "n_windows", joined("turns").alias("turns"),
                         joined("loss").alias("loss"))
    return whole.select(
        "conv_id", F.col("n_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
        F.col("n_windows").cast("bigint").alias("n_windows"))
