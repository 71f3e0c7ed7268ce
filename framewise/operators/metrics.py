"""Global and per-sequence crash metrics, and the anomaly thresholds.

Every metric here is a partial + final hash aggregate: each task folds its
rows into a small buffer before anything is shuffled, so hot keys or one huge
sequence never land whole in one task.  One-row results stay DataFrames; they
are combined with scalar subqueries (``DataFrame.scalar``), not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.schemas import N_FRAMES, SEQUENCE_KEYS, frame_cols


def with_one_row(df: DataFrame, row: DataFrame, name: str = "_row") -> DataFrame:
    """Attach the single row of ``row`` to every row of ``df`` as struct ``name``.

    The row is packed into one struct and referenced once, so Spark runs one
    scalar subquery however many of its fields are used; fields are then read
    as ``F.col(f"{name}.{field}")``.
    """
    packed = row.select(F.struct(*[F.col(c) for c in row.columns]).alias(name)).scalar()
    return df.withColumn(name, packed)


def crash_metrics(frames: DataFrame) -> DataFrame:
    """Total crashes, crash rate (mean flag), total frames, crash percentage."""
    return (frames
            .agg(F.sum("crash_detected").cast("long").alias("total_crashes"),
                 F.avg("crash_detected").alias("crash_rate"),
                 F.count(F.lit(1)).alias("total_frames"))
            .withColumn("crash_percentage", F.col("crash_rate") * 100))


def row_counts(**tables: DataFrame) -> DataFrame:
    """``table, row_count`` for each named table (one aggregate per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sequence_stats(frames: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per-sequence crash count, density and frame count (grouped form)."""
    keys = keys or SEQUENCE_KEYS
    return (frames.groupBy(*keys)
            .agg(F.sum("crash_detected").cast("long").alias("crash_count"),
                 F.avg("crash_detected").alias("crash_density"),
                 F.count(F.lit(1)).alias("total_frames")))


def sequence_stats_from_records(records: DataFrame, n_frames: int = N_FRAMES,
                                id_col: str = "sequence_id", null_flags: str | None = None) -> DataFrame:
    """Same result as ``sequence_stats(to_frame_rows(records))`` without a shuffle.

    Valid when ``id_col`` is unique per record (one record is one sequence):
    the per-sequence sums are then array folds inside one row.  Null flags
    follow the grouped rules: skipped by sum/avg, counted as frames; ``null_flags``
    names a further column with their number.
    """
    from framewise.functions.columns import time_of_day

    cols = frame_cols(n_frames)
    # Flat column arithmetic as SQL text (no array allocation, no lambdas, one
    # JVM call per expression): stays inside whole-stage codegen.
    total = _balanced_sum([f"coalesce(CAST(`{c}` AS BIGINT), 0L)" for c in cols])
    n_valid = _balanced_sum([f"CAST(`{c}` IS NOT NULL AS INT)" for c in cols])
    sums = records.select(
        F.col(id_col).alias("sequence_id"),
        time_of_day("timing").alias("time_of_day"),
        "weather", "egoinvolve",
        F.expr(total).alias("_total"), F.expr(n_valid).alias("_valid"))
    return sums.select(
        "sequence_id", "time_of_day", "weather", "egoinvolve",
        F.expr("CASE WHEN _valid > 0 THEN _total END").alias("crash_count"),
        F.expr("CASE WHEN _valid > 0 THEN CAST(_total AS DOUBLE) / CAST(_valid AS DOUBLE) END")
        .alias("crash_density"),
        F.lit(n_frames).cast("long").alias("total_frames"),
        *([F.expr(f"CAST({n_frames} - _valid AS BIGINT)").alias(null_flags)] if null_flags else []),
    )


def read_counts(sequences: DataFrame, null_flags: str = "null_flags") -> DataFrame:
    """One row: records, frames, null ids, null flags and crashes of a table of one sequence per record."""
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias

    return sequences.agg(F.count(F.lit(1)).alias("records"), total("total_frames")("frames"),
                         F.count_if(F.col("sequence_id").isNull()).alias("null_ids"), total(null_flags)("null_flags"),
                         total("crash_count")("crashes"))


def _balanced_sum(terms: list[str]) -> str:
    """SQL text of a balanced sum (shallow expression tree)."""
    while len(terms) > 1:
        terms = [f"({terms[i]} + {terms[i + 1]})" if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]


def threshold_stats(seq: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of per-sequence crash counts."""
    return seq.agg(F.avg("crash_count").alias("avg_crashes"),
                   F.stddev_samp("crash_count").alias("std_crashes"))


def p90_threshold(seq: DataFrame, q: float = 0.9) -> DataFrame:
    """Exact linear-interpolation percentile of crash counts.

    ``percentile`` keeps a value→count map; crash counts take at most
    n_frames + 1 distinct values, so the buffer is bounded whatever the rows.
    """
    return seq.agg(F.percentile("crash_count", q).alias("percentile_threshold"))


def anomaly_thresholds(seq: DataFrame, q: float = 0.9) -> DataFrame:
    """One row: mean, std, mean+std, p90 and the final threshold (their minimum).

    ``least`` skips nulls, so with one sequence (null std) the percentile
    threshold alone is used.
    """
    return (seq
            .agg(F.avg("crash_count").alias("avg_crashes"),
                 F.stddev_samp("crash_count").alias("std_crashes"),
                 F.percentile("crash_count", q).alias("percentile_threshold"))
            .withColumn("statistical_threshold", F.col("avg_crashes") + F.col("std_crashes"))
            .withColumn("final_threshold",
                        F.least(F.col("statistical_threshold"), F.col("percentile_threshold"))))


def final_threshold(seq: DataFrame, q: float = 0.9) -> DataFrame:
    return anomaly_thresholds(seq, q).select("statistical_threshold", "percentile_threshold",
                                             "final_threshold")


def crash_share(frames: DataFrame) -> DataFrame:
    """Crash frames and their share of all frames (real frame count, not a constant)."""
    return (frames
            .agg(F.count_if(F.col("crash_detected") == 1).alias("total_crashes"),
                 F.count(F.lit(1)).alias("total_frames"))
            .withColumn("crash_share_pct",
                        F.try_divide(F.col("total_crashes"), F.col("total_frames")) * 100))


def rate_by_condition(frames: DataFrame,
                      conditions: tuple[str, ...] = ("time_of_day", "weather", "egoinvolve")) -> DataFrame:
    """Crash rate by each single condition, as GROUPING SETS in one aggregate.

    Output: ``condition`` (column name), ``value`` (its value as text; a real
    null value stays a null group), crash totals, frame count and rate.
    """
    n = len(conditions)
    agg = frames.groupingSets([[c] for c in conditions], *conditions).agg(
        F.sum("crash_detected").cast("long").alias("total_crashes"),
        F.count(F.lit(1)).alias("total_frames"),
        F.avg("crash_detected").alias("crash_rate"),
        F.grouping_id(*conditions).alias("_gid"))
    gid = F.col("_gid")
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, c in enumerate(conditions):
        # grouping_id clears bit (n-1-i) for the one column grouped in this set.
        mask = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        name = F.when(gid == mask, F.lit(c)).otherwise(name)
        value = F.when(gid == mask, F.col(c).cast("string")).otherwise(value)
    return agg.select(name.alias("condition"), value.alias("value"),
                      "total_crashes", "total_frames", "crash_rate")
