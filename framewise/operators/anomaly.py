"""Anomalous-sequence detection: strict ``crash_count > least(mean+std, p90)``.

The threshold is a one-row aggregate consumed as a scalar subquery: Spark runs
it once and inlines the value into the filter, so there is no join and no
pass of the sequence table through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.operators.metrics import anomaly_thresholds, with_one_row


def flag_anomalies(seq: DataFrame, thresholds: DataFrame | None = None, q: float = 0.9) -> DataFrame:
    """Sequence rows plus ``is_anomaly`` (never null: a null count is not anomalous)."""
    thresholds = thresholds if thresholds is not None else anomaly_thresholds(seq, q)
    t = thresholds.select("final_threshold").scalar()
    return seq.withColumn("is_anomaly", F.coalesce(F.col("crash_count") > t, F.lit(False)))


def anomaly_metrics(flagged: DataFrame, q: float = 0.9) -> DataFrame:
    """One row: anomaly count and share plus the thresholds behind them.

    Computed in one aggregate pass over the flagged table; the thresholds are
    re-derived in the same pass, so they always match the flags' input.
    """
    return (flagged
            .agg(F.count_if(F.col("is_anomaly")).alias("anomalies_count"),
                 F.count(F.lit(1)).alias("total_sequences"),
                 F.avg("crash_count").alias("avg_crashes_per_sequence"),
                 F.stddev_samp("crash_count").alias("std_crashes"),
                 F.percentile("crash_count", q).alias("percentile_threshold"))
            .withColumn("anomaly_percentage",
                        F.try_divide(F.col("anomalies_count"), F.col("total_sequences")) * 100)
            .withColumn("statistical_threshold",
                        F.col("avg_crashes_per_sequence") + F.col("std_crashes"))
            .withColumn("final_threshold",
                        F.least(F.col("statistical_threshold"), F.col("percentile_threshold"))))


def analysis_metrics(frames_metrics: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Merge the crash metrics row and the anomaly metrics row into one row."""
    merged = with_one_row(anomaly, frames_metrics, "_m")
    return merged.select(*[F.col(f"_m.{c}").alias(c) for c in frames_metrics.columns], *anomaly.columns)
