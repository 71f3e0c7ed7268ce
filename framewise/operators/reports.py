"""Report and chart tables over frame rows and flagged sequence rows.

Null-key rule: tables the original pipeline built with Spark ``groupBy`` keep
a null group; tables it built with pandas/seaborn (which drop null keys) filter
null keys first.  Each function says which.

Scale notes: every table is a partial + final aggregate over low-cardinality
keys, so shuffles carry at most (map tasks x groups) rows.  Per-group order
statistics (box plot) are computed from a per-group histogram of crash counts,
which has at most (distinct counts) rows per group -- never a whole group's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.frames import crash_frames
from framewise.operators.metrics import with_one_row
from framewise.schemas import DAY, N_FRAMES, NIGHT


def crash_summary(frames: DataFrame) -> DataFrame:
    """Crashes, frames and rate by time of day x weather x ego (null groups kept)."""
    return (frames.groupBy("time_of_day", "weather", "egoinvolve")
            .agg(F.sum("crash_detected").cast("long").alias("total_crashes"),
                 F.count(F.lit(1)).alias("total_frames"),
                 F.avg("crash_detected").alias("crash_rate")))


def crashes_by_time(frames: DataFrame) -> DataFrame:
    """Crash frames per time of day."""
    return crash_frames(frames).groupBy("time_of_day").agg(F.count(F.lit(1)).alias("crash_count"))


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    """Per time x weather: anomaly count, mean/max of count and density.

    Means run over all sequences of the group, anomalous or not.  Null keys
    are dropped (pandas grouping).
    """
    return (flagged.where(F.col("time_of_day").isNotNull() & F.col("weather").isNotNull())
            .groupBy("time_of_day", "weather")
            .agg(F.sum(F.col("is_anomaly").cast("long")).alias("anomaly_count"),
                 F.avg("crash_count").alias("avg_crashes"),
                 F.max("crash_count").alias("max_crashes"),
                 F.avg("crash_density").alias("avg_density"),
                 F.max("crash_density").alias("max_density")))


def weather_counts(records: DataFrame) -> DataFrame:
    """Records per weather value, most frequent first (null weather dropped)."""
    return (records.where(F.col("weather").isNotNull())
            .groupBy("weather").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "weather"))


def crash_distribution(frames: DataFrame) -> DataFrame:
    """Frames per flag value with label and share of all non-null flags.

    The label comes from the value (1 → "Crash", 0 → "No Crash"), not from
    frequency rank.  The share window runs over the aggregated rows only.
    """
    counts = (frames.where(F.col("crash_detected").isNotNull())
              .groupBy("crash_detected").agg(F.count(F.lit(1)).alias("frame_count")))
    label = (F.when(F.col("crash_detected") == 1, "Crash")
             .when(F.col("crash_detected") == 0, "No Crash")
             .otherwise(F.col("crash_detected").cast("string")))
    total = F.sum("frame_count").over(Window.partitionBy())
    return (counts.select("crash_detected", label.alias("label"), "frame_count",
                          (F.try_divide(F.col("frame_count"), total) * 100).alias("percentage"))
            .orderBy(F.desc("frame_count"), "crash_detected"))


def _crash_count_by(frames: DataFrame, key: str) -> DataFrame:
    return (crash_frames(frames).where(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias("crash_count")))


def crashes_by_ego(frames: DataFrame) -> DataFrame:
    """Crash frames per ego-involvement value (null dropped)."""
    return _crash_count_by(frames, "egoinvolve")


def crashes_by_weather(frames: DataFrame) -> DataFrame:
    """Crash frames per weather value (null dropped)."""
    return _crash_count_by(frames, "weather")


def anomalous(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("is_anomaly"))


def anomalies_by_time(flagged: DataFrame) -> DataFrame:
    """Anomalous sequences per time of day."""
    return (anomalous(flagged).where(F.col("time_of_day").isNotNull())
            .groupBy("time_of_day").agg(F.count(F.lit(1)).alias("anomaly_count")))


def anomalies_by_weather(flagged: DataFrame) -> DataFrame:
    """Anomalous sequences per weather (null dropped)."""
    return (anomalous(flagged).where(F.col("weather").isNotNull())
            .groupBy("weather").agg(F.count(F.lit(1)).alias("anomaly_count")))


def anomaly_crosstab(flagged: DataFrame) -> DataFrame:
    """Weather x time-of-day cross-tab of anomalies; one conditional count per column."""
    return (anomalous(flagged).where(F.col("weather").isNotNull())
            .groupBy("weather")
            .agg(F.count_if(F.col("time_of_day") == DAY).alias(DAY),
                 F.count_if(F.col("time_of_day") == NIGHT).alias(NIGHT)))


def heatmap_col(i: int) -> str:
    return f"f_{i}"


def crash_heatmap(frames: DataFrame, n_frames: int = N_FRAMES) -> DataFrame:
    """Sequence x frame-number matrix of summed flags, missing cells = 0.

    A pivot with listed values written as conditional sums, so it is ONE
    partial/final aggregate keyed by sequence (Spark's two-phase pivot would
    shuffle twice).
    """
    cells = [F.expr(f"CAST(coalesce(sum(CASE WHEN frame_number = {i} THEN crash_detected END), 0) AS BIGINT)")
             .alias(heatmap_col(i)) for i in range(n_frames)]
    return frames.groupBy("sequence_id").agg(*cells)


def frame_timeline(frames: DataFrame) -> DataFrame:
    """Mean flag per frame number (the traffic-flow line)."""
    return (frames.groupBy("frame_number")
            .agg(F.avg("crash_detected").alias("crash_rate"))
            .orderBy("frame_number"))


def startframe_counts(frames: DataFrame) -> DataFrame:
    """Non-null ``vidname`` count per start frame, over frame rows."""
    return (frames.where(F.col("startframe").isNotNull())
            .groupBy("startframe").agg(F.count("vidname").alias("vidname_count")))


def crash_histogram(seq: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of crash counts: ``bin, bin_start, bin_end, count``.

    Bin = least(bins-1, floor((x - min) * bins / (max - min))) in integer
    arithmetic (the last bin is closed).  When min = max the range is widened
    to [min - 0.5, max + 0.5] and every value falls in the middle bin.  All
    ``bins`` rows are produced, empty ones with count 0.
    """
    x = F.col("crash_count")
    # One pass over the sequences: fold them into a value histogram (partial
    # aggregate; crash counts take at most n_frames + 1 values), then take
    # min/max and bins from that small table.  No null filter on the input:
    # min/max/count(x) skip nulls, and the null value's bin is dropped by the
    # join to the bin edges.
    values = seq.groupBy("crash_count").agg(F.count(x).alias("n"))
    rng_df = values.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = F.col("_rng.lo"), F.col("_rng.hi")
    bin_expr = F.when(hi == lo, F.lit(bins // 2).cast("long")).otherwise(
        F.least(F.lit(bins - 1).cast("long"), F.floor(((x - lo) * bins) / (hi - lo)).cast("long")))
    counts = (with_one_row(values, rng_df, "_rng")
              .groupBy(bin_expr.alias("bin")).agg(F.sum("n").alias("count")))
    lo_c, hi_c = F.col("lo"), F.col("hi")
    start = F.when(hi_c == lo_c, lo_c - 0.5).otherwise(lo_c.cast("double"))
    step = F.when(hi_c == lo_c, F.lit(1.0) / bins).otherwise((hi_c - lo_c).cast("double") / bins)
    edges = (rng_df.where(lo_c.isNotNull())
             .select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
             .select(F.col("bin").cast("long").alias("bin"),
                     (start + F.col("bin") * step).alias("bin_start"),
                     (start + (F.col("bin") + 1) * step).alias("bin_end")))
    return (edges.join(counts, "bin", "left")
            .select("bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def weather_boxplot(flagged: DataFrame, whis: float = 1.5) -> DataFrame:
    """Box-plot statistics of crash counts per weather (null weather dropped).

    Quartiles are linear-interpolation percentiles; whiskers are the most
    extreme counts inside [q1 - whis*iqr, q3 + whis*iqr]; outliers lie outside.
    Everything is computed on the (weather, crash_count) histogram, whose size
    is bounded by the number of distinct counts per weather, not by the rows.
    """
    hist = (flagged.where(F.col("weather").isNotNull() & F.col("crash_count").isNotNull())
            .groupBy("weather", "crash_count").agg(F.count(F.lit(1)).alias("n")))
    qs = (hist.groupBy("weather")
          .agg(F.percentile("crash_count", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
               F.sum("n").alias("n_sequences"))
          .select("weather", "n_sequences",
                  F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")))
    qs = (qs.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - whis * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + whis * F.col("iqr")))
    x = F.col("crash_count")
    inside = (x >= F.col("lower_fence")) & (x <= F.col("upper_fence"))
    per = (hist.join(qs, "weather")
           .groupBy("weather", "n_sequences", "q1", "median", "q3", "iqr", "lower_fence", "upper_fence")
           .agg(F.min(F.when(inside, x)).alias("whisker_low"),
                F.max(F.when(inside, x)).alias("whisker_high"),
                F.sum(F.when(~inside, F.col("n")).otherwise(0)).cast("long").alias("n_outliers")))
    return per


def ego_scatter(flagged: DataFrame) -> DataFrame:
    """Crash count vs ego involvement with the anomaly flag."""
    return flagged.select("sequence_id", "crash_count", "egoinvolve", "is_anomaly")


def density_timeline(flagged: DataFrame) -> DataFrame:
    """Density of anomalous sequences ordered by sequence id."""
    return anomalous(flagged).select("sequence_id", "crash_density").orderBy("sequence_id")


def density_by_sequence(flagged: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Density and count of every sequence with the final threshold beside it."""
    t = thresholds.select("final_threshold").scalar()
    return (flagged.select("sequence_id", "crash_density", "crash_count", "is_anomaly",
                           t.alias("final_threshold"))
            .orderBy("sequence_id"))


def kpi_cards(frames_metrics: DataFrame, anomaly: DataFrame) -> DataFrame:
    """One row: total crashes, anomaly percentage, crash rate."""
    return (with_one_row(anomaly, frames_metrics.select("total_crashes", "crash_rate"), "_c")
            .select(F.col("_c.total_crashes").alias("total_crashes"), "anomaly_percentage",
                    F.col("_c.crash_rate").alias("crash_rate")))
