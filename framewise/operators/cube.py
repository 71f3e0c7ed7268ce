"""Frame-level reports from one pre-aggregated "frame cube".

Every frame-level report groups by a subset of (time_of_day, weather,
egoinvolve, startframe, frame_number, crash_detected).  Aggregating the frame
rows ONCE to that key set (with counts) and deriving each report from the
cube turns N passes over the frame rows into one.  The cube has at most a row
for each time, weather, ego value, start frame, frame number and flag value.
Start frames are data, not categories: with as many of them as records the cube
is as large as the frame rows, and only spares reading the source again.

Each function returns exactly what its counterpart in ``reports``/``metrics``
returns on the raw frame rows (checked by tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CUBE_KEYS = ["time_of_day", "weather", "egoinvolve", "startframe", "frame_number", "crash_detected"]


def frame_cube(frames: DataFrame) -> DataFrame:
    """Frames counted per report key: ``n`` rows, ``n_vidname`` non-null video names."""
    return frames.groupBy(*CUBE_KEYS).agg(F.count(F.lit(1)).alias("n"),
                                          F.count("vidname").alias("n_vidname"))


def _flag():
    return F.col("crash_detected")


def _crashes():
    """sum(crash_detected) over the frames a cube row stands for."""
    return F.sum(_flag().cast("long") * F.col("n")).cast("long")


def _frames():
    """count(*) over the frames."""
    return F.sum("n").cast("long")


def _rate():
    """avg(crash_detected): crash sum over non-null flags."""
    valid = F.sum(F.when(_flag().isNotNull(), F.col("n"))).cast("double")
    return F.try_divide(_crashes().cast("double"), valid)


def crash_metrics(cube: DataFrame) -> DataFrame:
    return (cube.agg(_crashes().alias("total_crashes"), _rate().alias("crash_rate"),
                     F.coalesce(_frames(), F.lit(0).cast("long")).alias("total_frames"))
            .withColumn("crash_percentage", F.col("crash_rate") * 100))


def crash_summary(cube: DataFrame) -> DataFrame:
    return (cube.groupBy("time_of_day", "weather", "egoinvolve")
            .agg(_crashes().alias("total_crashes"), _frames().alias("total_frames"), _rate().alias("crash_rate")))


def crashes_by_time(cube: DataFrame) -> DataFrame:
    return cube.where(_flag() == 1).groupBy("time_of_day").agg(_frames().alias("crash_count"))


def _crash_count_by(cube: DataFrame, key: str) -> DataFrame:
    return (cube.where((_flag() == 1) & F.col(key).isNotNull())
            .groupBy(key).agg(_frames().alias("crash_count")))


def crashes_by_ego(cube: DataFrame) -> DataFrame:
    return _crash_count_by(cube, "egoinvolve")


def crashes_by_weather(cube: DataFrame) -> DataFrame:
    return _crash_count_by(cube, "weather")


def crash_distribution(cube: DataFrame) -> DataFrame:
    counts = cube.where(_flag().isNotNull()).groupBy("crash_detected").agg(_frames().alias("frame_count"))
    label = (F.when(_flag() == 1, "Crash").when(_flag() == 0, "No Crash").otherwise(_flag().cast("string")))
    total = F.sum("frame_count").over(Window.partitionBy())
    return (counts.select("crash_detected", label.alias("label"), "frame_count",
                          (F.try_divide(F.col("frame_count"), total) * 100).alias("percentage"))
            .orderBy(F.desc("frame_count"), "crash_detected"))


def frame_timeline(cube: DataFrame) -> DataFrame:
    return cube.groupBy("frame_number").agg(_rate().alias("crash_rate")).orderBy("frame_number")


def startframe_counts(cube: DataFrame) -> DataFrame:
    return (cube.where(F.col("startframe").isNotNull())
            .groupBy("startframe").agg(F.sum("n_vidname").cast("long").alias("vidname_count")))


def crash_share(cube: DataFrame) -> DataFrame:
    return (cube.agg(F.coalesce(F.sum(F.when(_flag() == 1, F.col("n"))), F.lit(0)).cast("long").alias("total_crashes"),
                     F.coalesce(_frames(), F.lit(0).cast("long")).alias("total_frames"))
            .withColumn("crash_share_pct", F.try_divide(F.col("total_crashes"), F.col("total_frames")) * 100))


def rate_by_condition(cube: DataFrame,
                      conditions: tuple[str, ...] = ("time_of_day", "weather", "egoinvolve")) -> DataFrame:
    n = len(conditions)
    agg = cube.groupingSets([[c] for c in conditions], *conditions).agg(
        _crashes().alias("total_crashes"), _frames().alias("total_frames"), _rate().alias("crash_rate"),
        F.grouping_id(*conditions).alias("_gid"))
    gid = F.col("_gid")
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, c in enumerate(conditions):
        mask = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        name = F.when(gid == mask, F.lit(c)).otherwise(name)
        value = F.when(gid == mask, F.col(c).cast("string")).otherwise(value)
    return agg.select(name.alias("condition"), value.alias("value"),
                      "total_crashes", "total_frames", "crash_rate")


def heatmap_from_records(records: DataFrame, n_frames: int = 50, id_col: str = "sequence_id") -> DataFrame:
    """Sequence x frame matrix straight from wide records (one record = one sequence): no shuffle."""
    cells = [F.expr(f"CAST(coalesce(`frame_{i + 1}`, 0) AS BIGINT)").alias(f"f_{i}") for i in range(n_frames)]
    return records.select(F.col(id_col).alias("sequence_id"), *cells)
