"""Explicit schemas for every table the engine reads or writes.

Column names follow the crash-record data model (one wide row per video with
per-frame flags) so that a user of the original pipeline finds the same names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The record layout of the crash-record table.
N_FRAMES = 50
FRAME_PREFIX = "frame_"
RECORD_ATTRS = ["vidname", "startframe", "youtubeid", "timing", "weather", "egoinvolve"]
SEQUENCE_KEYS = ["sequence_id", "time_of_day", "weather", "egoinvolve"]
FRAME_EXPORT_COLS = ["sequence_id", "time_of_day", "egoinvolve", "weather",
                     "frame_number", "crash_detected"]
DAY, NIGHT = "Day", "Night"


def frame_cols(n_frames: int = N_FRAMES) -> list[str]:
    return [f"{FRAME_PREFIX}{i}" for i in range(1, n_frames + 1)]


def crash_record_schema(n_frames: int = N_FRAMES, flag_type: T.DataType = T.IntegerType()) -> T.StructType:
    fields = [
        T.StructField("vidname", T.StringType()),
        T.StructField("startframe", T.IntegerType()),
        T.StructField("youtubeid", T.StringType()),
        T.StructField("timing", T.StringType()),
        T.StructField("weather", T.StringType()),
        T.StructField("egoinvolve", T.StringType()),
    ]
    fields += [T.StructField(c, flag_type) for c in frame_cols(n_frames)]
    return T.StructType(fields)


FRAME_ROW_SCHEMA = T.StructType([
    T.StructField("sequence_id", T.LongType()),
    T.StructField("timing", T.StringType()),
    T.StructField("egoinvolve", T.StringType()),
    T.StructField("weather", T.StringType()),
    T.StructField("vidname", T.StringType()),
    T.StructField("startframe", T.IntegerType()),
    T.StructField("frame_number", T.IntegerType()),
    T.StructField("crash_detected", T.IntegerType()),
    T.StructField("time_of_day", T.StringType()),
])

SEQUENCE_ROW_SCHEMA = T.StructType([
    T.StructField("sequence_id", T.LongType()),
    T.StructField("time_of_day", T.StringType()),
    T.StructField("weather", T.StringType()),
    T.StructField("egoinvolve", T.StringType()),
    T.StructField("crash_count", T.LongType()),
    T.StructField("crash_density", T.DoubleType()),
    T.StructField("total_frames", T.LongType()),
    T.StructField("is_anomaly", T.BooleanType()),
])

IMAGE_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("image", T.BinaryType()),
    T.StructField("processed", T.BooleanType()),
])
