"""Record → frame reshaping (unpivot of the per-frame flags) and frame filters.

``to_frame_rows`` is a narrow ``Generate`` (posexplode): no shuffle, and
Catalyst prunes unused record columns through it down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions.columns import flag_as_int, time_of_day
from framewise.schemas import FRAME_EXPORT_COLS, N_FRAMES, frame_cols


def add_sequence_id(records: DataFrame, method: str = "hash", key_cols: list[str] | None = None,
                    name: str = "sequence_id") -> DataFrame:
    """Attach a per-record sequence id.

    ``monotonic`` reproduces ``monotonically_increasing_id`` (unique, but tied to
    the physical partitioning, so ids change when the plan changes).  ``hash``
    (default) is ``xxhash64`` of the record key -- stable across actions and
    re-runs, so it can be compared and joined.  ``natural`` keeps a column as-is.
    """
    if method == "monotonic":
        return records.withColumn(name, F.monotonically_increasing_id())
    key_cols = key_cols or ["vidname"]
    if method == "natural":
        if len(key_cols) != 1:
            raise ValueError("natural ids take exactly one key column")
        return records.withColumn(name, F.col(key_cols[0]))
    if method == "hash":
        return records.withColumn(name, F.xxhash64(*[F.col(c) for c in key_cols]))
    raise ValueError(f"unknown id method {method!r}")


def conform_flags(records: DataFrame, n_frames: int = N_FRAMES) -> DataFrame:
    """Cast flag columns to int at the source boundary (bad text → null)."""
    cols = set(frame_cols(n_frames))
    return records.select(*[flag_as_int(c).alias(c) if c in cols else F.col(c) for c in records.columns])


def to_frame_rows(records: DataFrame, n_frames: int = N_FRAMES, id_col: str = "sequence_id") -> DataFrame:
    """One row per (sequence, frame): 0-based ``frame_number`` and ``crash_detected``.

    Null flags stay as rows (``posexplode`` keeps null elements), so they count
    in ``count(*)`` but not in ``sum``/``avg``.
    """
    flags = F.expr("array(" + ", ".join(f"`{c}`" for c in frame_cols(n_frames)) + ")")
    return (records
            .select(id_col, "timing", "egoinvolve", "weather", "vidname", "startframe",
                    F.posexplode(flags).alias("frame_number", "crash_detected"))
            .withColumn("time_of_day", time_of_day("timing")))


def crash_frames(frames: DataFrame) -> DataFrame:
    """Frames whose flag equals 1."""
    return frames.where(F.col("crash_detected") == 1)


def frame_level_data(frames: DataFrame) -> DataFrame:
    """Frame export projection."""
    return frames.select(*FRAME_EXPORT_COLS)


def default_startframe(frames: DataFrame) -> DataFrame:
    """Default ``startframe`` to ``frame_number`` when the column is absent."""
    if "startframe" in frames.columns:
        return frames
    return frames.withColumn("startframe", F.col("frame_number"))
