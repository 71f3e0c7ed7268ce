"""Image-table operators: key manifest, missing keys, basenames, defaults,
profiles and the dead-letter split.

Decoding is Spark's own ``image`` data source (BGR bytes, OpenCV mode codes);
these functions only reshape its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.functions.columns import basename, not_true

# The image key format (video and frame numbers are 1-based).
KEY_FORMAT = "C_%06d_%02d"
FRAMES_PER_VIDEO = 50


def image_key(video, frame, ext: str = ".jpg"):
    """``C_{video:06d}_{frame:02d}{ext}`` as a column."""
    return F.format_string(KEY_FORMAT + ext, video, frame)


def parse_image_key(name_col="filename") -> list:
    """``video``, ``frame`` ints parsed back out of a key or path; null for other names."""
    name = basename(name_col) if isinstance(name_col, str) else name_col
    pat = r"C_(\d+)_(\d+)"
    return [F.regexp_extract(name, pat, 1).try_cast("long").alias("video"),
            F.regexp_extract(name, pat, 2).try_cast("long").alias("frame")]


def image_manifest(videos: DataFrame, frames_per_video: int = FRAMES_PER_VIDEO,
                   video_col: str = "video", ext: str = ".jpg") -> DataFrame:
    """Expected keys: every frame 1..n of every listed video.

    Generated per video row with ``explode(sequence(...))`` -- distributed with
    the video list, no cross join and nothing built on the driver.
    """
    return (videos.select(F.col(video_col).cast("long").alias("video")).distinct()
            .select("video", F.explode(F.sequence(F.lit(1), F.lit(frames_per_video))).alias("frame"))
            .select("video", F.col("frame").cast("long").alias("frame"),
                    image_key(F.col("video"), F.col("frame"), ext).alias("filename")))


def missing_images(expected: DataFrame, stored: DataFrame, key: str = "filename") -> DataFrame:
    """Expected keys with no stored object (anti join on the key)."""
    return expected.join(stored.select(key).distinct(), key, "left_anti")


def with_basename(df: DataFrame, path_col: str = "path", name: str = "filename") -> DataFrame:
    return df.withColumn(name, basename(path_col))


def unprocessed(images: DataFrame, flag: str = "processed") -> DataFrame:
    """Rows whose flag is false, null or missing (null-safe ``!= true``)."""
    if flag not in images.columns:
        return images
    return images.where(not_true(flag))


def default_name(name_col: str = "filename", default: str = "unknown"):
    """A document's name, or the default where it has none."""
    return F.coalesce(F.col(name_col), F.lit(default))


def field_defaults(docs: DataFrame, name_col: str = "filename", payload_col: str = "image",
                   default: str = "unknown") -> DataFrame:
    """Default a missing name and flag a missing payload."""
    return (docs.withColumn(name_col, default_name(name_col, default))
            .withColumn("has_payload", F.col(payload_col).isNotNull()))


def image_profile(images: DataFrame) -> DataFrame:
    """Size and mode per decoded image (``image`` source rows)."""
    return images.select(basename(F.col("image.origin")).alias("filename"),
                         F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                         F.col("image.nChannels").alias("nChannels"), F.col("image.mode").alias("mode"))


def split_decoded(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): undecodable images have height -1 in the ``image`` source."""
    ok = F.col("image.height") > 0
    good = images.where(ok)
    bad = (images.where(~ok)
           .select(F.col("image.origin").alias("path"), basename(F.col("image.origin")).alias("filename"),
                   F.lit("undecodable").alias("reason")))
    return good, bad
