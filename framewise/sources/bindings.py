"""Bindings from the generic star-schema test tables to the crash-record model.

One ``part`` row is one video sequence; a ``lineitem`` row with return flag
``R`` and quantity ``q`` (1..n_frames) marks frame ``q`` of its part as a crash.

The wide record is built with ONE partial/final aggregate: each part's flags
are folded into a 64-bit mask with ``bit_or`` (map-side combine, so a part that
owns a third of all lineitems still emits one row per map task), then the mask
side -- already hash-partitioned on the part key -- is joined to ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.schemas import N_FRAMES, frame_cols

# Fixed values chosen for the bindings (test-data stand-ins, not domain rules).
TIMING_BY_KEY_MOD4 = {0: "Day", 1: "Night", 2: "Daytime"}  # 3 -> null
WEATHER_BY_TYPE_PREFIX = [("PROMO", "Snowy"), ("SMALL", "Rainy"), ("STANDARD", None)]
WEATHER_DEFAULT = "Normal"
CRASH_RETURNFLAG = "R"
#: A flag that is no crash is null where part key and frame add up to a multiple of this.
NULL_FLAG_STEP = 17


def crash_masks(lineitem: DataFrame, n_frames: int = N_FRAMES) -> DataFrame:
    """``l_partkey, mask``: bit i-1 is set when frame i holds a crash."""
    if not 0 < n_frames <= 63:
        raise ValueError("a 64-bit mask holds at most 63 frames")
    bit = F.expr("shiftleft(1L, CAST(l_quantity AS INT) - 1)")
    return (lineitem
            .where((F.col("l_returnflag") == CRASH_RETURNFLAG)
                   & F.col("l_quantity").between(1, n_frames))
            .groupBy("l_partkey")
            .agg(F.bit_or(bit).alias("mask")))


def record_attributes(part: DataFrame) -> DataFrame:
    """Per-part attribute columns of a crash record (no frame flags)."""
    key = F.col("p_partkey")
    timing = F.lit(None).cast("string")
    for mod, label in sorted(TIMING_BY_KEY_MOD4.items(), reverse=True):
        timing = F.when(key % 4 == mod, F.lit(label)).otherwise(timing)
    weather = F.lit(WEATHER_DEFAULT)
    for prefix, label in reversed(WEATHER_BY_TYPE_PREFIX):
        weather = F.when(F.col("p_type").startswith(prefix), F.lit(label).cast("string")).otherwise(weather)
    return part.select(
        key.alias("sequence_id"),
        F.lpad(key.cast("string"), 6, "0").alias("vidname"),
        F.col("p_size").cast("int").alias("startframe"),
        F.col("p_name").alias("youtubeid"),
        timing.alias("timing"),
        weather.alias("weather"),
        F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("No").alias("egoinvolve"),
    )


def crash_records(part: DataFrame, lineitem: DataFrame, n_frames: int = N_FRAMES) -> DataFrame:
    """Wide crash records: ``sequence_id``, the six attributes, ``frame_1..frame_n``."""
    masks = crash_masks(lineitem, n_frames)
    attrs = record_attributes(part)
    joined = attrs.join(masks, attrs["sequence_id"] == masks["l_partkey"], "left")
    # Wide projections are written as SQL expression text: one JVM call for
    # the whole list instead of several per column.
    flags = [f"CASE WHEN shiftright(mask, {i}) & 1 = 1 THEN 1 WHEN (sequence_id + {i}) % {NULL_FLAG_STEP} <> 0 THEN 0 END AS {c}"
             for i, c in enumerate(frame_cols(n_frames))]
    return joined.selectExpr(*attrs.columns, *flags)


def cleaning_input(part: DataFrame) -> DataFrame:
    """Dirty input of the clean job: attributes plus the part key, doubled."""
    attrs = record_attributes(part).withColumnRenamed("sequence_id", "p_partkey")
    return attrs.unionAll(attrs)


def severity_training_rows(records: DataFrame, n_frames: int = N_FRAMES, cutoff: int = 11) -> DataFrame:
    """Model input: attributes with ``crash_severity`` = crash_count > cutoff."""
    count = " + ".join(f"coalesce({c}, 0)" for c in frame_cols(n_frames))
    return records.select("sequence_id", "timing", "weather", "egoinvolve",
                          F.expr(f"CASE WHEN ({count}) > {int(cutoff)} THEN 1 ELSE 0 END").alias("crash_severity"))


def video_pixels(embeddings: DataFrame, frames_per_video: int = 50) -> DataFrame:
    """8x8 grey frames from embedding vectors: ``video, frame, pixel, v``.

    ``v`` = floor(clamp((x + 1) * 127.5, 0, 255)) as long; one row per pixel.
    """
    exploded = embeddings.selectExpr(f"vec_id div {int(frames_per_video)} AS video",
                                     f"CAST(vec_id % {int(frames_per_video)} AS BIGINT) AS frame", "posexplode(embedding) AS (pixel, x)")
    return exploded.selectExpr("video", "frame", "pixel",
                               "CAST(floor(least(255D, greatest(0D, (CAST(x AS DOUBLE) + 1) * 127.5D))) AS BIGINT) AS v")


def image_documents(embeddings: DataFrame, frames_per_video: int = 50) -> DataFrame:
    """Image-document stand-in: ``image_id, video, frame, filename, processed``.

    ``processed`` cycles true / false / null over ``vec_id % 3`` so all three
    states of the flag occur.
    """
    from framewise.operators.images import image_key

    video = F.expr(f"vec_id div {int(frames_per_video)}") + 1
    frame = F.col("vec_id") % frames_per_video + 1
    m = F.col("vec_id") % 3
    processed = F.when(m == 0, F.lit(True)).when(m == 1, F.lit(False))
    return embeddings.select(F.col("vec_id").alias("image_id"), video.alias("video"),
                             frame.cast("long").alias("frame"),
                             image_key(video, frame).alias("filename"), processed.alias("processed"))


def customer_documents(customer: DataFrame) -> DataFrame:
    """Documents with gaps: ``filename`` and ``image`` are null for some segments."""
    return customer.select("c_custkey",
                           F.expr("nullif(c_mktsegment, 'HOUSEHOLD')").alias("filename"),
                           F.expr("nullif(c_mktsegment, 'BUILDING')").alias("image"))


#: Blue, green and red of a pixel of the stand-in frames are levels of the vector, so many places on.
CHANNEL_STEPS = (0, 21, 42)


def frame_image_rows(embeddings: DataFrame, frames_per_video: int = 50) -> DataFrame:
    """Embedding vectors as square coloured frames in image-row form (BGR bytes).

    ``video, frame`` are 1-based; ``filename`` follows the image key format
    with ``.png``; ``corrupt`` marks the rows written as damaged files
    (vec_id % 97 = 0), so the dead-letter path has input.
    """
    from framewise.operators.images import image_key

    level = "lpad(hex(CAST(floor(least(255D, greatest(0D, (CAST(x AS DOUBLE) + 1) * 127.5))) AS INT)), 2, '0')"
    channels = ", ".join(f"levels[(i + {step}) % size(levels)]" for step in CHANNEL_STEPS)
    video = F.expr(f"vec_id div {int(frames_per_video)} + 1")
    frame = F.expr(f"vec_id % {int(frames_per_video)} + 1")
    side = F.expr("CAST(sqrt(size(embedding)) AS INT)")
    return embeddings.withColumn("levels", F.expr(f"transform(embedding, x -> {level})")).select(
        video.alias("video"), frame.cast("long").alias("frame"),
        image_key(video, frame, ".png").alias("filename"),
        side.alias("height"), side.alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"),
        F.expr(f"unhex(array_join(transform(levels, (x, i) -> concat({channels})), ''))").alias("data"),
        (F.col("vec_id") % 97 == 0).alias("corrupt"))
