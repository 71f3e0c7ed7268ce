from pyspark.sql import types as T

from framewise.schemas import crash_record_schema, frame_cols


def records_df(spark, rows, n_frames=3, flag_type=T.IntegerType()):
    """Wide records from (vidname, timing, weather, egoinvolve, flags...) tuples."""
    schema = crash_record_schema(n_frames, flag_type)
    data = []
    for vid, timing, weather, ego, *flags in rows:
        data.append((vid, 1, f"yt{vid}", timing, weather, ego, *flags))
    df = spark.createDataFrame(data, schema)
    return df.withColumn("sequence_id", df["vidname"].cast("long"))


__all__ = ["records_df", "frame_cols"]
