"""Whole jobs J1-J8 as queries: each runs the job into the shared folder and
returns one of the tables it wrote, so the gate checks the job end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.columns import basename
from framewise.plans import jobs as J
from framewise.plans import tables as TB
from framewise.plans.oracles_media import JOB_OUTPUTS
from framewise.plans.registry import QUERIES, query
from framewise.session import shared_dir
from framewise.sources import bindings as B
from framewise.sources import images as SI


@TB.once
def _analysis(spark, d) -> dict[str, str]:
    """J1's outputs."""
    return J.analyse_crash_records(spark, TB.records(spark, d), shared_dir(spark, "job_analysis"), copy_source=True)


@query("job_analysis_metrics")
def _job_analysis_metrics(spark, d):
    """J1: the metrics file the analysis job writes (timestamp dropped)."""
    return spark.read.json(_analysis(spark, d)["metrics"]).drop("validation_timestamp")


@query("job_analysis_counts")
def _job_analysis_counts(spark, d):
    """J1: the counts of what was read, nulls among them."""
    return spark.read.json(_analysis(spark, d)["counts"])


@query("job_analysis_sequences")
def _job_analysis_sequences(spark, d):
    """J1: the sequence-level report (CSV) the analysis job writes."""
    schema = ("sequence_id long, time_of_day string, weather string, egoinvolve string, crash_count long, "
              "crash_density double, total_frames long, is_anomaly boolean")
    return spark.read.option("header", True).schema(schema).csv(_analysis(spark, d)["sequence_level_data"])


@query("job_analysis_frames_json")
def _job_analysis_frames_json(spark, d):
    return spark.read.schema(TB.frames(spark, d).schema).json(_analysis(spark, d)["frames_json"])


def _job_output(name):
    def run(spark, d):
        """A report (CSV) or chart table (Parquet) of J1, read back."""
        path = _analysis(spark, d)[name]
        if "/report/" in path:
            return spark.read.option("header", True).schema(QUERIES[name](spark, d).schema).csv(path)
        return spark.read.parquet(path)
    return run


for _name in JOB_OUTPUTS:
    query(f"job_analysis_{_name}")(_job_output(_name))


@TB.once
def _cleaned(spark, d) -> str:
    view = "crash_records_source"
    TB.cleaning_input(spark, d).createOrReplaceTempView(view)
    return J.clean_job(spark, view, shared_dir(spark, "job_clean"))


@query("job_clean")
def _job_clean(spark, d):
    """J2: catalog table -> cleaned Parquet, read back."""
    return spark.read.parquet(_cleaned(spark, d))


@query("job_weather_report")
def _job_weather_report(spark, d):
    """J6: weather counts from the cleaned Parquet directory."""
    return J.weather_report(spark, _cleaned(spark, d))


@query("job_severity_model")
def _job_severity_model(spark, d):
    """J7: split, fit and score; the accuracy row."""
    _, acc = J.severity_job(B.severity_training_rows(TB.records(spark, d)))
    return acc


@TB.once
def _ingested_table(spark, d) -> str:
    from framewise.plans.registry_media import _image_dir
    table = shared_dir(spark, "job_images")
    folder = _image_dir(spark, d)
    J.ingest_job(spark, folder, table)
    J.ingest_job(spark, folder, table)       # a re-run adds nothing
    return table


@query("job_ingest")
def _job_ingest(spark, d):
    """J3: image folder -> image table."""
    return SI.scan_image_table(spark, _ingested_table(spark, d)).select("filename", "height", "width", "nChannels", "mode")


@query("job_profile_images")
def _job_profile_images(spark, d):
    """J8: per-image profile of the image table."""
    profile, _ = J.profile_images(spark, _ingested_table(spark, d))
    return profile


@TB.once
def _resized(spark, d) -> dict[str, str]:
    """J5 over a folder that lacks every 7th image."""
    from framewise.plans.registry_media import _docs, _image_dir
    videos = _docs(spark, d).select("video")
    return J.resize_job(spark, _image_dir(spark, d, "vec_id % 7 <> 0"), shared_dir(spark, "job_resize"), videos)


@query("job_resize")
def _job_resize(spark, d):
    """J5: the objects it wrote under new keys, read back."""
    from framewise.plans.registry_media import _pixels_sha256
    rows = SI.image_rows(SI.decode_images(spark, _resized(spark, d)["objects"]))
    return rows.select("filename", "height", "width", "nChannels", _pixels_sha256())


@query("job_resize_bad")
def _job_resize_bad(spark, d):
    return spark.read.parquet(_resized(spark, d)["bad"]).select("filename", "reason")


@query("job_resize_missing")
def _job_resize_missing(spark, d):
    return spark.read.parquet(_resized(spark, d)["missing"])


@TB.once
def _fed_twice(spark, d) -> tuple[str, str]:
    """J3 and J4, twice: later frames of each video are stored and extracted before earlier ones."""
    from framewise.plans.registry_media import _image_dir
    root = shared_dir(spark, "job_features")
    for where in ("vec_id % 3 <> 1", "vec_id % 3 = 1"):
        J.ingest_job(spark, _image_dir(spark, d, where), f"{root}/images", images_per_file=200)
        J.feature_job(spark, f"{root}/images", root, files_per_trigger=8, block=1, state_partitions=8)
    return f"{root}/images", root


@query("job_features")
def _job_features(spark, d):
    """J4: incremental features from the stored image table."""
    _, root = _fed_twice(spark, d)
    return J.read_features(spark, root).select("video", "frame", basename("path").alias("filename"), "traffic_density")


@query("job_features_table")
def _job_features_table(spark, d):
    """J4 over J3's table: every stored document with its processed mark and its density."""
    table, root = _fed_twice(spark, d)
    feats = J.read_features(spark, root).select("path", "traffic_density")
    return SI.scan_image_table(spark, table).join(feats, "path", "left").select(
        "filename", F.coalesce("processed", F.lit(False)).alias("processed"), "traffic_density")
