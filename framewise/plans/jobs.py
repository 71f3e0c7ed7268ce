"""Whole jobs: the public entry points a user of the original scripts runs.

Each job reads, computes lazily, and writes; intermediate tables that several
outputs reuse are written once as Parquet tables in the shared folder named
by ``spark.checkpoint.dir`` (never a local-only checkpoint), so a lost
executor re-reads them instead of recomputing the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.operators import anomaly as A
from framewise.operators import clean as C
from framewise.operators import cube as CB
from framewise.operators import frames as FR
from framewise.operators import images as IM
from framewise.operators import metrics as M
from framewise.operators import reports as R
from framewise.schemas import N_FRAMES
from framewise.session import ensure_checkpoint_dir, materialize, scratch
from framewise.sources import images as SI
from framewise.sources import sinks as SK
from framewise.sources.image_objects import write_objects


def analyse_crash_records(spark: SparkSession, records: DataFrame, out_dir: str,
                          n_frames: int = N_FRAMES, unique_ids: bool | None = None, copy_source: bool = False,
                          parallel_writes: int = 8) -> dict[str, str]:
    """J1: frames, metrics, anomalies, report and chart tables, and the counts of what was read.

    ``records`` are wide crash records with ``sequence_id`` (add one with
    ``frames.add_sequence_id`` first).  The per-sequence table is folded from
    the record arrays without a shuffle; if an id turns out to be there twice,
    it is grouped from the frame rows instead, or, with ``unique_ids=True``,
    the job stops before it writes anything (``False``: grouped at once).
    ``counts`` (records, frames, null ids and flags, crashes) come from the same
    table, without a further pass over the source.  A stored table is read by the passes that
    need it; ``copy_source`` writes other sources down first.  The two tables of
    a row a frame (``frames_json``, ``frame_level_data``) are gzip files.  Up to
    ``parallel_writes`` independent output jobs run at the same time.
    """
    ensure_checkpoint_dir(spark)
    with scratch(spark) as tmp:
        return _analyse(spark, records, out_dir.rstrip("/"), n_frames, unique_ids, copy_source, parallel_writes, tmp)


def _analyse(spark, records, out, n_frames, unique_ids, copy_source, parallel_writes, tmp) -> dict[str, str]:
    if copy_source:
        records = materialize(records, "records", tmp)
    frames = FR.to_frame_rows(records, n_frames)        # narrow explode, never stored
    # One row a record, written in the one pass over all flags; everything but the frame tables comes from it.
    rows = materialize(M.sequence_stats_from_records(records, n_frames, null_flags="null_flags"), "sequences", tmp)
    counts = M.read_counts(rows)
    if unique_ids is not False:
        repeated = not rows.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        if repeated and unique_ids:
            raise ValueError("unique_ids=True, but a sequence_id is there more than once")
        unique_ids = not repeated
    seq = rows.drop("null_flags") if unique_ids else M.sequence_stats(frames)
    # Flagged once: the threshold subquery runs a single time for all outputs.
    flagged = materialize(A.flag_anomalies(seq), "sequences", tmp)
    thresholds = M.anomaly_thresholds(flagged)
    # All frame-level reports come from one aggregate pass over the frames;
    # the cube is bounded by category cardinalities, not by the frame count.
    cube = materialize(CB.frame_cube(frames), "frame_cube", tmp)
    crash = CB.crash_metrics(cube)
    anomaly = A.anomaly_metrics(flagged)
    writes = {
        "metrics": lambda: SK.metrics_export(A.analysis_metrics(crash, anomaly), f"{out}/metrics"),
        "counts": lambda: SK.sink_json(counts, f"{out}/counts"),
        "frames_json": lambda: SK.sink_json(frames, f"{out}/analysis_results", compression="gzip"),
    }
    reports = {
        "frame_level_data": FR.frame_level_data(frames),
        "sequence_level_data": flagged,
        "crash_summary": CB.crash_summary(cube),
        "crashes_by_time": CB.crashes_by_time(cube),
        "anomaly_summary": R.anomaly_summary(flagged),
    }
    for name, df in reports.items():
        writes[name] = (lambda n, d: lambda: SK.sink_csv(d, f"{out}/report/{n}", compression="gzip" if n == "frame_level_data" else "none",
                                                         single_file=n not in ("frame_level_data", "sequence_level_data")))(name, df)
    charts = {
        "crash_histogram": R.crash_histogram(flagged),
        "anomalies_by_time": R.anomalies_by_time(flagged),
        "anomalies_by_weather": R.anomalies_by_weather(flagged),
        "ego_scatter": R.ego_scatter(flagged),
        "weather_boxplot": R.weather_boxplot(flagged),
        "anomaly_crosstab": R.anomaly_crosstab(flagged),
        "density_timeline": R.density_timeline(flagged),
        "density_by_sequence": R.density_by_sequence(flagged, thresholds),
        "crash_distribution": CB.crash_distribution(cube),
        "crash_heatmap": (CB.heatmap_from_records(records, n_frames) if unique_ids
                          else R.crash_heatmap(frames, n_frames)),
        "crashes_by_ego": CB.crashes_by_ego(cube),
        "crashes_by_weather": CB.crashes_by_weather(cube),
        "startframe_counts": CB.startframe_counts(cube),
        "frame_timeline": CB.frame_timeline(cube),
        "crash_share": CB.crash_share(cube),
        "kpi_cards": R.kpi_cards(crash, anomaly),
        "rate_by_condition": CB.rate_by_condition(cube),
    }
    for name, df in charts.items():
        writes[name] = (lambda n, d: lambda: SK.sink_parquet(d, f"{out}/charts/{n}"))(name, df)
    return SK.run_writes(writes, parallel_writes)


def clean_job(spark: SparkSession, source: DataFrame | str, out_path: str) -> str:
    """J2: catalog table (or DataFrame) → dedupe → drop nulls → project → Parquet."""
    df = spark.table(source) if isinstance(source, str) else source
    return SK.sink_parquet(C.clean_records(df), out_path)


def ingest_job(spark: SparkSession, src: str, table_path: str, glob: str = "*", images_per_file: int = 0) -> str:
    """J3: image folder → image table (append; re-runs open new files only)."""
    return SI.ingest_images(spark, src, table_path, glob, skip_existing=True, images_per_file=images_per_file)


def feature_job(spark: SparkSession, image_table: str, out_root: str, files_per_trigger: int = 10,
                block: int = 8, state_partitions: int | None = None) -> dict[str, str]:
    """J4: incremental, restartable feature extraction from the table that ``ingest_job`` writes.

    ``block`` is the side of the pixel squares that the background test sees,
    ``state_partitions`` deals the videos' backgrounds, for good at the first run.
    Re-running it takes only what was ingested since the last run (the
    checkpoints lie under ``out_root``); ``read_features`` gives the result, and
    ``scan_image_table`` shows the processed marks."""
    from framewise.streaming.kept_features import run_table_features
    root = out_root.rstrip("/")
    run_table_features(spark, image_table, root, files_per_trigger, block, state_partitions=state_partitions)
    return {name: f"{root}/{name}" for name in ("features", "dead_letter", "progress", "checkpoint")}


def read_features(spark: SparkSession, out_root: str) -> DataFrame:
    """video, frame, path, traffic_density, processing_timestamp: the features that ``feature_job`` has stored."""
    from framewise.streaming.kept_features import feature_log
    return feature_log(spark, out_root.rstrip("/")).read()


def resize_job(spark: SparkSession, src: str, out_root: str, videos: DataFrame, frames_per_video: int = 50,
               glob: str = "*", size: tuple[int, int] = (128, 128), ext: str = ".jpg") -> dict[str, str]:
    """J5: resize every stored image and write it as an object under its new key; report bad and missing ones.

    One pass decodes and resizes the folder into ``images`` (path, filename,
    status, and the resized row where the status is ``ok``), keyed by the full
    path.  ``objects`` holds one PNG per good image: its name with ``.png``,
    under the folder it lay in if several folders are read.  ``bad`` lists the
    others with the reason.  ``missing`` lists the keys of the manifest (names
    with ``ext``) of which no object is stored, whatever its extension.
    """
    from framewise.operators.resize import resize_images
    root = out_root.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ("images", "objects", "bad", "missing")}
    rows = SI.image_rows(SI.decode_images(spark, src, glob=glob), SI.location("image.origin").alias("path"))
    SK.sink_parquet(resize_images(rows, size, keep=("path",)), paths["images"], compression="zstd")
    images = spark.read.parquet(paths["images"])
    stem = F.regexp_replace("filename", r"\.[^.]*$", "")
    several = images.select(F.regexp_replace("path", "[^/]*$", "")).distinct().limit(2).count() > 1
    folder = F.concat(F.element_at(F.split("path", "/"), -2), F.lit("/")) if several else F.lit("")
    good = images.where("status = 'ok'").withColumn("key", F.concat(folder, stem, F.lit(".png")))
    write_objects(SI.png_objects(good, "key"), paths["objects"], "overwrite")
    SK.sink_parquet(images.where("status <> 'ok'").select("path", "filename", F.col("status").alias("reason")), paths["bad"])
    expected = IM.image_manifest(videos, frames_per_video, ext=ext).withColumn("stem", stem)
    stored = SI.list_images(spark, src, glob).select(stem.alias("stem"))
    SK.sink_parquet(IM.missing_images(expected, stored, "stem").drop("stem"), paths["missing"])
    return paths


def weather_report(spark: SparkSession, clean_path: str) -> DataFrame:
    """J6: records per weather from the cleaned Parquet directory."""
    return R.weather_counts(spark.read.parquet(clean_path))


def severity_job(train_rows: DataFrame, num_trees: int = 100):
    """J7: split, fit, score; returns (model, accuracy one-row DataFrame)."""
    from framewise.operators import model as ML
    train, test = ML.ml_split(train_rows)
    fitted = ML.train_severity_model(train, num_trees=num_trees)
    return fitted, ML.model_accuracy(ML.predict(fitted, test))


def profile_images(spark: SparkSession, table_path: str) -> tuple[DataFrame, DataFrame]:
    """J8: (per-image profile with defaults, document count)."""
    table = SI.scan_image_table(spark, table_path)
    profile = table.select(IM.default_name("filename").alias("filename"), "has_payload", "height", "width", "nChannels", "mode")
    count = table.agg(F.count(F.lit(1)).alias("documents"))
    return profile, count
