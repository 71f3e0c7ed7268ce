"""Whole jobs run end to end on sf0.001 and write every output."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import records_df
from framewise.operators.resize import resize_array
from framewise.plans import jobs as J
from framewise.plans import tables as TB
from framewise.sources import bindings as B
from framewise.sources import images as SI


def test_analysis_job_writes_all_tables(spark):
    out = tempfile.mkdtemp(prefix="fw-j1-")
    paths = J.analyse_crash_records(spark, TB.records(spark, SF001), out)
    metrics = spark.read.json(paths["metrics"]).collect()[0]
    assert metrics.total_frames == 10000.0 and metrics.anomalies_count == 39.0
    assert metrics.validation_timestamp
    seq = spark.read.option("header", True).csv(paths["sequence_level_data"])
    assert seq.count() == 200 and seq.where("is_anomaly = 'true'").count() == 39
    assert spark.read.parquet(paths["crash_heatmap"]).count() == 200
    assert spark.read.json(paths["frames_json"]).count() == 10000
    assert spark.read.parquet(paths["crash_histogram"]).agg(F.sum("count")).collect()[0][0] == 200


def test_analysis_job_grouped_form_agrees(spark):
    out = tempfile.mkdtemp(prefix="fw-j1g-")
    paths = J.analyse_crash_records(spark, TB.records(spark, SF001), out, unique_ids=False)
    assert spark.read.json(paths["metrics"]).collect()[0].anomalies_count == 39.0


def test_analysis_job_finds_repeated_ids(spark, tmp_path):
    """An id that is there twice: one sequence of the grouped form, or an error before any output."""
    records = records_df(spark, [("1", "Day", "Snowy", "Yes", 1, 0, 1), ("1", "Day", "Snowy", "Yes", 0, None, 1),
                                 ("2", "Night", None, "No", 0, 0, None), (None, None, None, None, 1, None, 0)])
    paths = J.analyse_crash_records(spark, records, f"{tmp_path}/a", n_frames=3)
    counts = spark.read.json(paths["counts"]).first().asDict()
    assert counts == {"records": 4, "frames": 12, "null_ids": 1, "null_flags": 3, "crashes": 4}
    rows = spark.read.option("header", True).csv(paths["sequence_level_data"]).collect()
    assert {r.sequence_id: r.crash_count for r in rows} == {"1": "3", "2": "0", None: "1"}
    assert {r.sequence_id: r.f_0 for r in spark.read.parquet(paths["crash_heatmap"]).collect()} == {1: 1, 2: 0, None: 1}
    with pytest.raises(ValueError, match="more than once"):
        J.analyse_crash_records(spark, records, f"{tmp_path}/b", n_frames=3, unique_ids=True)
    assert not (tmp_path / "b").exists()


def test_clean_weather_and_model_jobs(spark):
    out = tempfile.mkdtemp(prefix="fw-j2-") + "/clean"
    TB.cleaning_input(spark, SF001).createOrReplaceTempView("crash_records_csv")
    J.clean_job(spark, "crash_records_csv", out)
    assert spark.read.parquet(out).count() == 132
    counts = J.weather_report(spark, out).collect()
    assert sum(r["count"] for r in counts) == 132
    assert counts == sorted(counts, key=lambda r: -r["count"])
    model, acc = J.severity_job(B.severity_training_rows(TB.records(spark, SF001)), num_trees=10)
    row = acc.collect()[0]
    assert 0.0 <= row.accuracy <= 1.0 and row.n_test > 0


def test_resize_and_profile_jobs(spark):
    """Manifest of .jpg keys over .jpg, .png and mixed objects; objects under new keys; damaged ones aside."""
    videos = spark.createDataFrame([(1,)], "video long")
    for exts in (["jpg"] * 4, ["png"] * 4, ["jpg", "png", "jpeg", "png"]):
        src, root = tempfile.mkdtemp(prefix="fw-j5-"), tempfile.mkdtemp(prefix="fw-j5o-")
        rng = np.random.default_rng(3)
        images = {j: rng.integers(0, 256, (20, 30, 3), np.uint8) for j in (1, 2, 4)}
        for (j, rgb), ext in zip(images.items(), exts):
            with open(os.path.join(src, f"C_000001_{j:02d}.{ext}"), "wb") as f:
                f.write(SI.encode_png(rgb))
        with open(os.path.join(src, f"C_000001_05.{exts[3]}"), "wb") as f:
            f.write(b"broken")
        out = J.resize_job(spark, src, root, videos, frames_per_video=5)
        read = SI.image_rows(SI.decode_images(spark, out["objects"])).collect()
        assert {r.filename: bytes(r.data) for r in read} == {
            f"C_000001_{j:02d}.png": resize_array(rgb[:, :, ::-1], 128, 128).tobytes() for j, rgb in images.items()}
        bad = spark.read.parquet(out["bad"]).collect()
        assert [(r.filename, r.reason) for r in bad] == [(f"C_000001_05.{exts[3]}", "undecodable")]
        assert [r.filename for r in spark.read.parquet(out["missing"]).collect()] == ["C_000001_03.jpg"]
    table = f"{root}/table"
    J.ingest_job(spark, src, table)
    J.ingest_job(spark, src, table)
    profile, count = J.profile_images(spark, table)
    assert count.collect()[0].documents == 4
    assert profile.where("height = -1").count() == 1


def test_resize_job_keeps_equal_names_of_two_folders_apart(spark, tmp_path):
    for folder, grey in (("a", 10), ("b", 200)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "C_000001_01.jpg").write_bytes(SI.encode_png(np.full((4, 4, 3), grey, np.uint8)))
    out = J.resize_job(spark, f"{tmp_path}/[ab]", f"{tmp_path}/out", spark.createDataFrame([(1,)], "video long"), 1)
    rows = SI.decode_images(spark, f"{out['objects']}/*").select("image.origin", "image.data").collect()
    assert {r.origin.split("/")[-2]: set(r.data) for r in rows} == {"a": {10}, "b": {200}}
    assert spark.read.parquet(out["missing"]).count() == 0


def test_objects_appear_only_when_the_write_commits(spark, tmp_path):
    from framewise.sources.image_objects import write_objects
    root, schema = str(tmp_path / "o"), "key string, content binary, spare int"
    write_objects(spark.createDataFrame([("a/1.bin", b"one", 0), ("2.bin", b"two", 0)], schema).repartition(2), root)
    keys = lambda: {str(p.relative_to(root)): p.read_bytes() for p in (tmp_path / "o").rglob("*") if p.is_file()}
    assert keys() == {"a/1.bin": b"one", "2.bin": b"two"}
    for bad in ("../x", "/x", "_x", "", None):
        rows = [(f"n{i}", b"new", 0) for i in range(20)] + [("2.bin", b"changed", 0), (bad, b"x", 0)]
        with pytest.raises(Exception, match="not a key"):
            write_objects(spark.createDataFrame(rows, schema).repartition(4), root)
        assert keys() == {"a/1.bin": b"one", "2.bin": b"two"}  # nothing under a final name, nothing staged
    write_objects(spark.createDataFrame([("2.bin", b"more", 0)], schema), root)
    assert keys() == {"a/1.bin": b"one", "2.bin": b"more"}
    write_objects(spark.createDataFrame([("3.bin", b"", 0)], schema), root, "overwrite")
    assert keys() == {"3.bin": b""}


def test_analysis_job_removes_its_intermediate_tables(spark):
    from framewise.session import ensure_checkpoint_dir, local_path
    root = os.path.join(local_path(ensure_checkpoint_dir(spark)), "framewise", "tables")

    def listing():
        return {(n, u) for n in ("records", "sequences", "frame_cube")
                for u in (os.listdir(os.path.join(root, n)) if os.path.isdir(os.path.join(root, n)) else [])}

    before = listing()
    J.analyse_crash_records(spark, TB.records(spark, SF001), tempfile.mkdtemp(prefix="fw-j1c-"))
    assert listing() == before


def test_frame_tables_are_compressed(spark, tmp_path):
    paths = J.analyse_crash_records(spark, TB.records(spark, SF001), f"{tmp_path}/j")
    for name in ("frames_json", "frame_level_data"):
        files = [f for f in os.listdir(paths[name]) if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
    assert spark.read.json(paths["frames_json"]).count() == 10000
    assert spark.read.option("header", True).csv(paths["frame_level_data"]).count() == 10000


def test_task_that_outlives_an_abort_stages_nothing(tmp_path):
    from types import SimpleNamespace
    from framewise.sources.image_objects import ImageObjectWriter
    writer = ImageObjectWriter(f"{tmp_path}/o", False)
    def rows():
        yield SimpleNamespace(key="a/1.bin", content=b"one")
        writer.abort([])
        yield SimpleNamespace(key="b/2.bin", content=b"two")
    with pytest.raises(OSError):
        writer.write(rows())
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]
