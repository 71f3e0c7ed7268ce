"""Image files written with zlib/struct PNGs; Spark decodes them."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from framewise.operators import features as FT
from framewise.operators import images as IM
from framewise.operators.resize import resize_array
from framewise.sources import images as SI


def _write(dirname, name, rgb):
    with open(os.path.join(dirname, name), "wb") as f:
        f.write(SI.encode_png(rgb))


def test_png_roundtrip_and_dead_letter(spark):
    d = tempfile.mkdtemp(prefix="fw-img-")
    img = np.zeros((4, 5, 3), np.uint8)
    img[1, 2] = [10, 20, 30]
    _write(d, "C_000001_01.png", img)
    with open(os.path.join(d, "C_000001_02.png"), "wb") as f:
        f.write(b"corrupt")
    decoded = SI.decode_images(spark, d)
    good, bad = IM.split_decoded(decoded)
    row = SI.image_rows(good).collect()[0]
    assert (row.height, row.width, row.nChannels, row.mode) == (4, 5, 3, 16)
    px = np.frombuffer(row.data, np.uint8).reshape(4, 5, 3)
    assert list(px[1, 2]) == [30, 20, 10]  # BGR
    assert [r.filename for r in bad.collect()] == ["C_000001_02.png"]
    listing = SI.list_images(spark, d)
    assert listing.count() == 2 and "content" not in listing.columns


def test_ingest_twice_adds_nothing(spark):
    d = tempfile.mkdtemp(prefix="fw-ing-")
    for j in range(1, 4):
        _write(d, f"C_000001_{j:02d}.png", np.full((3, 3, 3), j, np.uint8))
    table = tempfile.mkdtemp(prefix="fw-tab-") + "/t"
    SI.ingest_images(spark, d, table)
    SI.ingest_images(spark, d, table, skip_existing=True)
    assert SI.scan_image_table(spark, table).count() == 3


def test_resize_constant_is_constant():
    img = np.full((40, 70, 3), 77, np.uint8)
    out = resize_array(img, 128, 128)
    assert out.shape == (128, 128, 3) and (out == 77).all()


def test_block_greys():
    rng = np.random.default_rng(1)
    bgr = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    grey = np.array([[int(0.114 * b + 0.587 * g + 0.299 * r + 0.5) for b, g, r in row] for row in bgr.astype(float)])
    assert (FT.block_greys(bgr.tobytes(), 5, 7, 3, 1).reshape(5, 7) == grey).all()
    blocks = [int(grey[y:y + 3, x:x + 3].sum()) // grey[y:y + 3, x:x + 3].size for y in (0, 3) for x in (0, 3, 6)]
    assert FT.block_greys(bgr.tobytes(), 5, 7, 3, 3).tolist() == blocks
    assert FT.block_greys(bgr[..., 0].tobytes(), 5, 7, 1, 1).tolist() == bgr[..., 0].ravel().tolist()


def test_features_on_scenes(spark, tmp_path):
    for video in (1, 2):
        for t in range(1, 13):
            img = np.full((32, 32, 3), 100, np.uint8)
            if video == 2 and t >= 8:
                img[8:24, 8:24] = 230
            _write(tmp_path, f"C_{video:06d}_{t:02d}.png", img)
    rows = SI.image_rows(SI.decode_images(spark, str(tmp_path)))
    frames = rows.select(*IM.parse_image_key("filename"), "*")
    for block in (1, 4):
        found = {(r.video, r.frame): r.traffic_density for r in FT.frame_features(frames, block).collect()}
        assert len(found) == 24 and found[(2, 8)] == 0.25
        assert all(d == 0 for (video, frame), d in found.items() if video == 1 or frame < 8)


def test_missing_images_against_manifest(spark):
    videos = spark.createDataFrame([(1,), (2,)], "video long")
    expected = IM.image_manifest(videos, 3)
    stored = spark.createDataFrame([("C_000001_01.jpg",), ("C_000002_03.jpg",)], "filename string")
    missing = sorted(r.filename for r in IM.missing_images(expected, stored).collect())
    assert missing == ["C_000001_02.jpg", "C_000001_03.jpg", "C_000002_01.jpg", "C_000002_02.jpg"]


def test_basename_and_defaults(spark):
    df = spark.createDataFrame([("a/b/c.jpg", None), ("x.jpg", b"1")], "path string, image binary")
    out = IM.field_defaults(IM.with_basename(df).withColumn("filename", F.lit(None).cast("string")))
    rows = out.collect()
    assert [r.filename for r in rows] == ["unknown", "unknown"]
    assert [r.has_payload for r in rows] == [False, True]
    assert [r.filename for r in IM.with_basename(df).collect()] == ["c.jpg", "x.jpg"]


def test_ingest_takes_every_file_once_under_its_full_path(spark, tmp_path):
    import numpy as np
    from framewise.sources.images import encode_png, ingest_images
    for folder, shade in (("a", 10), ("b", 200)):
        (tmp_path / folder).mkdir()
        for name in ("C_000001_01.jpg", "thumb.png"):
            (tmp_path / folder / name).write_bytes(encode_png(np.full((4 + shade % 7, 5, 3), shade, np.uint8)))
    for _ in range(2):  # a second run adds nothing
        ingest_images(spark, f"{tmp_path}/[ab]", f"{tmp_path}/table", skip_existing=True)
    rows = SI.scan_image_table(spark, f"{tmp_path}/table").collect()
    assert len(rows) == 4 and len({r.path for r in rows}) == 4
    assert all(r.height == 4 + (10 if "/a/" in r.path else 200) % 7 for r in rows)


def test_ingest_fills_its_files(spark, tmp_path):
    """Scan splits of few images are put together; new files of a folder that is stored in part are added alone."""
    import numpy as np
    from framewise.sources.images import encode_png, ingest_images, scan_image_table
    (tmp_path / "a").mkdir()
    for i in range(1, 73):
        (tmp_path / "a" / f"C_000001_{i:02d}.png").write_bytes(encode_png(np.full((2, 2, 3), i, np.uint8)))
    table = f"{tmp_path}/t"
    ingest_images(spark, f"{tmp_path}/a", table, skip_existing=True, images_per_file=36)
    assert len(list((tmp_path / "t" / "pixels").glob("*.parquet"))) <= 4
    (tmp_path / "a" / "C_000001_73.png").write_bytes(encode_png(np.full((2, 2, 3), 73, np.uint8)))
    for _ in range(2):
        ingest_images(spark, f"{tmp_path}/a", table, skip_existing=True, images_per_file=36)
        rows = scan_image_table(spark, table).select("filename").collect()
        assert len(rows) == 73 == len({r.filename for r in rows})


def test_ingest_takes_a_folder_in_pieces(spark, tmp_path, monkeypatch):
    """No read takes more files than a piece holds, neighbours come together, and every file comes once."""
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        for j in range(1, 8):
            _write(tmp_path / folder, f"C_000001_{j:02d}.{'jpg' if j % 3 else 'png'}", np.full((3, 3, 3), j, np.uint8))
    for name in ("_part.png", ".hidden.png", "x._COPYING_"):
        (tmp_path / "a" / name).write_bytes(b"no image")
    pieces, only = [], SI._only
    monkeypatch.setattr(SI, "PIECE", 4)
    monkeypatch.setattr(SI, "_only", lambda paths: pieces.append([p.rsplit("/", 2)[1:] for p in paths]) or only(paths))
    before, table, src = spark.conf.get("spark.sql.files.openCostInBytes"), f"{tmp_path}/t", f"{tmp_path}/[ab]"
    SI.ingest_images(spark, src, table, "*.png", skip_existing=True, images_per_file=2)
    for _ in range(2):
        SI.ingest_images(spark, src, table, skip_existing=True, images_per_file=2)
    taken = [p for p in pieces if p[0] not in (["t", "a"], ["t", "b"]) and "." in p[0][1]]
    assert max(map(len, taken)) == 4 and len(taken) == 2 * (1 + 3)
    assert all(p == sorted(p) for p in taken)
    for part in ("pixels", "documents"):
        rows = spark.read.parquet(f"{table}/{part}")
        assert rows.count() == rows.select("path").distinct().count() == 14
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_listing_leaves_folders_of_folders_to_the_readers(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert SI._listing(spark, f"{tmp_path}", "*") is None
    _write(tmp_path, "b.png", np.zeros((2, 2, 3), np.uint8))
    _write(tmp_path, "a b.png", np.zeros((2, 2, 3), np.uint8))
    assert [p.rsplit("/", 1)[1] for p in SI._listing(spark, f"{tmp_path}", "*.png")] == ["a b.png", "b.png"]
    (tmp_path / "day=1").mkdir()
    _write(tmp_path / "day=1", "c.png", np.zeros((2, 2, 3), np.uint8))
    assert SI._listing(spark, f"{tmp_path}", "*") is None
    SI.ingest_images(spark, f"{tmp_path}", f"{tmp_path}/../{tmp_path.name}-t")
    assert spark.read.parquet(f"{tmp_path}/../{tmp_path.name}-t/documents").count() == SI.list_images(spark, f"{tmp_path}").count()


def test_a_task_takes_many_small_files(spark, tmp_path):
    """A small file costs a scan little, so a folder is read by a task for some thousand small files, not for each few."""
    for j in range(120):
        _write(tmp_path, f"C_000001_{j:03d}.png", np.zeros((2, 2, 3), np.uint8))
    cores = spark.sparkContext.defaultParallelism
    with SI.session_settings(spark, {"spark.sql.files.maxPartitionBytes": "4m"}):
        SI.ingest_images(spark, str(tmp_path), f"{tmp_path}-t")
    assert len(spark.read.parquet(f"{tmp_path}-t/documents").inputFiles()) <= 2 * cores
