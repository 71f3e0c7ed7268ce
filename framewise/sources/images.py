"""Image folders as Spark tables.

* ``scan_images`` / ``list_images``: the ``binaryFile`` source (path, length,
  modificationTime, content).  Listing never reads the bytes (column pruning).
* ``decode_images``: the ``image`` source.  Rows keep Spark's struct
  (origin, height, width, nChannels, mode, data) with BGR bytes; undecodable
  files come back with height -1 unless ``drop_invalid``.
* ``ingest_images``: folder -> image table: the files' bytes and the decoded
  pixels, two Parquet folders with one key, the full path.
* ``write_frame_images``: image rows as PNG objects (``image_objects``).

PNG encoding is a ~20-line zlib/struct helper; no imaging library is needed.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.functions.columns import basename
from framewise.session import at_once, session_settings, table_exists
from framewise.sources.image_objects import write_objects
from framewise.sources.keyed_log import KeyedLog


def encode_png(rgb: np.ndarray) -> bytes:
    """8-bit RGB (h, w, 3) array → PNG bytes."""
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    header = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def png_objects(images: DataFrame, key: str = "filename") -> DataFrame:
    """``key, content``: image rows (``height, width, nChannels, data``, BGR or grey) as PNG files.

    Rows whose ``corrupt`` column, if there is one, is true are cut short: damaged uploads for the dead-letter path.
    """
    @F.pandas_udf("binary")
    def encode(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series, broken: pd.Series) -> pd.Series:
        out = []
        for h, w, c, d, bad in zip(height, width, channels, data, broken):
            arr = np.frombuffer(d, np.uint8).reshape(h, w, c)
            png = encode_png(np.ascontiguousarray(np.repeat(arr, 3, axis=2) if c == 1 else arr[:, :, 2::-1]))
            out.append(png[: len(png) // 3] if bad else png)
        return pd.Series(out, dtype=object)

    broken = F.col("corrupt") if "corrupt" in images.columns else F.lit(False)
    return images.select(F.col(key).alias("key"), encode("height", "width", "nChannels", "data", broken).alias("content"))


def write_frame_images(images: DataFrame, out_dir: str) -> str:
    """Write image rows as PNG objects named by ``filename`` under ``out_dir``: all of them, or none if the write fails."""
    return write_objects(png_objects(images), out_dir)


def location(path) -> Column:
    """A file's full path in one spelling: sources differ in the slashes after the scheme."""
    return F.regexp_replace(path, r"^([a-z0-9+.-]+):/+", "$1:/")


def scan_images(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def list_images(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Object listing: path, size, modification time (bytes are not read)."""
    return (scan_images(spark, path, glob)
            .select("path", basename("path").alias("filename"), "length", "modificationTime"))


def decode_images(spark: SparkSession, path: str, drop_invalid: bool = False, glob: str = "*") -> DataFrame:
    return (spark.read.format("image").option("dropInvalid", drop_invalid)
            .option("pathGlobFilter", glob).load(path))


def image_rows(decoded: DataFrame, *more: Column) -> DataFrame:
    """Flatten the ``image`` struct: ``more``, filename, height, width, nChannels, mode, data."""
    return decoded.select(*more, basename(F.col("image.origin")).alias("filename"),
                          F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                          F.col("image.nChannels").alias("nChannels"), F.col("image.mode").alias("mode"),
                          F.col("image.data").alias("data"))


def _only(paths: list[str]) -> list[str]:
    """Paths for a reader, which would take ``* ? [ ] { }`` in a name for a pattern."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]


#: What a small file costs a scan besides its bytes. Spark's own 4 MB would make a task of a few images, and more tasks than a driver holds.
OPEN_COST = 16 << 10


def _many_files(spark: SparkSession) -> dict[str, str]:
    """Settings for folders of very many small files: full tasks, no listings kept, and single paths looked up by few tasks."""
    return {"spark.sql.files.openCostInBytes": str(OPEN_COST), "spark.sql.hive.manageFilesourcePartitions": "false",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def ingest_images(spark: SparkSession, src: str, table_path: str, glob: str = "*",
                  skip_existing: bool = False, images_per_file: int = 0) -> str:
    """Append a folder to an image table: ``pixels`` (decoded rows) and ``documents`` (file bytes), keyed by full path.

    ``documents``: path, filename, image, processed (null).  ``pixels``: path,
    filename, video, frame (null if the name holds none), height, width,
    nChannels, mode, data; an undecodable file has height -1.  Each part is a
    scan written as it comes: no shuffle and no join of bytes.  Every file is taken
    unless ``glob`` says otherwise; equal names in two folders are two
    documents.  With ``skip_existing`` the listing is first compared with the
    stored paths, part by part, and only new files are opened (a run that
    stopped between the parts is completed); a table that cannot be read is an
    error.  New files are taken in pieces of ``PIECE``, in the order of their names.
    ``images_per_file`` bounds the files of ``pixels``, and so a stream's
    batches; the scan's splits are put together until their images nearly fill a
    file, so that a file does not hold the few dozen images of one split.
    """
    with session_settings(spark, _many_files(spark)):
        return _ingest(spark, src, table_path, glob, skip_existing, images_per_file)


#: New files are taken in pieces of so many neighbours by name: the driver holds the file index of a piece, not of the folder,
#: and the frames of a video lie close together in the table.
PIECE = 1 << 14


def _listing(spark: SparkSession, src: str, glob: str) -> list[str] | None:
    """The files right under ``src`` (a folder or a pattern) by name; the listing comes as a few long texts.

    None where the readers' own listing is needed: no file matches, or folders hold folders with files, which may be partitions.
    """
    hadoop, scala = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jvm.scala
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = hadoop.fs.Path(src)
    fs, wanted = pattern.getFileSystem(conf), hadoop.fs.GlobFilter(glob)
    roots = fs.globStatus(pattern)
    if not roots or len(roots) > 1000:
        return None
    found: list[str] = []
    for root in roots:
        if not root.isDirectory():
            return None
        inside = root.getPath().toString()
        if fs.globStatus(hadoop.fs.Path(_only([inside])[0] + "/*/?*")):
            return None
        paths = scala.Predef.genericWrapArray(hadoop.fs.FileUtil.stat2Paths(fs.listStatus(root.getPath(), wanted)))
        for i in range(0, paths.length(), PIECE):
            found += paths.slice(i, i + PIECE).mkString("\0").split("\0")
    # What Spark's readers leave out, too.
    found = [p for p in found if not (n := p.rsplit("/", 1)[1]).startswith((".", "_")) and not n.endswith("._COPYING_")]
    bare = [p for p in found if "." not in p.rsplit("/", 1)[1]]  # empty folders, unless these are many
    if len(bare) > 1000:
        return None
    folders = {p for p in bare if fs.getFileStatus(hadoop.fs.Path(p)).isDirectory()}
    return sorted(p for p in found if p not in folders) or None


def _ingest(spark: SparkSession, src: str, table_path: str, glob: str, skip_existing: bool, images_per_file: int) -> str:
    from framewise.operators.images import parse_image_key

    found = _listing(spark, src, glob)

    def new(part: str) -> list[str] | None:
        """Paths that are not stored yet; None if no listed one is and the readers list them."""
        if not skip_existing or not table_exists(spark, f"{table_path}/{part}"):
            return found
        stored = spark.read.parquet(f"{table_path}/{part}").select("path", F.lit(True).alias("_stored")).distinct()
        listed = (list_images(spark, src, glob).select("path") if found is None
                  else spark.createDataFrame(spark.sparkContext.parallelize([(p,) for p in found]), "path string", verifySchema=False))
        marked = listed.select("path", location("path").alias("_path")).join(stored.withColumnRenamed("path", "_path"), "_path", "left")
        if found is None:
            n = marked.agg(F.count("_stored").alias("stored"), F.count(F.lit(1)).alias("listed")).first()
            if n.stored in (0, n.listed):
                return [] if n.stored else None
        return sorted(r.path for r in marked.where("_stored IS NULL").select("path").collect())

    def load(reader, paths: list[str] | None) -> DataFrame:
        return reader.option("pathGlobFilter", glob).load(src) if paths is None else reader.load(_only(paths))

    def pixels(paths: list[str] | None) -> None:
        decoded = load(spark.read.format("image").option("dropInvalid", False), paths)
        rows = image_rows(decoded, location("image.origin").alias("path"))
        rows = rows.select("path", "filename", *parse_image_key("filename"), *rows.columns[2:])
        splits = rows.rdd.getNumPartitions() if images_per_file else 0
        if splits > 1:
            each = -(-(list_images(spark, src, glob).count() if paths is None else len(paths)) // splits)  # images of a split
            rows = rows.coalesce(-(-splits // max(1, images_per_file // max(1, each))))
        rows.write.mode("append").option("maxRecordsPerFile", images_per_file).parquet(f"{table_path}/pixels")

    def documents(paths: list[str] | None) -> None:
        (load(spark.read.format("binaryFile"), paths)
         .select(location("path").alias("path"), basename("path").alias("filename"), F.col("content").alias("image"),
                 F.lit(None).cast("boolean").alias("processed"))
         .write.mode("append").parquet(f"{table_path}/documents"))

    def take(write) -> None:
        paths = new(write.__name__)
        for piece in [None] if paths is None else [paths[i: i + PIECE] for i in range(0, len(paths), PIECE)]:
            write(piece)

    at_once(lambda: take(pixels), lambda: take(documents))
    return table_path


def scan_image_table(spark: SparkSession, table_path: str) -> DataFrame:
    """``path, filename, has_payload, height, width, nChannels, mode, processed`` of every stored document.

    ``processed`` is true for documents that the feature job has marked, else as
    it was stored.  Neither bytes nor pixels cross the joins on the path; read
    ``documents`` or ``pixels`` for these.
    """
    docs = spark.read.parquet(f"{table_path}/documents").select(
        "path", "filename", F.col("image").isNotNull().alias("has_payload"), "processed")
    sizes = spark.read.parquet(f"{table_path}/pixels").select("path", "height", "width", "nChannels", "mode")
    out = docs.join(sizes, "path", "left")
    if not table_exists(spark, f"{table_path}/marks"):
        return out.select("path", "filename", "has_payload", "height", "width", "nChannels", "mode", "processed")
    marks = KeyedLog(spark, f"{table_path}/marks", "path").read().withColumnRenamed("processed", "_marked")
    return out.join(marks, "path", "left").select(
        "path", "filename", "has_payload", "height", "width", "nChannels", "mode",
        F.coalesce("_marked", "processed").alias("processed"))
