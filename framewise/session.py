"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (an
HDFS / object-store path every executor can reach).  Only when the setting is
absent -- local runs and tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain public Spark options.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Exchange reuse lets a scalar subquery share the shuffle of its parent.
    "spark.sql.exchange.reuse": "true",
    # Skip Python call-site capture on every Column call (it only decorates
    # error messages and costs several JVM round-trips per expression).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "framewise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if (master or "").startswith("local"):
        conf["spark.driver.memory"] = "8g"  # a cluster's own setting is left alone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return ship_package(spark)


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of every executor.

    The package's modules go out once per Spark context as a small zip through
    ``addPyFile``, so that pandas functions run on nodes where the package is
    neither installed nor on ``PYTHONPATH``.
    """
    sc = spark.sparkContext
    if not getattr(sc, "_framewise_shipped", False):
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="framewise-zip-")) / "framewise.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        sc._framewise_shipped = True
    return spark


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """``settings`` hold inside the block; streams that start in it take them along."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def at_once(*writes: Callable) -> None:
    """Run writes that do not concern each other at the same time; all end before an error of one is raised."""
    with ThreadPoolExecutor(len(writes)) as pool:
        done = [pool.submit(w) for w in writes]
    for d in done:
        d.result()


def checkpoint_root(spark: SparkSession) -> str | None:
    """The cluster's shared folder: ``spark.checkpoint.dir`` or the context's."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    return root or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder; a local one is made only for local masters without one."""
    root = checkpoint_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="framewise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder; unique per call unless told otherwise."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([root, "framewise", *leaf])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python helpers can open local paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def materialize(df, name: str, keep: list | None = None):
    """Cut lineage: write ``df`` as Parquet under the shared folder and read it back.

    Unlike ``Dataset.checkpoint()``, which computes an un-persisted input twice
    (once to count, once to write), this computes it once.  The table lives on
    the cluster's shared storage, so a lost executor re-reads it instead of
    recomputing the lineage.  The path is appended to ``keep`` (if given) so a
    ``scratch`` block can remove it afterwards.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "tables", name)
    df.write.mode("overwrite").parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds any file; errors of the file system are raised, not taken for "no"."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath)) and any(
        not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop FileSystem of its scheme."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables for one job: ``materialize(df, name, keep)`` inside
    the block; every table written that way is deleted when the block exits
    (after the job's own outputs have been written)."""
    paths: list[str] = []
    try:
        yield paths
    finally:
        for path in paths:
            try:
                delete_path(spark, path)
            except Exception:  # best effort: never mask the job's own error
                pass
