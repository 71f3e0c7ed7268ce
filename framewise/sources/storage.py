"""Files that Python tasks open themselves: one spelling of paths, pyarrow file systems."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme it has for Spark: a path without one lies on the cluster's default file system."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(hpath).toString()


def arrow_store(uri: str):
    """(pyarrow file system, path in it) of a URI; Hadoop's spellings ``file:/x`` and ``s3a://`` are understood."""
    from pyarrow import fs as pafs
    if re.match(r"(file:)?/", uri):
        return pafs.LocalFileSystem(), re.sub(r"^(file:)?/+", "/", uri)
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))
