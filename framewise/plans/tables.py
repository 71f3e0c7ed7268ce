"""Lazy access to the driver's test tables and the derived crash-record tables.

Every helper returns a DataFrame plan; nothing is read until an action runs.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from framewise.operators import anomaly as A
from framewise.operators import frames as FR
from framewise.operators import metrics as M
from framewise.session import table_exists
from framewise.sources import bindings as B


def once(make):
    """``make(spark, sf_dir, ...)`` run once a session and input; for what several queries read and none changes.

    Tables that are gone meanwhile are made anew.
    """
    made: dict = {}

    def there(spark: SparkSession, value) -> bool:
        paths = value.values() if isinstance(value, dict) else value if isinstance(value, tuple) else [value]
        return all(table_exists(spark, p) for p in paths if isinstance(p, str))

    @functools.wraps(make)
    def get(spark: SparkSession, sf_dir: str, *args):
        key = (id(spark), sf_dir, *args)
        if key not in made or not there(spark, made[key][1]):
            made[key] = spark, make(spark, sf_dir, *args)  # the session is held, so that its id stays its own
        return made[key][1]
    return get


_READERS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table as a DataFrame; the reader (file listing and footer
    schema) is built once per session and path -- the tables are read-only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _READERS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READERS[key] = spark.read.parquet(path)
    return df


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.crash_records(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FR.to_frame_rows(records(spark, sf_dir))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-sequence stats, shuffle-free (one record = one sequence)."""
    return M.sequence_stats_from_records(records(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.flag_anomalies(sequences(spark, sf_dir))


def cleaning_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.cleaning_input(table(spark, sf_dir, "part"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.video_pixels(table(spark, sf_dir, "embeddings"))
