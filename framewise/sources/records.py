"""Record sources: any Spark data source with an explicit schema, catalog
tables and Parquet directories.

A document store (the original read a Mongo collection) is just another
``format`` name here: pass ``format="mongodb"`` plus its options when that
connector is on the classpath; Parquet, ORC, JSON and CSV are built in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from framewise.operators.frames import conform_flags
from framewise.schemas import N_FRAMES, crash_record_schema


def scan_records(spark: SparkSession, path: str | None = None, format: str = "parquet",
                 schema: T.StructType | None = None, options: dict | None = None,
                 n_frames: int = N_FRAMES, extra_fields: list[T.StructField] | None = None) -> DataFrame:
    """Read crash records with an explicit schema; flags become ints (bad text → null).

    Flags are read as strings for text formats so a malformed value cannot fail
    the scan; ``conform_flags`` applies ``try_cast`` at this boundary.
    """
    if schema is None:
        flag_type = T.StringType() if format in ("csv", "json", "text") else T.IntegerType()
        schema = crash_record_schema(n_frames, flag_type)
        for f in extra_fields or []:
            schema = schema.add(f)
    reader = spark.read.format(format).schema(schema).options(**(options or {}))
    df = reader.load(path) if path is not None else reader.load()
    return conform_flags(df, n_frames)


def scan_clean_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The cleaning job's Parquet output directory (all part files)."""
    return spark.read.parquet(path)
