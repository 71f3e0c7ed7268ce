"""Sinks: Parquet / JSON / CSV writers and the one-row metrics export.

Small report tables (bounded by category counts) may be written as one file;
the frame-level tables keep their partitioning so every task writes its own
file -- a single-file write of 100 TB frame rows would funnel into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None, compression: str | None = None) -> str:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def sink_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    """JSON lines.  ``compression`` for tables of a row a frame, whose text is some ten times their data."""
    df.write.mode(mode).option("compression", compression).json(path)
    return path


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False, compression: str = "none") -> str:
    """CSV with header.  ``single_file`` only for small, bounded report tables; ``compression`` as in ``sink_json``."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("compression", compression).csv(path)
    return path


def serialisable_metrics(metrics: DataFrame) -> DataFrame:
    """Counts as they are, other numbers as doubles, plus a ``validation_timestamp`` string."""
    cols = []
    for f in metrics.schema.fields:
        if isinstance(f.dataType, T.FractionalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return metrics.select(*cols, F.current_timestamp().cast("string").alias("validation_timestamp"))


def metrics_export(metrics: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write the one-row metrics table as JSON (one row → one small file)."""
    serialisable_metrics(metrics).coalesce(1).write.mode(mode).json(path)
    return path


def run_writes(writes: dict, parallel: int = 8) -> dict:
    """Run independent write actions concurrently; returns ``name -> result``.

    ``writes`` maps a name to a zero-argument callable that performs one write.
    Spark schedules jobs submitted from several driver threads side by side,
    so many small output jobs share the executors instead of queueing one
    after another.  Any failure is re-raised after all writes finish.
    """
    from concurrent.futures import ThreadPoolExecutor

    if parallel <= 1:
        return {name: fn() for name, fn in writes.items()}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(fn) for name, fn in writes.items()}
    return {name: f.result() for name, f in futures.items()}
