"""Cleaning job: dedupe over all columns, drop rows with any null, project.

Order matters: dedupe and the null drop see *every* source column, and the
projection runs last, so it can re-create duplicates and a null in an unused
column still drops the row.  NaN counts as null in ``na.drop``; '' does not.

Scale: ``dropDuplicates`` is an aggregate keyed by all columns with map-side
combine, so a group of identical copies that is a third of the table is
collapsed inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from framewise.schemas import RECORD_ATTRS


def project_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.select(*(cols or RECORD_ATTRS))


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def clean_records(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """dropDuplicates() → na.drop() → select(cols)."""
    return project_columns(drop_nulls(drop_duplicates(df)), cols)
