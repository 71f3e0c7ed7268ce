"""Catalog tables laid out by key: buckets, sorted inside, with statistics.

Tables that are bucketed alike on a key meet bucket by bucket: joins, groupings
and distincts on the key read them without a shuffle.  Partition columns prune
whole folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table; tables that are to meet have the same number.
BUCKETS = 32


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int = BUCKETS, partition_by: list[str] | None = None,
                  path: str | None = None) -> str:
    """Write ``df`` as the catalog table ``table``, bucketed and sorted by ``key``; an existing one is replaced.

    Rows are dealt by the buckets' own hash first, so a bucket is one file (a
    bucket and partition value, if there are any).  A bucket is never split: a
    key that holds a large part of the rows belongs in a table without buckets.
    ``path`` puts the data outside the warehouse.
    """
    writer = (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, key).sortBy(key))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    spark = df.sparkSession
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS `{key}`")
    return table


def scan_catalog(spark: SparkSession, table: str, **where) -> DataFrame:
    """A catalog table or temp view by name; ``where`` gives column values (None: null), pruned if they are partitions."""
    df = spark.table(table)
    for column, value in where.items():
        df = df.where(F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
    return df


def statistics(spark: SparkSession, table: str) -> dict[str, str]:
    """Rows, bytes and buckets as the catalog knows them."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    return {r.col_name: r.data_type for r in rows if r.col_name in ("Statistics", "Num Buckets", "Bucket Columns", "Sort Columns")}
