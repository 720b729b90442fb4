"""Driver table access.

Every read names its columns, so the Parquet scan's ReadSchema holds only what
the plan uses; filters applied afterwards reach the scan as PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer than two splits a core, dealt to all cores. A Parquet file is split by row
    groups, so a small table in one file is one task however wide the rows made from it get. A
    table of many splits keeps them and is not shuffled. The number dealt to grows with the splits,
    so a task's share stays small on few cores too."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(max(cores, 4 * splits)) if splits < 2 * cores else df
