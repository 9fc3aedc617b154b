"""Access to the driver's parquet tables.

Scans are lazy; callers select only the columns they need so that Catalyst's
column pruning shows up as a narrow ``ReadSchema`` and filters reach the
parquet reader as ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


class Tables:
    """Small convenience wrapper: ``t = Tables(spark, sf); t.orders('o_orderkey')``.  A
    table that one wrapper reads twice is listed once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.scans = spark, sf_dir, {}

    def __getattr__(self, name: str):
        if name in TABLES:
            if name not in self.scans:
                self.scans[name] = table(self.spark, self.sf_dir, name)
            scan = self.scans[name]
            return lambda *cols: scan.select(*cols) if cols else scan
        raise AttributeError(name)


def balance(df: DataFrame, min_parts: int | None = None) -> DataFrame:
    """Spread heavy per-row work over the cluster when the input arrives in fewer
    partitions than there are cores (a file with one row group is one task).

    Decided at plan time from the scan's split count: on a large input with
    many splits this is a no-op (no extra shuffle); on a narrow one it adds a
    round-robin repartition so regex / parsing / Python work runs in parallel."""
    spark = df.sparkSession
    target = min_parts or spark.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
