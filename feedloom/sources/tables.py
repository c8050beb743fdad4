"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A whole Parquet table; filters and column choices of later steps reach the scan."""
    return spark.read.parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that yields fewer tasks than the cluster has cores, by hash of a unique column.

    Meant for costly row work on a few unsplittable inputs, such as gzip feeds or a table of one row
    group. A large input has more tasks than cores and passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
