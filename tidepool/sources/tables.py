"""Access to the provided parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def with_parallelism_floor(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A large input is many files and row groups and already scans in parallel, so
    this is a no-op there. A small table stored as one row group would otherwise
    run every narrow step (JSON parsing included) in a single task; a round-robin
    repartition of those few rows is cheap. Column pruning and filters still reach
    the scan below the repartition.
    """
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table; column pruning and filters reach the parquet scan."""
    return with_parallelism_floor(spark, spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))
