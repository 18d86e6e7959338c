"""Driver tables (S4): one Parquet dataset per table under an ``sf_dir``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str,
          columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Read one table; naming ``columns`` up front keeps ``ReadSchema`` narrow
    even before the optimizer prunes."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores:
    a remedy for small local inputs, which changes partitions and never rows.

    A single unsplittable file (one Parquet row group) is read by one task,
    which then also runs all per-row CPU work (tokenising whole texts).
    Only in that case the rows are hash-partitioned on ``keys`` (round-robin
    without keys) over ``min_partitions`` (default: the default
    parallelism).  A large input already has more splits than cores and is
    returned unchanged, so at scale this adds no shuffle.  Meant for
    scans: the partition count is read from the planned RDD, which for a
    plan with exchanges would run them under AQE.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)
