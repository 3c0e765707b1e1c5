"""Table sources: parquet tables by name, and task spreading for text work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet table ``<base_dir>/<name>.parquet`` (filters and column
    selections applied later are pushed into the scan by Catalyst)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, waves: int = 1) -> DataFrame:
    """Give CPU-heavy row-local work (regex tokenising, n-gram building) at
    least one task per core.

    A big input already arrives in many splits and is returned untouched (no
    shuffle).  A table stored as a few large row groups would otherwise be
    tokenised by one or two tasks; it is redistributed round-robin (Spark
    sorts before a round-robin exchange, so a retried task gets the same rows).
    A split may hold no row group, so only several splits per core (``waves``)
    tell that all cores have work.
    """
    spark = df.sparkSession
    try:
        want = spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a Spark Connect session): leave as is
        return df
    if have >= want * waves:
        return df
    return df.repartition(want if have < want else want * waves)
