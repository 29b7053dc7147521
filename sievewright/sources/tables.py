"""Parquet table access by directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; any file system Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
