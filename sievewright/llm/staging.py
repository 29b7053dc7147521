"""Intermediate tables in the folder that all executors share.

A written table cuts lineage and survives a lost executor, for Spark's committer
leaves only whole files of finished tasks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else the context's checkpoint directory, else (tests only) one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='sievewright-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sievewright-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
