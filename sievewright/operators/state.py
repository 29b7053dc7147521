"""State between runs: journals, resume, and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.identity import last_wins


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else the context's; one of our own only where neither is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='sievewright-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def kept_table(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compacted(journal: DataFrame, key: str, *order: Column) -> DataFrame:
    """Latest row per key of an append-only journal."""
    return last_wins(journal, [key], *order)


def pending(todo: DataFrame, done: DataFrame, key: str, retry_failed: bool = False, refresh: bool = False) -> DataFrame:
    """What is left to do: all on refresh, else what no journal row covers; failed rows again if asked."""
    if refresh:
        return todo
    finished = done.where("status <> 'failed'") if retry_failed else done
    return todo.join(finished.select(key).distinct(), key, "left_anti")


def completed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed non-empty lines of a text file of ids."""
    return spark.read.text(path).select(F.btrim("value").alias("id")).where("id <> ''").distinct()


def matching_checkpoint(states: DataFrame, fingerprint: str) -> tuple[DataFrame, bool]:
    """State rows of this plan's fingerprint, and whether there are any; others are not loaded."""
    mine = states.where(F.col("fingerprint") == fingerprint)
    return mine, not mine.isEmpty()


def handoff(failed: Column, anomaly: Column, attempts_left: Column) -> Column:
    """Where a run goes next: replan after a failure, validate after a count anomaly, else none."""
    return F.when(failed & (attempts_left > 0), "replan_required").when(failed, "paused").when(anomaly, "validation_required").otherwise("none")
