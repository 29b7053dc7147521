"""Results as files. Spark's committer makes a written folder appear whole or not at all."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def safe_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", name).strip("_") or "run"


def save_lines(df: DataFrame, path: str) -> None:
    """Overwrite as JSON lines, in as many files as there are tasks."""
    df.write.mode("overwrite").json(path)


def save_single(df: DataFrame, path: str) -> None:
    """Overwrite as one file, for small published results."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_lines(df: DataFrame, path: str, sequence: int) -> None:
    """Append to a journal; ingest_seq orders its batches for compaction."""
    df.withColumn("ingest_seq", F.lit(sequence).cast("long")).write.mode("append").json(path)


def save_report(parts: dict[str, DataFrame], root: str, name: str) -> str:
    """Write the named parts of one report under a safe folder name."""
    folder = f"{root.rstrip('/')}/{safe_name(name)}"
    for part, df in parts.items():
        save_lines(df, f"{folder}/{part}")
    return folder


def publish(valid: bool, categories: DataFrame, products: DataFrame, root: str) -> bool:
    """Write the published tables only if validation has passed."""
    if valid:
        save_single(categories, f"{root}/categories.json")
        save_lines(products, f"{root}/products_final.json")
    return valid
