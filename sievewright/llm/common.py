"""Sizing, folds and bounded samples that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UNKNOWN = 1 << 50


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the input's size, from file sizes; where it has none, the bytes of the texts are counted."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN:
        size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def hashed_order(doc_id: Column) -> Column:
    """A fixed pseudo-random order of rows that does not depend on partitioning."""
    return F.xxhash64(doc_id, F.lit(20817))


def sample_of(labels: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows first in hashed order: a bounded sample that is the same at any partitioning."""
    return labels.orderBy(hashed_order(F.col(key)), *[F.col(c) for c in labels.columns]).limit(most)
