"""Queries of packing and benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontaminate, packing
from sievewright.sources.tables import table

ORACLE: dict[str, str] = {}


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets and batches of all documents by their number of words."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.word_count(F.col("text")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item or an edited copy of one."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_packing": op6_packing, "op7_decontaminate": op7_decontaminate}
