"""Query of language-model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import suffix_tree
from sievewright.sources.tables import table

ORACLE: dict[str, str] = {}


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the suffix tree, and by the add-one unigram base."""
    return suffix_tree.score(table(spark, sf_dir, "documents"))


QUERIES = {"op5_suffix_tree": op5_suffix_tree}
