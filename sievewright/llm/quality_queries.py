"""Queries of the quality classifier and the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decision_list, rule_ensemble
from sievewright.llm.common import remainder
from sievewright.sources.tables import table

ORACLE: dict[str, str] = {}


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the sparse rule ensemble, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("_id"), 3) != 1)
    return rule_ensemble.score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base test and learned verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.train(docs, table(spark, sf_dir, "labels"))
    return decision_list.quality_rules(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept"
    )


QUERIES = {"op9_rule_ensemble": op9_rule_ensemble, "op10_decision_list": op10_decision_list}
