"""Queries of language ID and toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import langid, neighbours
from sievewright.llm.common import remainder
from sievewright.sources.tables import table

ORACLE: dict[str, str] = {}


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, remainder(F.col("doc_id"), 5) != 0)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    index = neighbours.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("_id"), 4) != 2)
    return neighbours.score(docs, index).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        F.get("evidence", F.lit(0))["doc_id"].alias("nearest_doc_id"),
        F.get("evidence", F.lit(0))["similarity"].alias("nearest_similarity"),
    )


QUERIES = {"op4_langid": op4_langid, "op8_neighbours": op8_neighbours}
