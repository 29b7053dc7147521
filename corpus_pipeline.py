"""From raw documents to packed training batches: each stage reads what the one before it wrote.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontaminate, langid, minhash, packing, substrings
from sievewright.llm.staging import staged
from sievewright.sources.tables import table

#: Documents whose language is less certain than this go, as do those without a letter.
LEAST_LANGUAGE = 0.5
#: Percent of shared shingles from which documents are near duplicates. At 80 % a pair agrees in 51.2 of 64 coordinates, with a
#: standard deviation of 3.2; in fewer than 35 of them with a probability of 1.2 in a million.
NEAR, AGREEING = 80, 35


def boxed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns as one, ``row``, so that no name of an operator meets one of the table."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents with a language, learned from their own labels.

    Null and empty texts and texts without a letter have none and go. Rows are judged one by one, so
    repeats and ties stay or go alike; all columns stay as they are; an empty table stays empty.
    """
    model = langid.train(docs, F.lit(True))
    named = langid.predict(boxed(docs), model)
    return named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each group of near duplicates.

    Texts without words are like no other and stay; rows that share a doc_id count as one document and stay
    or go together; a row without a doc_id goes, for nothing can name it; all columns stay as they are.
    """
    kept = minhash.near_duplicates(docs, percent=NEAR, threshold=AGREEING).where("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 bytes and more that an earlier document has; documents of which nothing is left go.

    text and n_chars are those of what is left; the other columns stay as they are. Null texts come back empty; rows of one doc_id and
    rows without one remove nothing from each other.
    """
    cut = substrings.repeated_passages(boxed(docs), with_text=True, carry=["row"]).where("n_bytes = 0 or n_removed < n_bytes")
    columns = {"text": F.col("kept").alias("text"), "n_chars": F.length("kept").cast(dict(docs.dtypes).get("n_chars", "long")).alias("n_chars")}
    return cut.select([columns.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or an edited copy of one.

    Rows of one doc_id go together; null and empty texts and rows without a doc_id stay; all columns stay as they are.
    """
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Buckets and token-budget batches of what is left, a row for each row; null texts have no words."""
    return packing.pack(docs, packing.word_count(F.col("text")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: The stages learn, iterate and align, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
