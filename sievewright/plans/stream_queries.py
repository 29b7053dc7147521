"""Streams run to their end, whose results equal those of the batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.state import kept_table, shared_folder
from sievewright.plans.catalog_queries import PAGES_SQL, order_pages
from sievewright.sources.tables import table
from sievewright.streaming import streams

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def stream_of(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A file stream over a written table."""
    import uuid

    path = f"{shared_folder(spark)}/source-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    return stream_of(spark, events, "events")


@query("SELECT DISTINCT user_id, event_type FROM events")
def s_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = events_stream(spark, sf_dir).select("user_id", "event_type")
    return streams.to_table(streams.deduplicated(stream, ["user_id", "event_type"]), "dedup")


@query("SELECT event_id, event_type, round_even(value, 4) AS value FROM events")
def s_append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = events_stream(spark, sf_dir).select("event_id", "event_type", F.bround("value", 4).alias("value"))
    return streams.to_table(stream, "append")


@query(f"""
WITH {PAGES_SQL}
SELECT r.category, page_no, n_items, seen::BIGINT AS seen, stop_reason, stop_reason IS NOT NULL AND seen < total_count AS anomaly FROM r JOIN t USING (category)
QUALIFY count(stop_reason) OVER (PARTITION BY r.category ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0
""")
def s_pagination_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = kept_table(order_pages(spark, sf_dir).select("category", "page_no", "n_items", "page_size", "total_count", "signature"))
    return streams.to_table(streams.paginated(stream_of(spark, pages, "pages")), "pages")
