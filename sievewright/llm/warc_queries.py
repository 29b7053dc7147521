"""Query of the WARC round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import warc
from sievewright.llm.staging import fresh_path, staged
from sievewright.sources.tables import table


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives, read them back and assemble the captures."""
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_records(spark, path, with_payload=False))
    page_id = F.try_element_at(F.map_from_entries("metadata.fields"), F.lit("page_id")).try_cast("bigint")
    known = F.coalesce(F.try_element_at(F.map_from_entries("metadata.fields"), F.lit("copy-of")), F.col("capture_id"))
    flat = staged(captures.select(known.alias("known"), page_id.alias("page_id"), "response.record_type", "response.payload_bytes", "response.payload_digest", F.col("response.refers_to").alias("refers"), "response.digest_ok"), "captures")
    first = flat.where("record_type = 'response'").select(F.col("known").alias("refers"), F.col("page_id").alias("refers_to")).distinct()
    revisits = flat.where("refers is not null").join(first, "refers", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return flat.where("refers is null").withColumn("refers_to", F.lit(None).cast("bigint")).select(columns).unionAll(revisits.select(columns))


QUERIES = {"op2_warc": op2_warc}
ORACLE = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
}
