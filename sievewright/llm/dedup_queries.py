"""Queries of the near-duplicate and repeated-passage operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievewright.llm import minhash, substrings
from sievewright.sources.tables import table

ORACLE = {
    "op1_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
s AS (SELECT doc_id, unnest(g) AS g FROM l), n AS (SELECT doc_id, len(g)::BIGINT AS n FROM l),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
k AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
two AS (SELECT x, y FROM k UNION SELECT y, x FROM k),
r AS (SELECT x AS d, y AS o FROM two UNION SELECT r.d, b.y FROM r JOIN two b ON r.o = b.x)
SELECT n.doc_id, n.n AS n_shingles, coalesce(least(min(o), n.doc_id), n.doc_id) AS component_id, coalesce(least(min(o), n.doc_id), n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN r ON r.d = n.doc_id GROUP BY n.doc_id, n.n
""",
    "op3_substrings": """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM h),
s AS (SELECT doc_id, i, h[2 * i + 1:2 * i + 2] AS byte, CASE WHEN 2 * i + 100 <= length(h) THEN h[2 * i + 1:2 * i + 100] END AS win FROM b),
m AS (SELECT doc_id, i, byte, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS dup FROM s),
c AS (SELECT doc_id, i, byte, max(dup::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS gone FROM m),
g AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS before FROM c),
a AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT before) AS n_spans,
      sha256(unhex(coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), ''))) AS kept_sha256 FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN a USING (doc_id)
""",
}


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at a similarity of 0.85 on five-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents covered by a 50-byte string of an earlier document."""
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash": op1_minhash, "op3_substrings": op3_substrings}
