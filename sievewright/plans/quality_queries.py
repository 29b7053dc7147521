"""Data-quality queries: saved, unique and duplicate counts, completeness, diagnosis, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def q_corpus_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: first-wins identity dedup of documents, then label completeness per source and language.

    The identity is the SHA-256 of the text; the copy with the smallest doc_id is the
    first. ``min`` per identity aggregates map-side, so a text copied into a third of
    all rows still reaches the reducer as one row per map task, and only the narrow
    (identity, doc_id) pair is shuffled, never the text.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("identity"))
    firsts = docs.groupBy("identity").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(1).alias("is_first"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    labelled = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    first = F.col("is_first").isNotNull()
    return (
        docs.select("doc_id", "source", "lang").join(firsts, "doc_id", "left").join(labels, "doc_id", "left")
        .groupBy("source", "lang")
        .agg(
            F.count("*").alias("saved"),
            F.count(F.when(first, 1)).alias("uniq"),
            F.count(F.when(~first, 1)).alias("duplicates"),
            F.count(F.when(first & labelled, 1)).alias("labelled"),
        )
        .withColumn("completeness", F.bround(F.try_divide(F.col("labelled").cast("double"), F.col("uniq")), 6))
    )


QUERIES["q_corpus_quality"] = q_corpus_quality
ORACLE["q_corpus_quality"] = """
WITH d AS (
  SELECT doc_id, source, lang, min(doc_id) OVER (PARTITION BY sha256(text)) = doc_id AS is_first FROM documents)
SELECT source, lang, count(*) AS saved, count(*) FILTER (is_first) AS uniq,
       count(*) FILTER (NOT is_first) AS duplicates,
       count(*) FILTER (is_first AND quality IS NOT NULL AND toxic IS NOT NULL) AS labelled,
       round_even(count(*) FILTER (is_first AND quality IS NOT NULL AND toxic IS NOT NULL)::DOUBLE
                  / nullif(count(*) FILTER (is_first), 0), 6) AS completeness
FROM d LEFT JOIN labels USING (doc_id) GROUP BY source, lang
"""


from sievewright.functions import text  # noqa: E402
from sievewright.operators import quality  # noqa: E402


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_COUNTS = """
SELECT (SELECT count(*) FROM lineitem) AS saved, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS uniq, (SELECT count(*) FROM orders) AS discovered,
       (SELECT count(*) FROM lineitem) AS reported, 0::BIGINT AS failed, 0::BIGINT AS unfinished
"""
_CHECKS = f"""
WITH c AS ({_COUNTS})
SELECT *, saved - uniq AS duplicates, saved = discovered AS saved_equals_discovered, uniq = saved AS unique_equals_saved, reported = saved AS reported_equals_saved,
       failed = 0 AS no_failed_tasks, unfinished = 0 AS no_unfinished_tasks FROM c
"""


@query(_CHECKS)
def q_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = table(spark, sf_dir, "lineitem").select("l_orderkey")
    return quality.count_report(saved, "l_orderkey", table(spark, sf_dir, "orders").select("o_orderkey"), reported=saved)


@query(f"""
WITH c AS ({_CHECKS}), v AS (SELECT saved > 0 AND saved_equals_discovered AND unique_equals_saved AND reported_equals_saved AND no_failed_tasks AND no_unfinished_tasks AS valid FROM c)
SELECT attempt, valid, CASE WHEN valid THEN 'complete' WHEN attempt < 2 THEN 'diagnose_and_retry_workflow' ELSE 'pause_task_and_report' END AS action,
       'replan_categories_and_pagination,reset_unfinished_tasks' AS directives FROM v, (SELECT unnest([1, 2]) AS attempt)
""")
def q_recovery_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.valid(q_validation_counts(spark, sf_dir))
    codes = F.array_compact(F.array(
        F.when(~F.col("saved_equals_discovered"), F.lit("catalog_or_detail_count_mismatch")), F.when(~F.col("reported_equals_saved"), F.lit("reported_total_not_reached")),
        F.when(~F.col("unique_equals_saved"), F.lit("duplicate_products")),
    ))
    attempts = report.select("valid", codes.alias("codes"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    return attempts.select("attempt", "valid", quality.decision(F.col("valid"), F.col("attempt")).alias("action"), F.array_join(quality.directives(F.col("codes")), ",").alias("directives"))


@query("""
WITH j AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)), n AS (SELECT count(*) AS n FROM j),
f AS (SELECT 'lang' AS field, count(*) FILTER (coalesce(lang, '') <> '') AS k FROM j UNION ALL SELECT 'source', count(*) FILTER (coalesce(source, '') <> '') FROM j
      UNION ALL SELECT 'quality', count(quality) FROM j UNION ALL SELECT 'toxic', count(toxic) FROM j)
SELECT field, n, k AS n_present, round_even(k::DOUBLE / n, 6) AS completeness FROM f, n
""")
def q_field_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return quality.completeness(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["lang", "source", "quality", "toxic"])


_ISSUE_SQL = """CASE event_type WHEN 'error' THEN 'Connection timeout' WHEN 'view' THEN 'HTTP 429' WHEN 'click' THEN 'next cursor unchanged' WHEN 'signup' THEN 'Selector missing' ELSE 'other' END"""


@query(f"""
WITH t AS (SELECT user_id, lower({_ISSUE_SQL}) AS t FROM events),
c AS (SELECT user_id, CASE WHEN contains(t, '429') THEN 'rate_limited' WHEN contains(t, '403') OR contains(t, 'captcha') OR contains(t, 'challenge') THEN 'anti_bot_or_access_denied'
  WHEN contains(t, 'timeout') OR contains(t, 'connection') OR contains(t, 'network') THEN 'network_instability' WHEN contains(t, 'cursor') OR contains(t, 'pagination') THEN 'pagination_not_advancing'
  WHEN contains(t, 'selector') OR contains(t, 'parse') THEN 'page_structure_changed' ELSE 'task_failure' END AS code FROM t)
SELECT code, count(*) AS n_issues, count(DISTINCT user_id) AS n_tasks FROM c GROUP BY code
""")
def q_issue_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    message = F.when(e == "error", "Connection timeout").when(e == "view", "HTTP 429").when(e == "click", "next cursor unchanged").when(e == "signup", "Selector missing").otherwise("other")
    coded = table(spark, sf_dir, "events").select("user_id", quality.issue_code(message).alias("code"))
    return coded.groupBy("code").agg(F.count("*").alias("n_issues"), F.count_distinct("user_id").alias("n_tasks"))


@query("""
SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_ok, count(*) FILTER (o_orderstatus <> 'F') AS n_failed,
  CASE WHEN count(*) FILTER (o_orderstatus = 'F') > 0 AND count(*) FILTER (o_orderstatus <> 'F') = 0 THEN 'success' WHEN count(*) FILTER (o_orderstatus = 'F') > 0 THEN 'partial' ELSE 'failed' END AS status
FROM orders GROUP BY o_custkey
""")
def q_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("o_orderstatus") == "F"
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.when(ok, 1)).alias("n_ok"), F.count(F.when(~ok, 1)).alias("n_failed"))
    return counts.withColumn("status", quality.rolled_up_status(F.col("n_ok"), F.col("n_failed")))


@query("""
SELECT doc_id, regexp_replace(lower(source), '[^a-z0-9]', '', 'g') AS key_text, regexp_replace(upper(source), '[^A-Z0-9]', '', 'g') AS code,
       regexp_replace(upper(lang || ' - ' || source), '[\\s-]', '', 'g') AS loose, upper(trim(lang || ' ' || source)) AS ident FROM documents
""")
def q_string_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, both = F.col("source"), F.concat_ws(" - ", "lang", "source")
    return table(spark, sf_dir, "documents").select("doc_id", text.key_text(s).alias("key_text"), text.compact_code(s).alias("code"), text.compact_loose(both).alias("loose"), text.identity_text(F.concat(F.lit("  "), "lang", F.lit(" \t "), "source")).alias("ident"))


@query(r"""
WITH c AS (SELECT conv_id, turn, 'Query: ' || text || chr(10) || 'Fields: Price, 库存/price ship' AS t FROM conversations),
q AS (SELECT conv_id, turn, t, regexp_replace(regexp_extract(t, '(?i)(?:查询|query)\s*[:：]\s*([^\n。；;]+)', 1), '(?is)\s*(?:需要|fields?)\s*[:：].*$', '') AS q FROM c)
SELECT conv_id, turn, nullif(regexp_replace(q, '^[ ,，.。]+|[ ,，.。]+$', '', 'g'), '') AS query,
  CASE WHEN regexp_matches(regexp_extract(t, '(?i)(?:需要|fields?)\s*[:：]\s*([^\n。；;]+)', 1), 'Price, 库存/price ship') THEN 'price,stock' END AS fields FROM q
""")
def q_intent_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The turns ask for nothing, so each whole turn is made a request.
    t = F.concat(F.lit("Query: "), "text", F.lit("\nFields: Price, 库存/price ship"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.query_of(t).alias("query"), F.array_join(text.requested_fields(t), ",").alias("fields"))


@query("""
WITH s AS (SELECT p_brand, p_partkey, p_name, upper(regexp_replace(p_name, '[\\s-]', '', 'g')) AS x, upper(regexp_replace(p_brand, '[\\s-]', '', 'g')) AS y, 'BRAND#1' AS q FROM part),
r AS (SELECT *, greatest(CASE WHEN x = '' THEN 0 WHEN x = q THEN 100 WHEN contains(x, q) THEN 80 WHEN length(x) >= 5 AND contains(q, x) THEN 50 ELSE 0 END,
                         CASE WHEN y = '' THEN 0 WHEN y = q THEN 100 WHEN contains(y, q) THEN 80 WHEN length(y) >= 5 AND contains(q, y) THEN 50 ELSE 0 END) AS score FROM s)
SELECT p_brand, p_partkey, score, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) AS rank FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, p_partkey) <= 5
""")
def q_relevance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    score = text.relevance(F.lit("brand# 1"), F.col("p_name"), F.col("p_brand"))
    hits = table(spark, sf_dir, "part").select("p_brand", "p_partkey", score.alias("score")).where("score > 0")
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("score"), "p_partkey"))
    return hits.withColumn("rank", rank).where("rank <= 5")
