"""Queries of identity, compaction, merging and set algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import urls
from sievewright.operators import identity, merge, state
from sievewright.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add



CANONICAL_SQL = """(lower(regexp_extract(url, '^([^:/?#]+)://', 1)) || '://' || lower(regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1))
  || CASE WHEN regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/'
          ELSE regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') END
  || CASE WHEN regexp_extract(url, '\\?([^#]*)', 1) = '' THEN ''
          ELSE '?' || {query} END)"""
_PAIRS_SQL = r"list_sort(list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> ''), lambda p: {'k': split_part(p, '=', 1), 'v': regexp_extract(p, '=(.*)$', 1)}))"
SORTED_SQL = CANONICAL_SQL.replace("{query}", f"array_to_string(list_transform({_PAIRS_SQL}, lambda p: p.k || '=' || p.v), '&')")
PLAIN_SQL = CANONICAL_SQL.format(query=r"regexp_extract(url, '\?([^#]*)', 1)")


@query(f"""
WITH k AS (SELECT page_id, url, 'url_sha256:' || sha256({SORTED_SQL}) AS dedup_key FROM pages)
SELECT dedup_key, min(page_id) AS page_id, arg_min(url, page_id) AS url, 'url_hash' AS dedup_method FROM k GROUP BY dedup_key
""")
def q_dedup_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    null = F.lit(None).cast("string")
    keyed = pages.withColumn("dedup_key", identity.seed_identity(null, null, F.col("url")))
    return identity.first_wins(keyed, ["dedup_key"], "page_id").withColumn("dedup_method", identity.identity_method(F.col("dedup_key")))


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return state.compacted(events, "user_id", F.col("ts"), F.col("event_id")).select("user_id", "event_id", "event_type", "value")


@query("""
SELECT source, lang, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1
""")
def q_most_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars")
    return identity.most_complete(docs, ["source", "lang"], F.col("n_chars"), F.col("doc_id"))


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events)
SELECT user_id, arg_min(event_type, (-length(event_type), ord)) AS event_type, arg_min(value, ord) FILTER (value IS NOT NULL) AS value,
       arg_max(props, ord) FILTER (props IS NOT NULL) AS props, count(*) AS n_rows
FROM o GROUP BY user_id
""")
def q_fold_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value", "props")
    return merge.fold_merge(events, "user_id", ["ts", "event_id"], {"event_type": "longest", "value": "first", "props": "last"})


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1)
SELECT o_orderkey, coalesce(nullif(l_returnflag, ''), o_orderstatus) AS status, o_totalprice, l_linenumber, l_quantity
FROM orders LEFT JOIN d ON o_orderkey = l_orderkey
""")
def q_detail_left_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", F.col("l_returnflag").alias("status"), "l_partkey", "l_suppkey", "l_extendedprice")
    last = identity.last_wins(lines, ["o_orderkey"], *[F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")])
    return merge.detail_wins(items, last.select("o_orderkey", "status", "l_linenumber", "l_quantity"), "o_orderkey")


@query("""
WITH a AS (SELECT doc_id, lang, n_chars FROM documents ), b AS (SELECT doc_id, quality, toxic FROM labels)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, lang, n_chars, quality, toxic, a.doc_id IS NOT NULL AS in_items, b.doc_id IS NOT NULL AS in_details
FROM a FULL JOIN b ON a.doc_id = b.doc_id
""")
def q_full_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return merge.outer_merge(items, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), "doc_id")


@query("""
WITH l AS (SELECT l_partkey, max(l_suppkey) AS suppkey, max(l_returnflag) AS flag FROM lineitem GROUP BY 1)
SELECT p_partkey, coalesce(nullif(s_name, ''), nullif(flag, ''), nullif(p_brand, '')) AS supplier, coalesce(nullif(p_name, ''), 'unknown_product') AS title
FROM part LEFT JOIN l ON p_partkey = l_partkey LEFT JOIN supplier ON suppkey = s_suppkey
""")
def q_layered_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_suppkey").alias("s_suppkey"), F.max("l_returnflag").alias("flag"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    joined = parts.join(lines, "p_partkey", "left").join(suppliers, "s_suppkey", "left")
    return joined.select(
        "p_partkey", merge.layered("string", F.nullif("p_brand", F.lit("")), F.col("flag"), F.col("s_name")).alias("supplier"),
        merge.layered("string", F.lit("unknown_product"), F.col("p_name")).alias("title"),
    )


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality <> 0)")
def q_resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, "failed").otherwise("ok").alias("status"))
    return state.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), done, "doc_id", retry_failed=True)


@query("SELECT c_custkey, c_mktsegment FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')")
def q_semi_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").join(done, "c_custkey", "left_semi")


@query("""
SELECT doc_id, 'both' AS side FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'pending' FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
""")
def q_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return a.intersect(b).withColumn("side", F.lit("both")).unionAll(a.subtract(b).withColumn("side", F.lit("pending")))


@query("""
WITH u AS (SELECT n_nationkey AS nationkey, 0 AS ord, 'nation' AS src FROM nation UNION ALL SELECT c_nationkey, 1, 'customer' FROM customer
           UNION ALL SELECT s_nationkey, 2, 'supplier' FROM supplier)
SELECT nationkey, min(ord) AS ord, arg_min(src, ord) AS first_source, count(*) AS n FROM u GROUP BY nationkey
""")
def q_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [("nation", "n_nationkey"), ("customer", "c_nationkey"), ("supplier", "s_nationkey")]
    union = None
    for k, (name, col) in enumerate(sides):
        side = table(spark, sf_dir, name).select(F.col(col).alias("nationkey"), F.lit(k).alias("ord"), F.lit(name).alias("src"))
        union = side if union is None else union.unionAll(side)
    return union.groupBy("nationkey").agg(F.min("ord").alias("ord"), F.min_by("src", "ord").alias("first_source"), F.count("*").alias("n"))


@query("""
SELECT l_orderkey, sha256(array_to_string(list_sort(list(DISTINCT l_partkey::VARCHAR)), chr(10))) AS signature, count(DISTINCT l_partkey) AS n_distinct FROM lineitem GROUP BY 1
""")
def q_set_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.set_signature(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), ["l_orderkey"], "l_partkey")


@query("""
WITH b AS (SELECT l_suppkey, l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1) // 10 AS batch FROM lineitem)
SELECT l_suppkey, batch, count(*) AS n, string_agg(l_orderkey::VARCHAR, ',' ORDER BY l_orderkey, l_linenumber) AS order_keys FROM b GROUP BY 1, 2
""")
def q_batch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    rows = identity.batch_numbers(lines, ["l_suppkey"], ["l_orderkey", "l_linenumber"], 10)
    keys = F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber")))
    return rows.groupBy("l_suppkey", "batch").agg(F.count("*").alias("n"), F.array_join(F.transform(keys, lambda k: k["l_orderkey"].cast("string")), ",").alias("order_keys"))


@query("""
SELECT p_brand, arg_max(p_partkey, (p_size, -p_partkey)) AS p_partkey, max(p_size) AS score FROM part GROUP BY p_brand
""")
def q_argmax_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.max_by("p_partkey", F.struct(F.col("p_size"), -F.col("p_partkey"))).alias("p_partkey"), F.max("p_size").alias("score"))


@query(f"SELECT page_id, {SORTED_SQL} AS product_url, {PLAIN_SQL} AS page_url FROM pages")
def q_canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_product_url(F.col("url")).alias("product_url"), urls.canonical_page_url(F.col("url")).alias("page_url"))


@query(r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '\?([^#]*)', 1) AS q, regexp_extract(url, '#(.*)$', 1) AS f, regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') AS base FROM pages)
SELECT page_id, base || '?' || CASE WHEN regexp_matches(q, '(^|&)page=') THEN regexp_replace(q, '(^|&)page=[^&]*', '\1page=2') WHEN q = '' THEN 'page=2' ELSE q || '&page=2' END
  || CASE WHEN contains(url, '#') THEN '#' || f ELSE '' END AS paged,
  regexp_matches(q, '(^|&)page(=|&|$)') AS has_page, regexp_matches(lower(q), '(^|&)[^=&]*(cursor|token)[^=&]*(=|&|$)') AS has_cursor FROM p
""")
def q_set_query_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.set_query_parameter(u, "page", F.lit(2)).alias("paged"), urls.has_parameter(u, "page").alias("has_page"), urls.has_cursor_parameter(u).alias("has_cursor"))


@query(r"""
SELECT page_id, regexp_extract(url, '^[^:]+://[^/?#]*/([a-z]{2})/', 1) AS lang, try_cast(nullif(regexp_extract(url, '^[^:]+://[^/?#]*/[a-z]{2}/(\d+)', 1), '') AS BIGINT) AS number,
       regexp_matches(lower(url), '/product/|/products/|/detail/|/item/') AS is_product, regexp_matches(lower(url), '\.html') AS is_html FROM pages
""")
def q_url_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = urls.part(F.col("url"), "PATH")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(path, "^/([a-z]{2})/", 1).alias("lang"), F.nullif(F.regexp_extract(path, r"^/[a-z]{2}/(\d+)", 1), F.lit("")).try_cast("bigint").alias("number"),
        urls.looks_like_product(F.col("url")).alias("is_product"), F.lower("url").contains(".html").alias("is_html"),
    )
