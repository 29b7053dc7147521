"""Queries of catalog traversal, pagination, records and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.functions import html, records
from sievewright.operators import catalog
from sievewright.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
PAGE = 5


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a sequence of pages of PAGE, an empty page after the last."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    numbered = orders.withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    pages = numbered.groupBy(F.col("o_custkey").alias("category"), (F.floor((F.col("n") - 1) / PAGE) + 1).cast("long").alias("page_no")).agg(
        F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("signature")
    )
    totals = orders.groupBy(F.col("o_custkey").alias("category")).agg(F.count("*").alias("total_count"))
    ends = totals.select("category", (F.ceil(F.col("total_count") / PAGE) + 1).cast("long").alias("page_no"), F.lit(0).cast("long").alias("n_items"), F.lit(None).cast("string").alias("signature"))
    null = F.lit(None).cast("string")
    return pages.unionByName(ends).join(totals, "category").select("*", F.lit(PAGE).alias("page_size"), null.alias("next_cursor"), null.alias("next_url"))


PAGES_SQL = f"""
n AS (SELECT o_custkey AS category, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
t AS (SELECT category, count(*) AS total_count FROM n GROUP BY 1),
p AS (SELECT category, (n - 1) // {PAGE} + 1 AS page_no, count(*) AS n_items FROM n GROUP BY 1, 2
      UNION ALL SELECT category, ceil(total_count / {PAGE}.0)::BIGINT + 1, 0 FROM t),
r AS (SELECT category, page_no, n_items, sum(n_items) OVER w AS seen,
      CASE WHEN n_items = 0 THEN 'empty_product_list' WHEN n_items < {PAGE} THEN 'returned_count_less_than_page_size' END AS stop_reason
      FROM p WINDOW w AS (PARTITION BY category ORDER BY page_no))
"""


@query(f"""
WITH {PAGES_SQL}
SELECT r.category, page_no, n_items, seen::BIGINT AS seen, stop_reason, stop_reason IS NOT NULL AND seen < total_count AS anomaly FROM r JOIN t USING (category)
QUALIFY count(stop_reason) OVER (PARTITION BY r.category ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0
""")
def q_pagination_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = catalog.page_outcomes(order_pages(spark, sf_dir))
    return done.where("visited").select("category", "page_no", "n_items", "seen", "stop_reason", "anomaly")


@query("""
SELECT o_orderkey, greatest(ceil(o_totalprice / 1000), 1)::BIGINT AS pages, CASE WHEN try_cast(substr(o_orderpriority, 1, 1) AS BIGINT) >= 1 THEN try_cast(substr(o_orderpriority, 1, 1) AS BIGINT) ELSE 9 END AS priority,
       try_cast(substr(o_orderpriority, 3) AS BIGINT) AS bad FROM orders
""")
def q_page_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", catalog.page_count(F.col("o_totalprice"), F.lit(1000)).alias("pages"),
        catalog.positive_int(F.substring("o_orderpriority", 1, 1), 9).alias("priority"), F.substring("o_orderpriority", 3, 99).try_cast("bigint").alias("bad"),
    )


@query("""
WITH RECURSIVE t AS (SELECT 'r' || r_regionkey AS key, NULL AS parent, r_regionkey::BIGINT AS ordinal FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey FROM customer),
w AS (SELECT key, parent, 0 AS depth, [ordinal] AS path, [-ordinal] AS dfs FROM t WHERE parent IS NULL
  UNION ALL SELECT t.key, t.parent, depth + 1, list_append(path, ordinal), list_append(dfs, -ordinal) FROM w JOIN t ON t.parent = w.key)
SELECT key, parent, depth, array_to_string(path, '/') AS path, array_to_string(dfs, '/') AS dfs_path FROM w
""")
def q_tree_traversal(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("key"), F.lit(None).cast("string").alias("parent"), F.col("r_regionkey").cast("long").alias("ordinal")),
        table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), F.col("n_nationkey").cast("long")),
        table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"), "c_custkey"),
    ]
    orders = catalog.tree_orders(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "/")
    return orders.select("key", "parent", "depth", joined("path").alias("path"), joined("dfs_path").alias("dfs_path"))


@query(r"""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[^:]+://([^/?#:]*)', 1)) AS host FROM pages)
SELECT page_id, host, CASE WHEN host = 'example.net' OR ends_with(host, '.example.net') THEN 'net' WHEN host = 'example.com' OR ends_with(host, '.example.com') THEN 'com' ELSE '' END AS site_key,
  CASE WHEN host = 'example.net' OR ends_with(host, '.example.net') THEN 'shop' WHEN host = 'example.com' OR ends_with(host, '.example.com') THEN 'maker' ELSE 'unknown' END AS site_type FROM h
""")
def q_site_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("select * from values ('example.net', 0, 'net', 'shop'), ('example.com', 1, 'com', 'maker') as r(domain, ordinal, site_key, site_type)")
    return catalog.site_of(table(spark, sf_dir, "pages").select("page_id", "url"), "url", rules).select("page_id", "host", "site_key", "site_type")


@query("""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events
""")
def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = records.guarded(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", records.at_path(v, "$.k").try_cast("bigint").alias("k"), records.at_path(v, "$.missing").alias("missing"))


@query("""
WITH j AS (SELECT event_id, to_json({'b': {'props': props::JSON, 'type': event_type}, 'a': [event_id, user_id]}) AS t FROM events)
SELECT event_id, count(*) AS n_nodes, count(*) FILTER (type NOT IN ('OBJECT', 'ARRAY')) AS n_leaves FROM j, json_tree(t) GROUP BY event_id
""")
def q_json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.lit('{"b":{"props":'), "props", F.lit(',"type":"'), "event_type", F.lit('"},"a":['), "event_id", F.lit(","), "user_id", F.lit("]}"))
    nodes = table(spark, sf_dir, "events").select("event_id", records.ordered_nodes(t).alias("nodes"))
    return nodes.select("event_id", F.size("nodes").cast("long").alias("n_nodes"), F.size(F.filter("nodes", lambda n: ~n["kind"].isin("object", "array"))).cast("long").alias("n_leaves"))


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN user_id::VARCHAR ELSE event_id::VARCHAR END AS sku, event_type AS title, value::VARCHAR AS extra_value
FROM (SELECT event_id, event_type, user_id, round(value)::BIGINT AS value FROM events)
""")
def q_alias_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.map_filter(
        F.create_map(
            F.lit("Catalog-Number"), F.col("event_id").cast("string"), F.lit("SKU"), F.when(F.col("event_type") == "view", F.col("user_id").cast("string")),
            F.lit("product_name"), F.col("event_type"), F.lit("Odd Value"), F.round("value").cast("bigint").cast("string"),
        ),
        lambda k, v: v.isNotNull(),
    )
    normal = table(spark, sf_dir, "events").select("event_id", records.normal_keys(raw).alias("m"))
    m = F.col("m")
    return normal.select("event_id", records.aliased(m, "sku").alias("sku"), records.aliased(m, "title").alias("title"), F.try_element_at(records.unknown_fields(m), F.lit("oddvalue")).alias("extra_value"))


@query("""
SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS unknown, len(json_keys(props))::BIGINT AS n_unknown FROM events
""")
def q_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("name"), F.col("event_type")))
    left = F.map_keys(records.unknown_fields(records.normal_keys(m)))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.array_sort(left), ",").alias("unknown"), F.size(left).cast("long").alias("n_unknown"))


@query("""
WITH o AS (SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey) AS q, list(l_extendedprice ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem GROUP BY 1),
c AS (SELECT l_orderkey, q, p[1:greatest(len(p) - 1, 1)] AS p FROM o), i AS (SELECT l_orderkey, q, p, unnest(range(1, least(len(q), len(p)) + 1)) AS i FROM c)
SELECT l_orderkey, i::INTEGER - 1 AS tier, q[i] AS quantity, p[i] AS unit_price FROM i
""")
def q_price_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    rows = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))).alias("x"))
    prices = F.col("x.l_extendedprice")
    short = F.slice(prices, F.lit(1), F.greatest(F.size(prices) - 1, F.lit(1)))  # unequal sides
    tiers = records.price_tiers(F.col("x.l_quantity"), short, F.lit("USD"))
    return rows.select("l_orderkey", F.posexplode(tiers).alias("tier", "t")).select("l_orderkey", "tier", "t.quantity", "t.unit_price")


@query("""
SELECT date_trunc('hour', ts)::VARCHAR AS window_start, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2
""")
def q_event_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id")
    counts = events.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return counts.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", "users")


@query("""
SELECT kind, count(*) AS n FROM (
  SELECT CASE WHEN trim(html) = '' THEN 'empty' WHEN regexp_matches(html, '(?i)<script[^>]+id=["'']__NEXT_DATA__["'']') THEN 'next_ssr'
    WHEN regexp_matches(html, '(?i)<script[^>]+type=["'']application/ld\\+json["'']') THEN 'json_ld' ELSE 'static_html' END AS kind FROM pages
  UNION ALL SELECT unnest(['empty', 'anti_bot_challenge', 'anti_bot_challenge', 'json_api', 'next_ssr', 'json_ld', 'javascript_rendered'])) GROUP BY kind
""")
def q_page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        "  ", "<script>var _xvasu=1;var _xvpts=2;</script>", '<textarea id="renderData">{}</textarea><script>getRenderData()</script>', '{"a": 1}',
        '<script id="__NEXT_DATA__">{}</script>', '<script type="application/ld+json">{}</script>', "<script></script>" * 5 + "<p>few words</p>",
    ]
    made = spark.createDataFrame([(r,) for r in rows], "html string")
    pages = table(spark, sf_dir, "pages").select("html").unionAll(made)
    return html.with_kind(pages, "html").groupBy("kind").agg(F.count("*").alias("n"))


@query(r"""
SELECT page_id, len(regexp_extract_all(html, '(?i)<script\b'))::BIGINT AS n_scripts, len(regexp_extract_all(html, '(?i)<meta\b'))::BIGINT AS n_metas,
       len(regexp_extract_all(html, '(?i)<a\s'))::BIGINT AS n_anchors FROM pages
""")
def q_page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = html.scanned(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return scan.select("page_id", F.col("scan.n_scripts").cast("long").alias("n_scripts"), F.size("scan.metas").cast("long").alias("n_metas"), F.size("scan.anchors").cast("long").alias("n_anchors"))


@query(r"""
SELECT page_id, unnest(range(len(h))) AS ord, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1) AS h FROM pages)
""")
def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = html.scanned(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return scan.select("page_id", F.posexplode("scan.anchors").alias("ord", "a")).select("page_id", F.col("ord").cast("long").alias("ord"), "a.href")


@query(r"""
WITH n AS (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?is)<nav>(.*?)</nav>', 1), '(?is)<a href="[^"]*">[^<]*</a>') AS a FROM pages),
l AS (SELECT page_id, url, unnest(range(len(a))) AS ord, unnest(a) AS a FROM n),
p AS (SELECT page_id, ord, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_extract(a, '>([^<]*)<', 1)) AS name,
  lower(regexp_extract(url, '^([^:]+)://', 1)) || '://' || lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) AS site, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS q FROM l),
s AS (SELECT *, site || regexp_replace(href, '/+$', '') AS target, 1 + 2 * regexp_matches(lower(href), '/category|/categories|/catalog|/products')::INT + regexp_matches(lower(name), 'product|category|产品|分类|元器件')::INT AS score FROM p
  WHERE lower(name) NOT IN ('home', 'login', 'register', 'account', 'cart', 'contact', 'about') AND href <> '')
SELECT page_id, target, name, min(ord) AS ord, arg_min(round_even(least(0.95, 0.45 + 0.15 * score), 4), ord) AS confidence FROM s
WHERE target <> site || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END AND (name <> '' OR score >= 3) GROUP BY page_id, target, name
""")
def q_nav_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.navigation_categories(html.scanned(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "html"), "page_id", "url")
    return found.select("page_id", "target", "name", F.col("ord").cast("long").alias("ord"), "confidence")


@query(r"""
WITH h AS (SELECT page_id, html, regexp_extract(html, '(?is)<h1(\s[^>]*)?>', 0) AS h, regexp_extract(html, '(?is)<meta\s[^>]*property="og:title"[^>]*>', 0) AS m FROM pages),
r AS (SELECT page_id, [regexp_extract(h, '(?is)\scontent="([^"]*)"', 1), regexp_replace(regexp_extract(html, '(?is)<h1(\s[^>]*)?>(.*?)</h1>', 2), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'),
  regexp_extract(m, '(?is)\scontent="([^"]*)"', 1), regexp_extract(html, '(?is)<title>(.*?)</title>', 1)] AS found FROM h),
t AS (SELECT page_id, list_transform(found, lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))) AS t FROM r)
SELECT page_id, coalesce(nullif(t[1], ''), nullif(t[2], ''), nullif(t[3], ''), t[4]) AS title FROM t
""")
def q_page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = html.scanned(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return scan.select("page_id", F.when(F.col("html").isNotNull(), F.coalesce(html.detail_title(F.col("scan")), F.lit(""))).alias("title"))


@query(r"""
SELECT page_id, regexp_extract(html, '(?i)<meta charset="([^"]*)"', 1) AS charset, len(regexp_extract_all(html, '(?i)<meta\s'))::BIGINT AS n FROM pages
""")
def q_page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = html.scanned(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    charset = F.coalesce(F.get(F.filter("scan.metas", lambda m: m["name"] == "charset"), F.lit(0))["content"], F.lit(""))
    return scan.select("page_id", charset.alias("charset"), F.size("scan.metas").cast("long").alias("n"))
