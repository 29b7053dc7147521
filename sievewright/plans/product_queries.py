"""Queries of site records, record merging, payload choice and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import records, text, urls
from sievewright.operators import products, quality
from sievewright.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")





@query("""
SELECT p_brand AS cate_id, p_partkey::VARCHAR AS sku, p_name AS title, coalesce(CASE WHEN p_size > 5 THEN p_size::BIGINT END, 0) AS stock,
  CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN '1:' || printf('%.2f', p_retailprice) ELSE '1:' || printf('%.2f', p_retailprice) || ',10:' || printf('%.2f', p_size * 0.5) END AS price,
  CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_type END AS manufacturer, 1::BIGINT AS moq, '' AS package, 'https://img.site/' || p_partkey AS image_url, 'http://site/' || p_partkey AS detail_url, '' AS description FROM part
""")
def q_ickey_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    prices = F.slice(F.array(F.col("p_retailprice"), size * F.lit(0.5)), F.lit(1), (size % 3).cast("int"))
    body = F.to_json(F.struct(
        key.alias("sku"), F.concat(F.lit(" "), "p_name", F.lit("\t")).alias("title"), F.when(size > 5, size).alias("stock"), F.array(F.lit(1), F.lit(10), F.lit(100)).alias("nums"),
        prices.alias("calc_sale_rmb_price"), F.when(size % 2 == 0, F.col("p_brand")).otherwise("").alias("pro_maf"), F.col("p_type").alias("std_mfr_name"),
        F.concat(F.lit("//img.site/"), key).alias("img_url"), F.concat(F.lit("http://site/"), key).alias("url"),
    ))
    found = products.ickey_products(parts(spark, sf_dir).select("p_brand", body.alias("body")), "body", "p_brand")
    money = F.transform("price", lambda t: F.format_string("%d:%.2f", t["num"], t["rmb"]))
    return found.withColumn("price", F.array_join(money, ","))


@query("""
SELECT n_name AS sku, 'In ' || r_name AS title, '' AS description, r_regionkey AS family_id, r_name AS family_name, 'c' AS category, 's' AS subcategory,
  'ACTIVE' AS status, n_nationkey::BIGINT AS status_id, n_name || ',' || n_nationkey AS opn_list, n_nationkey % 2 = 0 AS datasheet_pdf, false AS datasheet_html FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def q_ti_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    words = F.create_map(F.lit("en-US"), F.struct(F.concat(F.lit("In "), "r_name").alias("title")), F.lit("de-DE"), F.struct(F.lit("x").alias("title")))
    one = F.struct(
        F.col("n_name").alias("genericPartNumber"), words.alias("localization"), F.struct(F.lit("ACTIVE").alias("name"), F.col("n_nationkey").alias("id")).alias("productStatus"),
        F.array("n_name", F.col("n_nationkey").cast("string")).alias("opnList"), (F.col("n_nationkey") % 2 == 0).alias("datasheetPDF"),
    )
    pages = nations.groupBy(F.col("r_regionkey").alias("family_id"), F.col("r_name").alias("family_name")).agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("body"))
    found = products.ti_products(pages.withColumn("category", F.lit("c")).withColumn("subcategory", F.lit("s")), "body")
    return found.drop("rating", "functional_safety").withColumn("opn_list", F.array_join("opn_list", ","))


@query("""
SELECT p_brand AS catalog_id, CASE WHEN p_size % 2 = 0 THEN 'C' || p_partkey ELSE 'L' || p_partkey END AS sku, p_name AS title, p_type AS model, p_brand AS brand, p_partkey::VARCHAR AS product_id,
  p_size::BIGINT AS stock, 0::BIGINT AS valid_stock, p_size::BIGINT AS total_stock, CASE WHEN p_size % 5 = 0 THEN '7:1.50' ELSE '1:' || printf('%.2f', p_retailprice) || ',5:0.25' END AS price,
  p_size % 5 = 0 AS is_discount, 1::BIGINT AS moq, -1::BIGINT AS max_buy, 'Rail=5 V,Size=' || p_size AS attributes, 'https://datasheet.lcsc.com/d/' || p_partkey AS datasheet_url, 2 AS n_sheets,
  'https://i/' || p_partkey AS image_url, '' AS big_image_url, 'https://item.szlcsc.com/' || p_partkey || '.html' AS detail_url, 'type' AS description, 47 AS n_columns FROM part
""")
def q_szlcsc_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    tier = lambda n, name, price: F.struct(F.lit(n).alias("startPurchasedNumber"), price.alias(name))
    files = F.array(
        F.struct(F.lit("image").alias("fileType"), F.array(F.struct(F.lit("/no").alias("fileUrl"), F.lit("i").alias("fileName"))).alias("detailVOList")),
        F.struct(F.lit("pdf_property").alias("fileType"), F.array(F.struct(F.concat(F.lit("/d/"), key).alias("fileUrl"), F.lit("a").alias("fileName")), F.struct(F.lit("").alias("fileUrl"), F.lit("b").alias("fileName")),
                 F.struct(F.lit("https://x/y").alias("fileUrl"), F.lit("c").alias("fileName"))).alias("detailVOList")),
    )
    vo = F.struct(
        F.when(size % 2 == 0, F.concat(F.lit("C"), key)).otherwise("").alias("productCode"), F.concat(F.lit(" "), "p_name").alias("productName"), F.col("p_type").alias("productModel"),
        F.lit("").alias("productGradePlateName"), F.col("p_partkey").alias("productId"), F.lit("type").alias("productType"), size.alias("stockNumber"),
        F.array(F.struct(F.lit(1).alias("startPurchasedNumber"), F.col("p_retailprice").alias("productPrice"), F.lit(9.0).alias("thePrice")), F.struct(F.lit(5).alias("startPurchasedNumber"), F.lit(0.0).alias("productPrice"), F.lit(0.25).alias("thePrice"))).alias("productPriceList"),
        files.alias("fileTypeVOList"), F.concat(F.lit("//i/"), key).alias("breviaryImageUrl"),
    )
    body = F.to_json(F.struct(
        F.concat(F.lit("L"), key).alias("lightProductCode"), F.col("p_brand").alias("lightBrandName"), (size % 5 == 0).alias("isMultiDiscount"),
        F.when(size % 5 == 0, F.array(tier(7, "discountPrice", F.lit(1.5)))).alias("priceDiscount"),
        F.create_map(F.lit("Rail"), F.to_json(F.struct(F.lit("5 V").alias("paramValue"))), F.lit("Size"), size.cast("string")).alias("paramLinkedMap"), vo.alias("productVO"),
    ))
    found = products.szlcsc_products(parts(spark, sf_dir).select("p_brand", body.alias("body")), "body", "p_brand")
    n = len(found.columns)
    money = F.array_join(F.transform("price", lambda t: F.format_string("%d:%.2f", t["num"], t["rmb"])), ",")
    pairs = F.array_join(F.array_sort(F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    names = ["catalog_id", "sku", "title", "model", "brand", "product_id", "stock", "valid_stock", "total_stock", "is_discount", "moq", "max_buy", "datasheet_url", "image_url", "big_image_url", "detail_url", "description"]
    return found.select(*names, money.alias("price"), pairs.alias("attributes"), F.size("datasheet_list").alias("n_sheets"), F.lit(n).alias("n_columns"))


@query("""
WITH d AS (SELECT l_partkey, count(*) AS m, max(l_quantity) AS q FROM lineitem GROUP BY 1),
j AS (SELECT p_partkey, p_name, p_type, p_size, d.*, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 3 END AS n FROM part LEFT JOIN d ON p_partkey = l_partkey)
SELECT p_partkey AS sku, CASE WHEN m % 2 = 0 THEN 'detail' ELSE p_name END AS title, CASE WHEN p_size % 4 <> 0 THEN p_type WHEN l_partkey IS NULL THEN '' ELSE 'box' END AS package,
  CASE WHEN coalesce(m, 0) > n THEN m ELSE n END::INTEGER AS n_prices, CASE WHEN m <= n THEN m END::INTEGER AS n_detail_prices,
  CASE WHEN m % 3 = 0 THEN q WHEN p_size % 5 <> 0 THEN p_size::DOUBLE END AS stock_qty, CASE WHEN m % 3 <> 0 AND p_size % 5 = 0 THEN 'call' END AS stock_status,
  CASE WHEN m % 3 <> 0 AND p_size % 5 <> 0 THEN 'call' END AS stock_note FROM j
""")
def q_product_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    listed = parts(spark, sf_dir).select(
        F.col("p_partkey").alias("sku"), F.col("p_name").alias("title"), F.when(size % 4 == 0, "").otherwise(F.col("p_type")).alias("package"),
        F.array_repeat(F.lit(0.5), F.when(size % 2 == 0, 1).otherwise(3)).alias("price"), F.when(size % 5 != 0, size.cast("double")).alias("stock_qty"), F.lit("").alias("stock_status"),
    )
    m = F.count("*")
    details = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("sku")).agg(m.alias("m"), F.max("l_quantity").alias("q")).select(
        "sku", F.when(F.col("m") % 2 == 0, "detail").otherwise("").alias("title"), F.lit("box").alias("package"), F.array_repeat(F.lit(0.25), F.col("m").cast("int")).alias("price"),
        F.when(F.col("m") % 3 == 0, F.col("q")).alias("stock_qty"), F.when(F.col("m") % 3 != 0, "call").otherwise("").alias("stock_status"),
    )
    found = products.merged_records(listed, details)
    return found.select("sku", "title", "package", F.size("price").alias("n_prices"), F.when(F.col("detail_price").isNotNull(), F.size("detail_price")).alias("n_detail_prices"),
                        "stock_qty", F.nullif("stock_status", F.lit("")).alias("stock_status"), "stock_note")


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 102 WHEN p_size % 3 = 0 THEN 42 ELSE 3 END AS score,
  CASE WHEN p_size % 2 = 0 THEN 'seed' WHEN p_size % 3 = 0 THEN 'typed' ELSE 'first' END AS found FROM part
""")
def q_best_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    typed = F.when(size % 3 == 0, F.struct(F.lit("Product").alias("@type"), F.lit("typed").alias("name"), F.lit("m").alias("brand")))
    seed = F.when(size % 2 == 0, F.struct(F.lit("seed").alias("name"), F.concat(F.lit("sku-"), F.col("p_partkey").cast("string")).alias("SKU")))
    first = F.struct(F.lit("first").alias("name"), F.lit("b").alias("brand"), F.lit(1).alias("price"))
    body = F.to_json(F.struct(F.struct(F.lit(1).alias("other")).alias("meta"), F.array(first, F.struct(F.lit("later").alias("name"), F.lit("b").alias("brand"), F.lit(1).alias("price"))).alias("rows"), typed.alias("typed"), seed.alias("seed")))
    best = products.best_mapping(F.col("body"), F.concat(F.lit("SKU "), F.col("p_partkey").cast("string")), F.lit(""))
    return parts(spark, sf_dir).select("p_partkey", body.alias("body")).select("p_partkey", best.alias("b")).select("p_partkey", "b.score", F.get_json_object("b.text", "$.name").alias("found"))


@query("""
WITH o AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN l_orderkey % 4 = 0 THEN n WHEN l_orderkey % 4 = 1 THEN n ELSE 2 END::INTEGER AS n_items, CASE WHEN l_orderkey % 4 = 0 THEN 'items' WHEN l_orderkey % 4 = 1 THEN 'data' ELSE 'records' END AS found FROM o
""")
def q_product_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("int").alias("n"))
    k = F.col("l_orderkey") % 4
    plain = F.array_repeat(F.struct(F.lit("records").alias("from")), F.lit(2))
    body = F.to_json(F.struct(
        plain.alias("records"), F.struct(F.when(k == 0, F.array_repeat(F.struct(F.lit("items").alias("from"), F.lit(1).alias("Product-Id")), F.col("n"))).alias("items")).alias("inner"),
        F.when(k == 1, F.array_repeat(F.struct(F.lit("data").alias("from"), F.lit(1).alias("sku")), F.col("n"))).alias("data"),
    ))
    found = orders.select("l_orderkey", body.alias("body")).select("l_orderkey", products.product_list(F.col("body")).alias("items"))
    return found.select("l_orderkey", F.size("items").alias("n_items"), F.get_json_object(F.get("items", F.lit(0)), "$.from").alias("found"))


@query(r"""
SELECT p_partkey, regexp_full_match(p_name, '[A-Za-z0-9][A-Za-z0-9._/+\-]{4,}') AS is_part, regexp_extract(p_brand || ' ' || p_name, '\b([A-Za-z0-9][A-Za-z0-9._/+\-]{4,})\b', 1) AS first_part,
  p_size % 3 = 0 AS nothing, p_size % 2 = 0 AS like_list, p_size % 2 = 1 AS like_plan, p_size % 2 = 1 AS like_search FROM part
""")
def q_text_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    page = F.concat_ws(" ", "p_name", F.when(size % 3 == 0, F.lit("Sorry,  No\n Results.")).otherwise("here"))
    keys = F.when(size % 2 == 0, F.array(F.lit("Detail_URL"), F.lit("x"))).otherwise(F.array(F.lit("genericPartNumber"), F.lit("y")))
    return parts(spark, sf_dir).select(
        "p_partkey", text.looks_part_number(F.col("p_name")).alias("is_part"), text.first_part_number(F.concat_ws(" ", "p_brand", "p_name")).alias("first_part"), text.no_results(page).alias("nothing"),
        *[products.looks_like_product(keys, v).alias(f"like_{v}") for v in ("list", "plan", "search")],
    )


@query(r"""
SELECT page_id, regexp_matches(lower(regexp_extract(url, '^[^:]+://([^/?#:]*)', 1)), '(^|\.)example\.com$') AND regexp_full_match(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/en/\d+/?') AS is_catalog,
  'https://search.ickey.cn/?keyword=p+' || page_id || '%2A' AS search_url, url AS start_url, 'https:' || regexp_extract(url, '^[^:]+:(.*)$', 1) AS https_url FROM pages
""")
def q_catalog_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.is_catalog_url(u, "example.com", r"/en/\d+/?").alias("is_catalog"), F.get(urls.search_urls("ickey", F.concat(F.lit("p "), F.col("page_id").cast("string"), F.lit("*"))), F.lit(0)).alias("search_url"),
        urls.start_url(u).alias("start_url"), urls.https_of(F.regexp_replace(u, "^[^:]+:", "")).alias("https_url"),
    )


@query("""
SELECT doc_id, concat_ws(',', CASE WHEN coalesce(lang, '') = '' THEN 'model' END, CASE WHEN quality IS NULL THEN 'stock_availability' END, CASE WHEN toxic IS NULL THEN 'quoted_price' END, 'none_such') AS missing
FROM documents LEFT JOIN labels USING (doc_id)
""")
def q_missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("sku")).join(table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("stock"), F.col("toxic").alias("price")), "doc_id", "left")
    return df.select("doc_id", F.array_join(products.missing_target_fields(df, ["model", "stock_availability", "quoted_price", "none_such"]), ",").alias("missing"))


@query("""
WITH m AS (SELECT 'quality' AS field, doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL UNION ALL SELECT 'toxic', doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY doc_id) AS r FROM m)
SELECT field, count(*) AS n_missing, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (r <= 20) AS samples FROM r GROUP BY field
""")
def q_missing_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    found = quality.missing_samples(df, "doc_id", ["quality", "toxic"])
    return found.select("field", "n_missing", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


@query("""
WITH p AS (SELECT o_custkey AS category, o_orderkey AS page_no, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS n FROM orders),
i AS (SELECT *, count(*) FILTER (n > 0) OVER (PARTITION BY category ORDER BY page_no) AS island FROM p),
r AS (SELECT *, CASE WHEN n = 0 THEN count(*) FILTER (n = 0) OVER (PARTITION BY category, island ORDER BY page_no) ELSE 0 END AS in_a_row, row_number() OVER (PARTITION BY category ORDER BY page_no) AS k FROM i)
SELECT category, page_no, in_a_row, coalesce(count(*) FILTER (in_a_row >= 3) OVER (PARTITION BY category ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS visited,
  page_no + 1 AS next_page, k * 50 AS next_offset FROM r
""")
def q_failure_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("category"), F.col("o_orderkey").alias("page_no"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("n_items"))
    return products.advanced(products.failure_cut(pages, "category", "page_no", "n_items", 3), "category", "page_no", F.lit(50)).drop("n_items")


@query("""
WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS attempt, event_type AS signature FROM events), f AS (SELECT user_id, signature AS first FROM p WHERE attempt = 0)
SELECT user_id, min(attempt) AS attempt, arg_min(signature, attempt) AS signature FROM p JOIN f USING (user_id) WHERE attempt > 0 AND signature <> first AND signature <> '' GROUP BY user_id
""")
def q_probe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long") - 1
    return products.accepted_probes(table(spark, sf_dir, "events").select("user_id", number.alias("attempt"), F.col("event_type").alias("signature")), "user_id", "attempt", "signature")


@query("""
WITH s AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), d AS (SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal > 0)
SELECT sum(n)::BIGINT AS n_seeds, count(*) AS n_distinct, count(s_suppkey) AS n_completed, sum(n)::BIGINT - count(*) AS n_duplicates, count(*) - count(s_suppkey) AS n_left FROM s LEFT JOIN d ON l_suppkey = s_suppkey
""")
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return products.run_summary(table(spark, sf_dir, "lineitem").select("l_suppkey"), done, "l_suppkey")


@query("""
WITH d AS (SELECT l_partkey, max(l_shipmode) AS title FROM (SELECT l_partkey, l_returnflag AS l_shipmode FROM lineitem WHERE l_quantity > 45) GROUP BY 1)
SELECT p_partkey AS sku, CASE WHEN l_partkey IS NOT NULL THEN title WHEN p_size % 2 = 0 THEN p_type ELSE p_name END AS title, CASE WHEN l_partkey IS NOT NULL THEN 'd' ELSE p_brand END AS datasheet_url,
  CASE WHEN l_partkey IS NOT NULL THEN 'i' ELSE '' END AS image_url, CASE WHEN l_partkey IS NOT NULL THEN 'detail' ELSE 'list' END AS origin FROM part LEFT JOIN d ON p_partkey = l_partkey
""")
def q_detail_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = parts(spark, sf_dir).select(F.col("p_partkey").alias("sku"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("").alias("model"), F.col("p_name").alias("title"), F.col("p_brand").alias("datasheet_url"), F.lit("").alias("image_url"))
    read = table(spark, sf_dir, "lineitem").where("l_quantity > 45").groupBy(F.col("l_partkey").alias("sku")).agg(F.max("l_returnflag").alias("title")).select("sku", "title", F.lit("d").alias("datasheet_url"), F.lit("i").alias("image_url"))
    return products.detail_or_list(listed, read)


@query("""
WITH c AS (SELECT DISTINCT CASE event_type WHEN 'click' THEN 'pagination_not_advancing' WHEN 'view' THEN 'rate_limited' WHEN 'purchase' THEN 'page_structure_changed' ELSE 'task_failure' END AS code, user_id::VARCHAR AS task FROM events)
SELECT code, count(*) AS n, count(DISTINCT task) AS n_tasks FROM c GROUP BY code
UNION ALL SELECT 'catalog_or_detail_count_mismatch', 1, 1 WHERE (SELECT count(*) FROM lineitem) <> (SELECT count(*) FROM orders)
UNION ALL SELECT 'duplicate_products', 1, 1 WHERE (SELECT count(*) FROM lineitem) <> (SELECT count(DISTINCT l_orderkey) FROM lineitem) UNION ALL SELECT 'required_fields_incomplete', 1, 1
""")
def q_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    saved = table(spark, sf_dir, "lineitem").select("l_orderkey")
    report = quality.count_report(saved, "l_orderkey", table(spark, sf_dir, "orders").select("o_orderkey"), reported=saved).withColumn("n_incomplete", F.lit(7))
    e = F.col("event_type")
    message = F.when(e == "click", "分页").when(e == "view", "HTTP 429").when(e == "purchase", "解析").otherwise("odd")
    issues = table(spark, sf_dir, "events").select(F.concat(F.lit("t"), F.translate(F.col("user_id").cast("string"), "0123456789", "abcdefghij")).alias("task"), F.lit("").alias("url"), message.alias("message"))
    found = quality.diagnoses(report, issues)
    return found.groupBy("code").agg(F.count("*").alias("n"), F.count_distinct("task").alias("n_tasks"))


@query("""
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS first_k, event_type AS first_name, CASE WHEN user_id % 2 = 0 THEN NULL ELSE event_id END AS total FROM events
""")
def q_json_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.when(F.col("user_id") % 2 == 0, F.lit("true")).otherwise(F.col("event_id").cast("string"))
    body = F.concat(F.lit('{"z":{"Name":"'), "event_type", F.lit('"},"a":['), "props", F.lit(',{"k":-1,"name":"later","Total-Count":'), total, F.lit("}]}"))
    nodes = table(spark, sf_dir, "events").select("event_id", records.ordered_nodes(body).alias("n"))
    n = F.col("n")
    return nodes.select("event_id", records.first_value(n, ["k"]).try_cast("bigint").alias("first_k"), records.first_value(n, ["name"]).alias("first_name"), records.first_count(n, ["totalcount"]).alias("total"))


@query("""
SELECT r_regionkey, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n_nations, (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) AS n_customers FROM region
""")
def q_leaf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_list(F.struct("c_custkey")).alias("items"))
    nations = table(spark, sf_dir, "nation").join(customers, "n_nationkey", "left").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list(F.struct("n_nationkey", "items")).alias("sub"))
    return table(spark, sf_dir, "region").select("r_regionkey").join(nations, "r_regionkey", "left").select("r_regionkey", products.leaf_count(F.col("sub")).alias("n_nations"), products.leaf_count(F.col("sub"), "items").alias("n_customers"))
