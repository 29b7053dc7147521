"""Fixture tests of the extractors and rules that the oracle tables cannot exercise."""

import json

import pytest
from pyspark.sql import functions as F

from sievewright.functions import html, records, text, urls
from sievewright.operators import catalog, identity, merge, quality, state
from sievewright.sources import files, sinks


def one(spark, row, schema, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def test_identity_priority(spark):
    rows = [(" abc-1 ", "9", "https://X.com/a"), (None, " p 9 ", "https://x.com/a"), (None, None, "HTTPS://X.com/a/?b=2&a=1#f"), (None, None, None)]
    df = spark.createDataFrame(rows, "sku string, pid string, url string")
    got = [r[0] for r in df.select(identity.seed_identity(F.col("sku"), F.col("pid"), F.col("url")).alias("k")).collect()]
    assert got[0] == "sku:ABC-1" and got[1] == "product_id:P 9" and got[2].startswith("url_sha256:") and got[3] is None
    same = one(spark, ("https://x.com/a?a=1&b=2",), "url string", identity.seed_identity(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("url")).alias("k"))
    assert same[0] == got[2]


def test_urls(spark):
    u = F.col("u")
    got = one(spark, ("HTTP://Shop.Example.com/a//?b=2&a=1&a=&page=1#x",), "u string", urls.canonical_product_url(u), urls.canonical_page_url(u), urls.set_query_parameter(u, "page", F.lit(3)), urls.query_map(u), urls.host_of(u), urls.start_url(F.lit("shop.example.com")), urls.start_url(F.lit("ftp://a.b")))
    assert got[0] == "http://shop.example.com/a?a=&a=1&b=2&page=1" and got[1] == "http://shop.example.com/a?b=2&a=1&a=&page=1"
    assert got[2].endswith("?b=2&a=1&a=&page=3#x") and got[3] == {"b": "2", "a": "", "page": "1"} and got[4] == "shop.example.com"
    assert got[5] == "https://shop.example.com" and got[6] is None
    row = one(spark, ("https://a.b/c/d", "../x?y=1"), "b string, l string", urls.joined(F.col("b"), F.col("l")), urls.search_url(F.lit("https://a.b/?q={query}"), F.lit("a b*~")), urls.category_id_of(F.lit("https://a.b/catalog/77.html")))
    assert tuple(row) == ("https://a.b/x?y=1", "https://a.b/?q=a+b%2A~", "77")
    assert one(spark, ("x",), "x string", urls.same_site(F.lit("https://a.b.c"), F.lit("https://b.c")), urls.bind_category(F.lit("https://a.b/l?cate_id=1&p=2"), F.lit("9")), urls.bind_template(F.lit("https://a.b/l?cate_id=0"), F.lit("https://a.b/l?cate_id=5")))[:] == (True, "https://a.b/l?cate_id=9&p=2", "https://a.b/l?cate_id=5")


def test_text(spark):
    got = one(spark, ("x",), "x string", text.alias_text(F.lit("ＡＢ c-1")), text.availability(F.lit("Out_Of_Stock")), text.availability_code(F.lit("https://schema.org/InStock")), text.cut_at(F.lit("part one_shop"), "_"), text.without_count(F.lit("Chips（991,616）")), text.slug_title(F.lit("data-converters")), text.relevance(F.lit("LM-358"), F.lit("lm358")), text.relevance(F.lit("- -"), F.lit("a")))
    assert tuple(got) == ("abc1", "out_of_stock", "in_stock", "part one", "Chips", "Data Converters", 100, 0)


def test_records_keep_document_order(spark):
    t = '{"b": {"total": "12", "x": [1, {"Total-Count": 7}]}, "a": {"total": true}}'
    n = records.ordered_nodes(F.col("t"))
    got = one(spark, (t,), "t string", records.first_value(n, ["total"]), records.first_count(n, ["totalcount"]), F.transform(n, lambda x: x["path"]))
    assert got[0] == "12" and got[1] == 7 and got[2][:4] == ["$", "$.b", "$.b.total", "$.b.x"]
    assert one(spark, ('{"n": true, "m": {"n": 3}}',), "t string", records.first_count(records.ordered_nodes(F.col("t")), ["n"]))[0] is None
    assert one(spark, ("[1,",), "t string", F.size(records.ordered_nodes(F.col("t"))))[0] == 0
    v = F.try_parse_json(F.lit('{"u": ["", "x"], "o": {"label": "L"}, "l": ["a", "b"]}'))
    got = one(spark, (1,), "i int", records.url_of(F.try_variant_get(v, "$.u", "variant")), records.text_of(F.try_variant_get(v, "$.o", "variant")), records.text_of(F.try_variant_get(v, "$.l", "variant")))
    assert tuple(got) == ("x", "L", "a, b")


PAGE = """<html><head><title>T &amp; U</title><meta property="og:title" content="OG"><meta name="description" content="D"></head><body>
<nav><a href="/category/chips">Chips</a><a href="/login">Login</a></nav><h1> Part  <b>X1</b></h1>
<table class="main"><tr><th>Maker：</th><td>Acme</td></tr><tr><td>Package</td><td>SOT</td><td>z</td></tr></table><dl><dt>Rail</dt><dd>5 V</dd></dl>
<div class="product-card" data-sku="S1"><a href="/p/1">Widget</a></div><div itemscope itemtype="https://schema.org/Product"><span itemprop="sku">M1</span><meta itemprop="mpn" content="MM"></div>
<a href="/d.pdf">sheet</a><a rel="next" href="?page=2">Next</a><script type="application/ld+json">{"@type": "Product", "sku": "J"}</script></body></html>"""


def test_html_scan(spark):
    df = html.with_kind(spark.createDataFrame([("https://a.b/x", PAGE)], "url string, html string"), "html")
    s = F.col("scan")
    got = df.select("kind", html.detail_title(s), s["title"], html.meta_content(s, "og:title"), html.table_attributes(s), html.product_cards(s), html.microdata(s, "Product", "sku"), html.microdata(s, "Product", "mpn"), html.first_pdf(s), html.next_link(s), html.json_scripts(s), html.planning_kind(F.col("html"))).first()
    assert got[0] == "json_ld" and got[1] == "Part X1" and got[2] == "T & U" and got[3] == "OG"
    assert {(r["name"], r["value"]) for r in got[4]} == {("Maker", "Acme"), ("Package", "SOT"), ("Rail", "5 V")}
    assert [(c["sku"], c["href"], c["title"]) for c in got[5]][0] == ("S1", "/p/1", "Widget")
    assert got[6] == "M1" and got[7] == "MM" and got[8] == "/d.pdf" and got[9] == "?page=2" and json.loads(got[10][0])["sku"] == "J" and got[11] == "static_html"
    nav = html.navigation_categories(df.withColumn("id", F.lit(1)), "id", "url").collect()
    assert [(r["name"], r["target"]) for r in nav] == [("Chips", "https://a.b/category/chips")]


def test_merges(spark):
    items = spark.createDataFrame([(1, "a", {"x": "1"}), (2, "b", None)], "k int, t string, m map<string,string>")
    details = spark.createDataFrame([(1, "", {"x": "2", "y": "3"}), (3, "c", None)], "k int, t string, m map<string,string>")
    got = {r["k"]: (r["t"], r["m"]) for r in merge.detail_wins(items, details, "k").collect()}
    assert got == {1: ("a", {"x": "2", "y": "3"}), 2: ("b", {})}
    full = {r["k"]: (r["t"], r["in_items"], r["in_details"]) for r in merge.outer_merge(items, details, "k").collect()}
    assert full == {1: ("a", True, True), 2: ("b", True, False), 3: ("c", False, True)}


def pages(rows):
    return [(1, n, k, size, total, sig, cur, None) for n, k, size, total, sig, cur in rows]


def test_pagination(spark):
    schema = "category int, page_no int, n_items long, page_size int, total_count long, signature string, next_cursor string, next_url string"
    run = lambda rows, mode: [(r["page_no"], r["stop_reason"], r["anomaly"]) for r in catalog.page_outcomes(spark.createDataFrame(pages(rows), schema), mode=mode).where("visited").orderBy("page_no").collect()]
    assert run([(1, 2, 2, 3, "a", None), (2, 1, 2, 3, "b", None), (3, 0, 2, 3, None, None)], "page") == [(1, None, False), (2, "returned_count_less_than_page_size", False)]
    assert run([(1, 2, 2, 5, "a", None), (2, 2, 2, 5, "a", None)], "page")[-1] == (2, "repeated_page_signature", True)
    assert run([(1, 1, None, 2, "a", "c1"), (2, 1, None, 2, "b", None)], "auto")[-1] == (2, "missing_next_cursor", False)
    assert run([(1, 1, None, 2, "a", "c1"), (2, 1, None, 2, "b", "c1")], "auto")[-1] == (2, "cursor_not_advancing", True)
    assert run([(1, 1, None, 2, "a", None)], "next_link")[-1] == (1, "next_link_or_control_absent", True)


def test_tree_and_sites(spark):
    tree = spark.createDataFrame([("r", None, 0), ("a", "r", 0), ("b", "r", 1)], "key string, parent string, ordinal int")
    out = catalog.tree_orders(tree)
    assert [r["key"] for r in out.orderBy("dfs_path").collect()] == ["r", "b", "a"]
    assert [r["key"] for r in out.orderBy("depth", "path").collect()] == ["r", "a", "b"]
    rules = spark.createDataFrame([("shop.com", 0, "shop", "store")], "domain string, ordinal int, site_key string, site_type string")
    got = catalog.site_of(spark.createDataFrame([("https://m.shop.com/x",), ("shop.com.evil.org",)], "u string"), "u", rules).collect()
    assert {r["u"]: r["site_type"] for r in got} == {"https://m.shop.com/x": "store", "shop.com.evil.org": "unknown"}


def test_quality_rules(spark):
    got = one(spark, ("HTTP 429 timeout",), "t string", quality.issue_code(F.col("t")), quality.http_failed(F.lit(404)), quality.retryable(F.lit(503)), quality.decision(F.lit(False), F.lit(2)), quality.directives(F.array(F.lit("rate_limited"))))
    assert tuple(got) == ("rate_limited", True, True, "pause_task_and_report", ["slow_down_and_resume"])
    empty = spark.createDataFrame([], "a string")
    assert quality.completeness(empty, ["a"]).first()["completeness"] == 0.0


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1", "site_key": "s"}\n\nnot json\n[1]\n{"k": "2", "site_key": "t"}\n')
    assert sorted(r["k"] for r in files.json_lines(spark, f"file://{tmp_path}/a.jsonl", "k string, site_key string").where("k is not null").collect()) == ["1", "2"]
    assert files.json_lines(spark, f"file://{tmp_path}/none.jsonl", "k string").count() == 0
    with pytest.raises(Exception, match="bad JSON line"):
        files.strict_json_lines(spark, f"file://{tmp_path}/a.jsonl", "k string, site_key string").collect()
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 3)], "k string, v int")
    assert sorted((r["k"], r["v"]) for r in state.compacted(df, "k", F.col("v")).collect()) == [("a", 2), ("b", 1)]
    assert sinks.publish(False, df, df, f"file://{tmp_path}/out") is False and not (tmp_path / "out").exists()
    assert sinks.publish(True, df, df, f"file://{tmp_path}/out") and (tmp_path / "out/products_final.json").exists()
    robots = "User-agent: *\nDisallow: /private # no\nSitemap: https://a.b/s.xml\n"
    got = one(spark, (robots,), "t string", files.robots_allowed(F.lit(200), F.col("t"), F.lit("https://a.b/private/x")), files.robots_allowed(F.lit(404), F.col("t"), F.lit("https://a.b/private/x")), files.robots_allowed(F.lit(500), F.col("t"), F.lit("https://a.b/y")), files.robots_sitemaps(F.col("t")))
    assert tuple(got) == (False, True, False, ["https://a.b/s.xml"])
    xml = "<urlset><url><loc>http://a.b/catalog/5.html</loc></url><url><loc>https://a.b/x</loc></url></urlset>"
    locs = files.sitemap_locations(spark.createDataFrame([(xml,)], "t string"), "t").collect()
    assert [(r["loc"], r["category_id"]) for r in locs] == [("https://a.b/catalog/5.html", "5"), ("https://a.b/x", None)]
    body = '{"success": true, "msg": "", "result": {"total": 2, "products": [{"sku": "A"}, {"sku": "B"}]}}'
    assert [tuple(r) for r in files.api_products(spark.createDataFrame([("c", body)], "cate string, body string"), "body", "sku string").collect()] == [("c", 2, "A"), ("c", 2, "B")]
    assert one(spark, (False, "csrf bad"), "s boolean, m string", files.api_failure(F.col("s"), F.col("m")))[0] == "token_expired"
