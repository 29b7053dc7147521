"""A catalog run from captured pages to published files, retry and pause, and search."""

import json

from pyspark.sql import functions as F

from sievewright.operators import projections
from sievewright.plans import jobs

LIST = json.dumps({"products": [{"SKU": "a-1", "Product Name": "One", "url": "/p/1", "odd": 1}, {"sku": "A-1", "title": "again"}, {"productId": 7, "href": "/p/7"}, {"title": "no identity"}]})
CARDS = '<div class="product-card" data-sku="C9"><a href="/p/9">Nine</a></div>'
DETAIL = '<h1>Title {n}</h1><table><tr><td>Manufacturer</td><td>Acme</td></tr></table><script type="application/ld+json">{{"@type":"Product","offers":{{"price":"1.25","inventoryLevel":{{"value":321}}}}}}</script>'


def captured(spark):
    pages = spark.createDataFrame([("https://a.b/list", LIST), ("https://a.b/cards", CARDS)], "url string, text string")
    details = spark.createDataFrame([(f"https://a.b/p/{n}", DETAIL.format(n=n), 200) for n in (1, 7, 9)], "url string, text string, status_code int")
    return pages, details


def test_run_publishes(spark, tmp_path):
    pages, details = captured(spark)
    out = jobs.guarded(lambda attempt: jobs.catalog_run(pages, details), spark.range(1), f"file://{tmp_path}/out")
    assert out.status == "published" and out.report["saved"] == 3
    rows = {r["dedup_key"]: r for r in spark.read.json(f"file://{tmp_path}/out/products_final.json").collect()}
    assert set(rows) == {"sku:A-1", "product_id:7", "sku:C9"}
    first = rows["sku:A-1"]
    assert (first["title"], first["manufacturer"], first["price"], first["stock"]) == ("Title 1", "Acme", "1.25", "321.0")


def test_run_retries_once_and_pauses(spark, tmp_path):
    pages, details = captured(spark)
    attempts = []
    out = jobs.guarded(lambda n: attempts.append(n) or jobs.catalog_run(pages, details.where("url not like '%/7'")), spark.range(1), f"file://{tmp_path}/out")
    assert attempts == [1, 2] and out.status == "paused" and not out.report["no_failed_tasks"] and not (tmp_path / "out").exists()


def test_search_ranks_and_merges(spark):
    rows = [("s", "LM358", "", "", "u1", 0), ("s", "lm-358", "", "", "u2", 1), ("s", "", "", "an LM358 kit", "u3", 2), ("s", "XX", "", "", "u4", 3)]
    got = jobs.search(spark.createDataFrame(rows, "site string, model string, sku string, title string, detail_url string, ord int"), "lm 358").collect()
    assert [(r["ord"], r["score"]) for r in got] == [(0, 100), (1, 100), (2, 80)]


def test_projections(spark):
    df = spark.createDataFrame([("A", None, "https://a.b/x", {"X": "1"}, "https://a.b/list")], "sku string, product_id string, detail_url string, request_headers map<string,string>, source_url string")
    r = projections.detail_request(df, "https://api/{sku}?p={product_id}", {"X": "0", "Y": "2"}).first()
    assert r["request_url"] == "https://api/A?p=" and r["request_headers"] == {"X": "1", "Y": "2", "Referer": "https://a.b/list"}
    t = projections.tolerant(spark.createDataFrame([("5", "x")], "cate_id string, n string"), {"category_id": ("bigint", ["cate_id"]), "n": ("int", []), "none": ("string", [])}).first()
    assert tuple(t) == (5, None, None)
    p = spark.sql("select array(named_struct('name','Vin','attr','max','values',array('5','6')), named_struct('name','Q','attr','','values',array('1'))) as p").select(projections.parameter_map(F.col("p"))).first()[0]
    assert p == {"Vin_max": "5, 6", "Q": "1"}
    assert projections.products_from_seeds(df.withColumn("title", F.lit(""))).first()["title"] == "A"
    assert spark.range(1).select(projections.reported_total(F.lit("共 1,234 条"))).first()[0] == 1234
