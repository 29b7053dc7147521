"""Fixture tests of the page queries."""

import pyarrow as pa
from oracle import same
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from sievewright.functions import html
from sievewright.plans import catalog_queries

TITLES = {
    1: ('<title>T</title><h1 class="x"> Part  <b>X1</b>y<!-- > c -->z</h1><h1>second</h1>', "Part X1 y z"),
    2: ('<title>T</title><meta property="og:title" content="OG &lt;a&gt;"><meta property="og:title" content="2"><h1> </h1>', "OG <a>"),
    3: ('<title> T &amp; U</title><meta name="og:title" content="n">', "T & U"),
    4: ("<p>none</p>", ""), 5: ("", ""), 6: (None, None), 7: ('<h1 content="C">x</h1>', "C"),
}


def pages(spark, tmp_path, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    (part,) = (tmp_path / "pages.parquet").glob("*.parquet")
    part.rename(tmp_path / "one")
    for left in (tmp_path / "pages.parquet").iterdir():
        left.unlink()
    (tmp_path / "pages.parquet").rmdir()
    (tmp_path / "one").rename(tmp_path / "pages.parquet")
    return str(tmp_path)


def test_title_falls_back(spark, tmp_path):
    d = pages(spark, tmp_path, [(k, "https://a.b/", h) for k, (h, _) in TITLES.items()])
    assert {r["page_id"]: r["title"] for r in catalog_queries.q_page_title(spark, d).collect()} == {k: t for k, (_, t) in TITLES.items()}
    same(spark, catalog_queries.q_page_title, catalog_queries.ORACLE["q_page_title"], d)


def test_title_decodes_what_has_no_semicolon(spark, tmp_path):
    d = pages(spark, tmp_path, [(1, "https://a.b/", "<title>a &amp;&amp</title>")])
    assert catalog_queries.q_page_title(spark, d).first()["title"] == "a &&"


def test_scans_leave_in_slices(spark):
    n = 2 * html.SLICE + 3
    texts = [None if k % 7 == 0 else f'<title>{k}</title><a href="/{k}">x</a>' for k in range(n)]
    out = list(html._scan_slices(iter([pa.array(texts), pa.array([], pa.string())]), to_arrow_type(DataType.fromDDL(html.SCAN))))
    assert [len(x) for x in out] == [html.SLICE, html.SLICE, 3]
    want = [None if k % 7 == 0 else str(k) for k in range(n)]
    assert [x["title"] for a in out for x in a.to_pylist()] == want
    df = spark.createDataFrame(list(enumerate(texts)), "k int, html string").coalesce(1)
    got = html.scanned(df, "html").select("k", "scan.title", F.size("scan.anchors").alias("n")).collect()
    assert sorted(tuple(r) for r in got) == [(k, t, int(t is not None)) for k, t in enumerate(want)]


def test_a_page_is_scanned_once(spark, tmp_path):
    nav = '<nav><a href="/category/x">X</a><a href="/">Home</a></nav>'
    d = pages(spark, tmp_path, [(k, "https://a.b/p", nav if k % 3 else None) for k in range(html.SLICE + 5)])
    found = catalog_queries.q_nav_categories(spark, d)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [scan(") == 1
    assert sorted((r["page_id"], r["target"]) for r in found.collect()) == [(k, "https://a.b/category/x") for k in range(html.SLICE + 5) if k % 3]
