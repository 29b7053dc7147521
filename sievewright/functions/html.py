"""HTML by one Arrow UDF: a page is tokenised once, and every extractor reads the scan.

The UDF is pure Python's html.parser, for Spark has no HTML tokeniser; all that follows
it (classification, JSON-LD, links, tables, cards) is Column expressions on the scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from sievewright.functions.text import stripped
from sievewright.functions.urls import canonical_page_url, joined, part, same_site

SCAN = (
    "struct<title:string,h1:string,og_title:string,text_chars:int,n_scripts:int,n_products:int,"
    "anchors:array<struct<href:string,text:string,rel:string,css:string,in_nav:boolean,disabled:boolean>>,"
    "metas:array<struct<name:string,content:string>>,scripts:array<struct<id:string,type:string,body:string>>,"
    "cells:array<struct<row:int,table:string,cells:array<string>,href:string>>,pairs:array<struct<name:string,value:string>>,"
    "cards:array<struct<sku:string,product_id:string,href:string,title:string>>,props:array<struct<scope:int,item:string,prop:string,value:string>>,"
    "images:array<string>>"
)
#: Pages whose scans are held at once.
SLICE = 256
# Navigation words that are no categories, words that end a page sequence, and marks of script-built pages.
UTILITY = ["home", "首页", "login", "登录", "register", "注册", "account", "账户", "cart", "购物车", "contact", "联系我们", "about", "关于我们"]
NEXT_WORDS = ["next", "next page", "下一页", "下页", "›", "»"]
CATEGORY_PATHS = ["/category", "/categories", "/catalog", "/products"]
CATEGORY_WORDS = ["product", "category", "产品", "分类", "元器件"]
SCRIPT_MARKS = ["__nuxt", "ng-version", "data-reactroot", "atomic-result-list", 'id="root"', 'id="app"']
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CARD_WORDS = ("product-card", "product-item", "goods-item", "product_card")


class _Scan(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out = {"title": None, "h1": None, "og_title": None, "n_scripts": 0, "n_products": 0, "anchors": [], "metas": [], "scripts": [], "cells": [], "pairs": [], "cards": [], "props": [], "images": []}
        self.chars, self.nav, self.stack = 0, 0, []
        self.open: dict[str, list] = {}
        self.anchor = self.script = self.row = self.cell = self.term = self.definition = self.named = None
        self.card: list = []
        self.scopes: list = []
        self.tables: list = []

    def _css(self, tag, a):
        if a.get("id"):
            return f"{tag}#{a['id']}"
        classes = (a.get("class") or "").split()
        return f"{tag}.{'.'.join(classes)}" if classes else f'{tag}[rel="{a["rel"]}"]' if a.get("rel") else tag

    def _gap(self):
        """Texts of a heading's parts stand apart."""
        if self.open.get("h1") and self.out["h1"] is not None:
            self.out["h1"] += " "

    def handle_comment(self, data):
        self._gap()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        self._gap()
        if tag not in VOID:
            self.stack.append(tag)
        if tag in ("nav", "header"):
            self.nav += 1
        if tag == "script":
            self.out["n_scripts"] += 1
            self.script = {"id": a.get("id", ""), "type": a.get("type", ""), "body": ""}
            self.out["scripts"].append(self.script)
        elif tag == "meta":
            name = a.get("property") or a.get("name") or ("charset" if "charset" in a else "")
            self.out["metas"].append({"name": name, "content": a.get("content", a.get("charset", ""))})
            if a.get("property") == "og:title" and self.out["og_title"] is None:
                self.out["og_title"] = a.get("content", "")
        elif tag in ("a", "button"):
            known = {"href": a.get("href", ""), "text": "", "rel": a.get("rel", ""), "css": self._css(tag, a), "in_nav": self.nav > 0, "disabled": "disabled" in a or a.get("aria-disabled") == "true"}
            if tag == "a" or known["css"] != "button":
                self.anchor = known
                if tag == "a":
                    self.out["anchors"].append(known)
        elif tag == "img" and a.get("src"):
            self.out["images"].append(a["src"])
        elif tag == "table":
            self.tables.append(" ".join((a.get("class") or "").split()))
        elif tag == "tr":
            self.row = {"row": len(self.out["cells"]), "table": self.tables[-1] if self.tables else "", "cells": [], "href": None}
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []
        elif tag == "dt":
            self.term, self.definition = [], None
        elif tag == "dd":
            self.definition = []
        if a.get("data-attribute-name"):
            self.named = [tag, a["data-attribute-name"], []]
        if a.get("href") and self.row is not None and self.row["href"] is None:
            self.row["href"] = a["href"]
        if a.get("data-sku") or a.get("data-product-id") or a.get("itemtype", "").rstrip("/").endswith("/Product") or any(w in (a.get("class") or "") for w in CARD_WORDS):
            self.out["n_products"] += 1
            card = {"sku": a.get("data-sku", ""), "product_id": a.get("data-product-id", ""), "href": a.get("href", ""), "title": ""}
            self.out["cards"].append(card)
            self.card.append((len(self.stack), card))
        elif self.card and a.get("href") and not self.card[-1][1]["href"]:
            self.card[-1][1]["href"] = a["href"]
        if "itemscope" in a or a.get("itemtype"):
            self.scopes.append((len(self.stack), len(self.scopes), a.get("itemtype", "").rstrip("/").rsplit("/", 1)[-1]))
        if a.get("itemprop") and self.scopes:
            value = a.get("content") or a.get("href") or a.get("src") or a.get("value")
            prop = {"scope": self.scopes[-1][1], "item": self.scopes[-1][2], "prop": a["itemprop"], "value": value or ""}
            self.out["props"].append(prop)
            if value is None and tag not in VOID:
                self.open.setdefault(tag, []).append((len(self.stack), prop))
        if tag in ("title", "h1") and self.out[tag] is None:
            self.out[tag] = a.get("content", "")
            if not self.out[tag]:
                self.open.setdefault(tag, []).append((len(self.stack), tag))

    def handle_endtag(self, tag):
        self._gap()
        if tag not in self.stack:
            return
        while self.stack:
            top = self.stack.pop()
            self._close(top)
            if top == tag:
                break

    def _close(self, tag):
        depth = len(self.stack) + 1
        if tag in ("nav", "header"):
            self.nav = max(0, self.nav - 1)
        if tag == "script":
            self.script = None
        if tag in ("a", "button"):
            self.anchor = None
        if tag in ("td", "th") and self.cell is not None and self.row is not None:
            self.row["cells"].append(" ".join("".join(self.cell).split()))
            self.cell = None
        if tag == "tr" and self.row is not None:
            if self.row["cells"]:
                self.out["cells"].append(self.row)
            self.row = None
        if tag == "table" and self.tables:
            self.tables.pop()
        if tag == "dd" and self.term is not None and self.definition is not None:
            self.out["pairs"].append({"name": " ".join("".join(self.term).split()), "value": " ".join("".join(self.definition).split())})
            self.definition = None
        if self.named and self.named[0] == tag:
            self.out["pairs"].append({"name": self.named[1], "value": " ".join("".join(self.named[2]).split())})
            self.named = None
        while self.card and self.card[-1][0] >= depth:
            self.card.pop()
        while self.scopes and self.scopes[-1][0] >= depth:
            self.scopes.pop()
        if self.open.get(tag) and self.open[tag][-1][0] >= depth:
            self.open[tag].pop()

    def handle_data(self, data):
        if self.script is not None:
            self.script["body"] += data
            return
        if self.stack and self.stack[-1] == "style":
            return
        self.chars += len(" ".join(data.split()))
        if self.anchor is not None:
            self.anchor["text"] += data
        if self.cell is not None:
            self.cell.append(data)
        if self.definition is not None:
            self.definition.append(data)
        elif self.term is not None and self.stack and self.stack[-1] == "dt":
            self.term.append(data)
        if self.named:
            self.named[2].append(data)
        if self.card:
            self.card[-1][1]["title"] += data
        for held in self.open.values():
            for _, what in held:
                if isinstance(what, str):
                    self.out[what] += data
                else:
                    what["value"] += data

    def finish(self):
        while self.stack:
            self._close(self.stack.pop())
        o = self.out
        o["text_chars"] = self.chars
        for x in o["anchors"]:
            x["text"] = " ".join(x["text"].split())
        for x in o["cards"]:
            x["title"] = " ".join(x["title"].split())
        for x in o["props"]:
            x["value"] = " ".join(x["value"].split())
        for k in ("title", "h1", "og_title"):
            o[k] = " ".join(o[k].split()) if o[k] is not None else None
        return o


def _scan_text(text: str | None) -> dict:
    s = _Scan()
    try:
        s.feed(text or "")
        s.close()
    except (AssertionError, ValueError):
        pass
    return s.finish()


def _scan_slices(batches: Iterator[pa.Array], kind: pa.DataType) -> Iterator[pa.Array]:
    """Scans of a batch in slices, so that a worker holds the batch as it came and the scans of few pages."""
    for texts in batches:
        for i in range(0, len(texts), SLICE):
            yield pa.array([_scan_text(t) for t in texts.slice(i, SLICE).to_pylist()], kind)


def scan_html(c: Column) -> Column:
    """The whole structure of each page; a page that the tokeniser gives up on keeps what it found.

    Marked as not deterministic so that Catalyst scans a page once, not again for a filter on what is exploded.
    """
    kind = to_arrow_type(DataType.fromDDL(SCAN))

    @F.arrow_udf(SCAN)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _scan_slices(batches, kind)

    return scan.asNondeterministic()(c)


def scanned(pages: DataFrame, text: str) -> DataFrame:
    return pages.withColumn("scan", scan_html(F.col(text)))


def _dynamic(t: Column, marks: list[str]) -> Column:
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.lower(t).contains(m)
    return (F.col("scan.n_scripts") >= 5) & ((F.col("scan.text_chars") < 300) | marked)


def with_kind(pages: DataFrame, text: str, content_type: Column | None = None) -> DataFrame:
    """Add ``scan`` and ``kind``: empty, anti_bot_challenge, json_api, next_ssr, json_ld, javascript_rendered or static_html."""
    t = F.coalesce(F.col(text), F.lit(""))
    json_like = t.rlike(r"(?U)^\s*[\[{]")
    if content_type is not None:
        json_like = json_like | F.lower(content_type).contains("json")
    challenge = (t.contains("var _xvasu") & t.contains("var _xvpts")) | (t.contains("getRenderData()") & t.rlike("""(?i)id=["']renderData["']"""))
    kind = (
        F.when(stripped(t) == "", "empty").when(challenge, "anti_bot_challenge").when(json_like & F.try_parse_json(t).isNotNull(), "json_api")
        .when(t.rlike("""(?i)<script[^>]+id=["']__NEXT_DATA__["']"""), "next_ssr").when(t.rlike(r"""(?i)<script[^>]+type=["']application/ld\+json["']"""), "json_ld")
        .when(_dynamic(t, SCRIPT_MARKS), "javascript_rendered").otherwise("static_html")
    )
    return scanned(pages, text).withColumn("kind", kind)


def planning_kind(t: Column) -> Column:
    """The coarser classes that planning uses, over ``scan``."""
    low = F.lower(t)
    return (
        F.when(low.contains("var _xvasu") & low.contains("var _xvpts"), "anti_bot_challenge").when(low.contains('id="__next_data__"'), "next_ssr")
        .when(_dynamic(t, [m for m in SCRIPT_MARKS if m != "atomic-result-list"]), "javascript_rendered").otherwise("static_html")
    )


def _any_of(c: Column, marks: list[str]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | c.contains(m)
    return out


def navigation_categories(scan: DataFrame, key: str, url: str) -> DataFrame:
    """Category candidates from navigation links: same site, http(s), not the page itself, no utility text; scored, once per target and name.

    A link scores 1, 2 more for a path of categories and 1 for a word of them; without a
    text it needs 3 and is named by the end of its path.
    """
    a = scan.select(key, url, F.posexplode("scan.anchors").alias("ord", "a")).where("a.in_nav and a.href <> ''")
    a = a.withColumn("_url", joined(F.col(url), F.col("a.href"))).withColumn("target", canonical_page_url(F.col("_url")))
    low = F.lower("a.text")
    score = 1 + 2 * _any_of(F.lower("a.href"), CATEGORY_PATHS).cast("int") + _any_of(low, CATEGORY_WORDS).cast("int")
    fine = F.col("_url").rlike("(?i)^https?://") & same_site(F.col("_url"), F.col(url)) & (F.col("target") != canonical_page_url(F.col(url))) & ~low.isin(*UTILITY)
    named = F.coalesce(F.nullif(F.col("a.text"), F.lit("")), F.substring_index(F.regexp_replace(part(F.col("_url"), "PATH"), "/+$", ""), "/", -1))
    scored = a.where(fine & ((F.col("a.text") != "") | (score >= 3))).select(key, "ord", named.alias("name"), "target", F.bround(F.least(F.lit(0.95), 0.45 + 0.15 * score), 4).alias("confidence"))
    return scored.groupBy(key, "target", "name").agg(F.min("ord").alias("ord"), F.min_by("confidence", "ord").alias("confidence"))


def next_link(scan: Column) -> Column:
    """href of the first live link that says ``next`` by rel, text or class; null if there is none."""
    fine = F.filter(
        scan["anchors"],
        lambda a: ~a["disabled"] & (a["href"] != "") & (F.lower(a["rel"]).contains("next") | F.lower(a["text"]).isin(*NEXT_WORDS) | F.lower(a["css"]).rlike(r"\.next\b")),
    )
    return F.get(fine, F.lit(0))["href"]


def json_scripts(scan: Column) -> Column:
    """Bodies of the scripts that hold JSON: LD+JSON, application/json and framework state."""
    held = F.filter(scan["scripts"], lambda s: F.lower(s["type"]).isin("application/ld+json", "application/json") | (s["id"] == "__NEXT_DATA__"))
    return F.transform(held, lambda s: F.trim(s["body"]))


def table_attributes(scan: Column) -> Column:
    """(name, value) of two-cell rows, definition lists and named attributes."""
    rows = F.transform(
        F.filter(scan["cells"], lambda r: F.size(r["cells"]) >= 2),
        lambda r: F.struct(F.regexp_replace(F.get(r["cells"], F.lit(0)), "[:：]$", "").alias("name"), F.get(r["cells"], F.lit(1)).alias("value")),
    )
    return F.concat(rows, scan["pairs"])


def meta_content(scan: Column, *names: str) -> Column:
    """Content of the first of the named metas that has one."""
    one = lambda n: F.nullif(F.get(F.filter(scan["metas"], lambda m: F.lower(m["name"]) == n), F.lit(0))["content"], F.lit(""))
    return F.coalesce(*[one(n) for n in names])


def detail_title(scan: Column) -> Column:
    """The first heading, else the first og:title, else the title; null if none has a text."""
    return F.coalesce(*[F.nullif(scan[k], F.lit("")) for k in ("h1", "og_title", "title")])


def microdata(scan: Column, item: str, prop: str) -> Column:
    """First value of a property of the items of one type."""
    return F.get(F.filter(scan["props"], lambda p: (p["item"] == item) & (p["prop"] == prop) & (p["value"] != "")), F.lit(0))["value"]


def first_pdf(scan: Column) -> Column:
    return F.get(F.filter(scan["anchors"], lambda a: F.lower(a["href"]).rlike(r"\.pdf(\?|$)")), F.lit(0))["href"]


def product_cards(scan: Column) -> Column:
    """Cards with some identity."""
    return F.filter(scan["cards"], lambda c: (c["sku"] != "") | (c["product_id"] != "") | (c["href"] != ""))
