"""Captured site records as product columns, record merging, and the choice of the right node of a payload."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import records, text, urls
from sievewright.functions.text import blank_to_null, first_present, present

# Keys of product lists, and keys by which an object is told to be a product: on list pages, in plans, in search results.
LIST_KEYS = ["products", "productlist", "productrecordlist", "productrecords", "items", "results", "records"]
PRODUCT_KEYS = {
    "list": ["sku", "productid", "partnumber", "mpn", "manufacturerpartnumber", "producturl", "detailurl", "stockcode"],
    "plan": ["productid", "productmodel", "partnumber", "genericpartnumber", "mpn", "sku", "productcode", "manufacturerpartnumber"],
    "search": ["productmodel", "genericpartnumber", "mpn", "sku", "productcode"],
}
# Keys that a product's detail may have, and those of which one is enough.
STANDARD_KEYS = [
    "sku", "productid", "id", "itemid", "partnumber", "mpn", "manufacturerpartnumber", "productmodel", "model", "title", "name", "productname", "manufacturer",
    "manufacturername", "brand", "brandname", "package", "packagetype", "packaging", "casepackage", "stock", "stockquantity", "inventory", "availability", "price",
    "prices", "pricelist", "pricing", "offers", "moq", "minimumorderquantity", "minorderqty", "description", "shortdescription", "summary", "image", "imageurl",
    "thumbnail", "datasheet", "datasheeturl", "url", "detailurl", "producturl", "attributes", "specifications", "parameters", "productcode", "stockcode",
    "catalognumber", "goodsid", "genericpartnumber", "mfr", "availablequantity", "validstocknumber", "unitprice", "minbuynumber", "productdesc", "remark",
    "primaryimage", "bigimageurl", "href", "specs", "paramlinkedmap", "technicalparameters",
]
ANCHOR_KEYS = ["sku", "productcode", "stockcode", "catalognumber", "productid", "goodsid", "partnumber", "mpn", "manufacturerpartnumber", "productmodel", "genericpartnumber", "model", "title", "productname"]

ICKEY = (
    "struct<sku:string,title:string,stock:bigint,nums:array<bigint>,calc_sale_rmb_price:array<double>,pro_maf:string,std_mfr_name:string,moq:bigint,"
    "reference_package:string,img_url:string,url:string,short_desc:string>"
)
TIER = "array<struct<startPurchasedNumber:bigint,productPrice:double,thePrice:double,discountPrice:double>>"
SZLCSC = (
    "struct<lightProductCode:string,lightProductModel:string,lightBrandName:string,lightCatalogName:string,lightProductIntro:string,isMultiDiscount:boolean,"
    f"priceDiscount:{TIER},couponAmount:double,couponThresholdMoney:double,paramLinkedMap:map<string,string>,isHot:boolean,rohsLabal:string,smtStockNumber:bigint,totalStockNumber:bigint,"
    "productVO:struct<productCode:string,productName:string,productModel:string,productGradePlateName:string,productGradePlateId:string,productId:string,productType:string,"
    "stockNumber:bigint,validStockNumber:bigint,hasStockNow:string,productStockStatus:string,jsWarehouseStockNumber:bigint,gdWarehouseStockNumber:bigint,usableTransitNum:bigint,"
    f"productPriceList:{TIER},isPromotionDiscount:boolean,minBuyNumber:bigint,maxBuyNumber:bigint,batchStockLimit:bigint,productUnit:string,productUnsealVendition:string,"
    "encapsulationModel:string,productMinEncapsulationUnit:string,productMinEncapsulationNumber:bigint,convesionRatio:bigint,"
    "fileTypeVOList:array<struct<fileType:string,detailVOList:array<struct<fileUrl:string,fileName:string>>>>,breviaryImageUrl:string,bigImageUrl:string,remark:string,"
    "smtLabel:string,productCycle:string,recentlySalesCount:bigint,isPresent:boolean,isOldBatch:boolean>>"
)
FILES = "https://datasheet.lcsc.com"


def _tiers(numbers: Column, prices: Column) -> Column:
    """(num, rmb) as far as both sides go."""
    zipped = records.price_tiers(F.coalesce(numbers, F.array()), F.coalesce(prices, F.array()), F.lit(""))
    return F.transform(zipped, lambda t: F.struct(t["quantity"].alias("num"), t["unit_price"].alias("rmb")))


def _or(c: Column, default) -> Column:
    return F.coalesce(c, F.lit(default))


def ickey_products(items: DataFrame, body: str, category: str) -> DataFrame:
    """Eleven product columns of a list API's items (JSON texts); missing values have their defaults."""
    r = F.from_json(body, ICKEY)
    rows = items.select(F.col(category).alias("cate_id"), r.alias("r"))
    return rows.select(
        "cate_id", _or(F.col("r.sku"), "").alias("sku"), text.stripped(_or(F.col("r.title"), "")).alias("title"), _or(F.col("r.stock"), 0).cast("bigint").alias("stock"),
        _tiers(F.col("r.nums"), F.col("r.calc_sale_rmb_price")).alias("price"), F.coalesce(blank_to_null(F.col("r.pro_maf")), F.col("r.std_mfr_name"), F.lit("")).alias("manufacturer"),
        _or(F.col("r.moq"), 1).cast("bigint").alias("moq"), _or(F.col("r.reference_package"), "").alias("package"),
        urls.https_of(_or(F.col("r.img_url"), "")).alias("image_url"), urls.https_of(_or(F.col("r.url"), "")).alias("detail_url"), _or(F.col("r.short_desc"), "").alias("description"),
    )


def ti_products(pages: DataFrame, body: str) -> DataFrame:
    """Products of a parametric API's body, each with its page's family columns (family_id, family_name, category, subcategory)."""
    schema = (
        "struct<results:array<struct<genericPartNumber:string,localization:map<string,struct<title:string,productDesc:string>>,productStatus:struct<name:string,id:bigint>,"
        "opnList:array<string>,datasheetPDF:boolean,datasheetHTML:boolean,rating:map<string,string>,functionalSafety:map<string,string>>>>"
    )
    family = ["family_id", "family_name", "category", "subcategory"]
    rows = pages.select(*family, F.explode(F.from_json(body, schema)["results"]).alias("r"))
    words = F.try_element_at("r.localization", F.lit("en-US"))
    none = F.create_map().cast("map<string,string>")
    return rows.select(
        _or(F.col("r.genericPartNumber"), "").alias("sku"), _or(words["title"], "").alias("title"), _or(words["productDesc"], "").alias("description"), *family,
        _or(F.col("r.productStatus.name"), "").alias("status"), F.col("r.productStatus.id").alias("status_id"), F.coalesce("r.opnList", F.array().cast("array<string>")).alias("opn_list"),
        _or(F.col("r.datasheetPDF"), False).alias("datasheet_pdf"), _or(F.col("r.datasheetHTML"), False).alias("datasheet_html"),
        F.coalesce("r.rating", none).alias("rating"), F.coalesce("r.functionalSafety", none).alias("functional_safety"),
    )


def datasheets(files: Column) -> Column:
    """(name, url) of all files of the data-sheet type of a nested file list, in order; paths get their host."""
    sheets = F.filter(F.coalesce(files, F.array()), lambda f: f["fileType"] == "pdf_property")
    paths = F.filter(F.flatten(F.transform(sheets, lambda f: F.coalesce(f["detailVOList"], F.array()))), lambda d: F.coalesce(d["fileUrl"], F.lit("")) != "")
    url = lambda p: F.when(p.startswith("/"), F.concat(F.lit(FILES), p)).otherwise(p)
    return F.transform(paths, lambda d: F.struct(_or(d["fileName"], "").alias("name"), url(d["fileUrl"]).alias("url")))


def szlcsc_products(items: DataFrame, body: str, category: str) -> DataFrame:
    """The 47 product columns of a list record: inner values before outer ones, discount tiers in place of normal ones, flat parameters, data sheets, stocks by warehouse."""
    rows = items.select(F.col(category).alias("catalog_id"), F.from_json(body, SZLCSC).alias("r"))
    v = lambda name, default="": _or(F.col(f"r.productVO.{name}"), default)
    o = lambda name, default="": _or(F.col(f"r.{name}"), default)
    tiers = lambda c, price: F.transform(F.coalesce(c, F.array()), lambda t: F.struct(_or(t["startPurchasedNumber"], 1).cast("bigint").alias("num"), price(t).alias("rmb")))
    normal = tiers(F.col("r.productVO.productPriceList"), lambda t: F.when(t["productPrice"] != 0, t["productPrice"]).otherwise(_or(t["thePrice"], 0.0)))
    cheap = tiers(F.col("r.priceDiscount"), lambda t: _or(t["discountPrice"], 0.0))
    first = lambda a, b: F.coalesce(blank_to_null(a), b)
    parameter = lambda x: F.when(x.startswith("{"), F.coalesce(F.get_json_object(x, "$.paramValue"), x)).otherwise(x)
    sheets = datasheets(F.col("r.productVO.fileTypeVOList"))
    product_id = v("productId")
    columns = {
        "sku": first(v("productCode"), o("lightProductCode")), "title": text.stripped(v("productName")), "model": first(v("productModel"), o("lightProductModel")),
        "brand": first(v("productGradePlateName"), o("lightBrandName")), "product_id": product_id, "product_type": v("productType"), "catalog_name": o("lightCatalogName"),
        "stock": v("stockNumber", 0).cast("bigint"), "valid_stock": v("validStockNumber", 0).cast("bigint"), "has_stock": v("hasStockNow"), "stock_status": v("productStockStatus"),
        "js_stock": F.col("r.productVO.jsWarehouseStockNumber"), "gd_stock": F.col("r.productVO.gdWarehouseStockNumber"), "smt_stock": o("smtStockNumber", 0).cast("bigint"),
        "total_stock": F.coalesce("r.totalStockNumber", v("stockNumber", 0)).cast("bigint"), "transit_num": v("usableTransitNum", 0).cast("bigint"),
        "price": F.when(F.size(cheap) > 0, cheap).otherwise(normal), "is_discount": o("isMultiDiscount", False) | v("isPromotionDiscount", False),
        "coupon_amount": o("couponAmount", 0.0), "coupon_threshold": o("couponThresholdMoney", 0.0), "moq": v("minBuyNumber", 1).cast("bigint"), "max_buy": v("maxBuyNumber", -1).cast("bigint"),
        "batch_limit": v("batchStockLimit", 0).cast("bigint"), "product_unit": v("productUnit"), "unseal": v("productUnsealVendition"), "package": v("encapsulationModel"),
        "min_encap_unit": v("productMinEncapsulationUnit"), "min_encap_num": v("productMinEncapsulationNumber", 0).cast("bigint"), "convesion_ratio": v("convesionRatio", 1).cast("bigint"),
        "attributes": F.transform_values(F.coalesce("r.paramLinkedMap", F.create_map().cast("map<string,string>")), lambda k, x: parameter(x)),
        "datasheet_url": _or(F.get(sheets, F.lit(0))["url"], ""), "datasheet_list": sheets, "image_url": urls.https_of(first(v("breviaryImageUrl"), v("bigImageUrl"))),
        "big_image_url": urls.https_of(v("bigImageUrl")), "detail_url": F.when(product_id != "", F.concat(F.lit("https://item.szlcsc.com/"), product_id, F.lit(".html"))).otherwise(""),
        "description": first(o("lightProductIntro"), v("productType")), "remark": v("remark"), "smt_label": v("smtLabel"), "product_cycle": v("productCycle"),
        "grade_plate_name": v("productGradePlateName"), "grade_plate_id": v("productGradePlateId"), "recent_sales": v("recentlySalesCount", 0).cast("bigint"), "is_hot": o("isHot", False),
        "is_present": v("isPresent", False), "is_old_batch": v("isOldBatch", False), "rohs_label": o("rohsLabal"),
    }
    return rows.select("catalog_id", *[c.alias(name) for name, c in columns.items()])


def detail_or_list(products: DataFrame, details: DataFrame, key: str = "sku") -> DataFrame:
    """Detail rows of the products whose page was read; the others' title (model first), attributes, data sheet and image come from the list."""
    d = details.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in ("title", "datasheet_url", "image_url")], F.lit(True).alias("_read"))
    joined = products.join(d, products[key] == d["_k"], "left")
    read = F.col("_read").isNotNull()
    own = first_present(F.col("model"), F.col("title"))
    return joined.select(
        key, F.when(read, F.col("_title")).otherwise(own).alias("title"), *[F.when(read, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("datasheet_url", "image_url")],
        F.when(read, "detail").otherwise("list").alias("origin"),
    )


def looks_like_product(keys: Column, variant: str = "list") -> Column:
    """Whether an object's keys have one by which products are told."""
    return F.arrays_overlap(F.transform(keys, text.key_text), F.array(*[F.lit(k) for k in PRODUCT_KEYS[variant]]))


def product_list(body: Column) -> Column:
    """Items (JSON texts) of the best product list in a payload, the first of a tie; empty if there is none.

    A list under a product key scores 100 and one for each object, 80 less if none of its first five
    objects looks like a product; a list under ``data`` scores 50 if one of them does.
    """
    def score(n: Column) -> Column:
        key, many, like = text.key_text(n["key"]), n["n_objects"], looks_like_product(n["first_keys"])
        return F.when(key.isin(*LIST_KEYS), 100 + many - F.when((many > 0) & ~like, 80).otherwise(0)).when((key == "data") & (many > 0) & like, 50 + many)

    lists = records.list_nodes(body)
    scored = F.transform(lists, lambda n: F.struct(score(n).alias("score"), (-n["ord"]).alias("place"), n["items"].alias("items")))
    good = F.filter(scored, lambda s: s["score"].isNotNull())
    return F.when(F.size(good) > 0, F.array_max(good)["items"]).otherwise(F.array().cast("array<string>"))


def best_mapping(body: Column, sku: Column, product_id: Column) -> Column:
    """(score, text) of the object of a payload that is most like a product's detail, the first of a tie; null if none is.

    One for each standard key, 100 each for the seed's sku and product_id, 40 for a type of Product.
    """
    said = lambda values, names: re.sub("[^A-Z0-9]", "", next((values[k] for k in names if k in values), "").upper())

    def judged(keys: set, values: dict, mine: str, own: str) -> int | None:
        same_sku = mine != "" and said(values, ["sku", "productcode", "stockcode", "catalognumber"]) == mine
        same_id = own != "" and said(values, ["productid", "id", "itemid", "goodsid"]) == own
        product = values.get("@type", "").lower() == "product"
        score = len(keys & standard) + 100 * same_sku + 100 * same_id + 40 * product
        return score if score >= 2 or same_sku or same_id or product or keys & anchors else None

    standard, anchors = frozenset(STANDARD_KEYS), frozenset(ANCHOR_KEYS)
    seeds = [text.compact_code(F.coalesce(c, F.lit(""))) for c in (sku, product_id)]
    return records.best_object(body, judged, *seeds)


#: Columns of a record of which the detail's value wins if it has one.
DETAIL_WINS = ["model", "title", "manufacturer", "moq", "description", "datasheet_url", "image_url", "detail_url"]


def merged_records(listed: DataFrame, details: DataFrame, key: str = "sku") -> DataFrame:
    """List records with their details, column by column.

    The package stays that of the list if it has one; the longer price list wins, and a list price that stays beside another
    one keeps that as detail_price; a number in stock (stock_qty) of the detail wins, and a stock text (stock_status) of
    the detail only fills a gap, else it stands in stock_note; attributes are merged. ``details`` has one row per key.
    """
    d = details.select(*[F.col(c).alias(f"_d_{c}") for c in details.columns])
    joined = listed.join(d, F.col(key) == F.col(f"_d_{key}"), "left")
    mine, theirs = lambda c: F.col(c), lambda c: F.col(f"_d_{c}")
    kinds = dict(listed.dtypes)
    wins = [F.when(present(theirs(c), kinds[c]), theirs(c)).otherwise(mine(c)).alias(c) for c in DETAIL_WINS if c in listed.columns and c in details.columns]
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    n, m = F.when(mine("price").isNull(), 0).otherwise(size(mine("price"))), F.when(theirs("price").isNull(), 0).otherwise(size(theirs("price")))
    longer = (m > 0) & (m > n)
    none = mine("stock_qty").isNull() & (F.coalesce(mine("stock_status"), F.lit("")) == "")
    numbered, told = theirs("stock_qty").isNotNull(), F.coalesce(theirs("stock_status"), F.lit("")) != ""
    out = [
        F.col(key), *wins, F.when((F.coalesce(mine("package"), F.lit("")) == "") & (F.coalesce(theirs("package"), F.lit("")) != ""), theirs("package")).otherwise(mine("package")).alias("package"),
        F.when(longer, theirs("price")).otherwise(mine("price")).alias("price"), F.when(~longer & (m > 0) & (theirs("price") != mine("price")), theirs("price")).alias("detail_price"),
        F.when(numbered, theirs("stock_qty")).otherwise(mine("stock_qty")).alias("stock_qty"), F.when(numbered, F.lit(None)).when(none, theirs("stock_status")).otherwise(mine("stock_status")).alias("stock_status"),
        F.when(~numbered & ~none & told, theirs("stock_status")).alias("stock_note"),
    ]
    if "attributes" in listed.columns and "attributes" in details.columns:
        empty = F.create_map().cast("map<string,string>")
        out.append(records.merged_maps(F.coalesce(mine("attributes"), empty), F.coalesce(theirs("attributes"), empty)).alias("attributes"))
    return joined.select(out)


# Requested names, and the columns of which one with a value is enough.
FIELD_SOURCES = {
    "part_number": ["part_number", "model", "sku"], "model": ["part_number", "model", "sku"], "mpn": ["part_number", "model", "sku"], "stock_availability": ["stock"], "availability": ["stock"],
    "electrical_parameters": ["attributes"], "operating_conditions": ["attributes"], "application_information": ["attributes"], "package_information": ["package", "attributes"],
    "product_status": ["stock", "product_status"], "quoted_price": ["price"],
}


def missing_target_fields(df: DataFrame, fields: list[str]) -> Column:
    """Names of the requested fields that have no value under any of their columns, in order; a column that is not there has none."""
    kinds = dict(df.dtypes)

    def has(name: str) -> Column:
        out = F.lit(False)
        for c in FIELD_SOURCES.get(name, [name]):
            out = out | present(F.col(c), kinds[c]) if c in kinds else out
        return out

    names = [f for f in fields if f.strip()]
    return F.array_compact(F.array(*[F.when(~has(f.strip().lower()), F.lit(f)) for f in names])) if names else F.array().cast("array<string>")


def failure_cut(pages: DataFrame, category: str, page: str, n_items: str, most: int = 20) -> DataFrame:
    """Add in_a_row (pages without items up to and with this one, since the last page with some) and visited (before the ``most``-th in a row was passed).

    One sequence is a category's pages; ``most`` ends it.
    """
    w = Window.partitionBy(category).orderBy(page)
    bad = F.coalesce(F.col(n_items), F.lit(0)) == 0
    good_before = F.count(F.when(~bad, 1)).over(w)
    out = pages.withColumn("_island", good_before)
    run = Window.partitionBy(category, "_island").orderBy(page)
    out = out.withColumn("in_a_row", F.when(bad, F.count(F.when(bad, 1)).over(run)).otherwise(0).cast("bigint"))
    ended = F.count(F.when(F.col("in_a_row") >= most, 1)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return out.withColumn("visited", F.coalesce(ended, F.lit(0)) == 0).drop("_island")


def advanced(pages: DataFrame, category: str, page: str, page_size: Column) -> DataFrame:
    """Add next_page and next_offset: one page on, and one page size for each page so far."""
    number = F.row_number().over(Window.partitionBy(category).orderBy(page))
    return pages.withColumn("next_page", F.col(page) + 1).withColumn("next_offset", (number * page_size).cast("bigint"))


def accepted_probes(probes: DataFrame, source: str, attempt: str, signature: str) -> DataFrame:
    """The first probe of each source whose signature is not that of the source's first page (attempt 0); probes without one are not accepted."""
    first = probes.where(F.col(attempt) == 0).select(F.col(source).alias("_s"), F.col(signature).alias("_first"))
    fresh = probes.where(F.col(attempt) > 0).join(first, F.col(source) == F.col("_s")).where((F.coalesce(F.col(signature), F.lit("")) != "") & ~F.col(signature).eqNullSafe(F.col("_first")))
    return fresh.groupBy(source).agg(F.min(attempt).alias("attempt"), F.min_by(signature, attempt).alias("signature"))


def leaf_count(tree: Column, *inner: str) -> Column:
    """Leaves of nested arrays of structs; ``inner`` names the array of each deeper level."""
    if not inner:
        return F.coalesce(F.size(tree), F.lit(0)).cast("bigint")
    return F.coalesce(F.aggregate(tree, F.lit(0).cast("bigint"), lambda acc, x: acc + leaf_count(x[inner[0]], *inner[1:])), F.lit(0).cast("bigint"))


def run_summary(seeds: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """One row: seeds, distinct ones, duplicates, completed ones among them, and those left."""
    mine = seeds.groupBy(key).agg(F.count("*").alias("n")).join(completed.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    one = mine.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_seeds"), F.count("*").alias("n_distinct"), F.count("_done").alias("n_completed"))
    return one.select("*", (F.col("n_seeds") - F.col("n_distinct")).alias("n_duplicates"), (F.col("n_distinct") - F.col("n_completed")).alias("n_left"))


def useful_observations(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Network observations that may hold data (type xhr or fetch, or a JSON content type), their bodies cut at ``most`` characters as captures are."""
    kind, content = F.lower(F.coalesce("resource_type", F.lit(""))), F.lower(F.coalesce("content_type", F.lit("")))
    return df.where(kind.isin("xhr", "fetch") | content.contains("json")).withColumn("response_text", F.substring("response_text", 1, most))


def adaptive_text(kind: Column, plain: Column, rendered: Column) -> Column:
    """The rendered capture of pages that are a challenge or built by scripts, if there is one; else the plain one."""
    return F.when(kind.isin("anti_bot_challenge", "javascript_rendered"), F.coalesce(rendered, plain)).otherwise(plain)


def run_time(moment: Column) -> Column:
    """A timestamp as ISO 8601 UTC seconds; the session's zone must be UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
