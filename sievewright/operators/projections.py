"""Projections from captured records to product columns; all are plain selects that Catalyst can prune."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import html, records, text, urls
from sievewright.operators import identity
from sievewright.operators.merge import layered

# The columns of a seed and of a product, and those that every report has.
SEED = ["sku", "product_id", "title", "stock", "price", "manufacturer", "moq", "package", "detail_url", "description"]
PRODUCT_TEXT = ["title", "sku", "product_id", "manufacturer", "package", "description", "detail_url"]
IDENTITY_FIELDS = ["site_key", "title", "model", "sku", "product_id", "manufacturer", "detail_url"]


def list_items(pages: DataFrame, body: str, path: str) -> DataFrame:
    """One row per object of the list at ``path`` of a JSON body: page columns, ord and raw (map of text values, nested ones as JSON)."""
    items = F.from_json(F.get_json_object(body, path), "array<string>")
    kept = [c for c in pages.columns if c != body]
    rows = pages.select(*kept, F.posexplode(items).alias("ord", "_item"))
    return rows.withColumn("raw", F.from_json("_item", "map<string,string>")).where("raw is not null").drop("_item")


def seeds(items: DataFrame, raw: str, source_url: str) -> DataFrame:
    """Catalog columns by alias precedence, absolute URLs, the identity key and what no alias knows.

    Rows whose map gives no identity keep a null dedup_key.
    """
    normal = items.withColumn("_m", records.normal_keys(F.col(raw)))
    out = normal.select(*items.columns, *[records.aliased(F.col("_m"), c).alias(c) for c in SEED if c not in items.columns], records.unknown_fields(F.col("_m")).alias("site_fields"))
    out = out.withColumn("detail_url", urls.joined(F.col(source_url), F.col("detail_url")))
    key = identity.seed_identity(F.col("sku"), F.col("product_id"), F.col("detail_url"))
    return out.withColumn("dedup_key", key).withColumn("dedup_method", identity.identity_method(F.coalesce(key, F.lit(""))))


def card_seeds(scan: DataFrame, source_url: str) -> DataFrame:
    """Seeds from the product cards of scanned pages."""
    kept = [c for c in scan.columns if c not in ("scan", "kind")]
    rows = scan.select(*kept, F.posexplode(html.product_cards(F.col("scan"))).alias("ord", "c"))
    raw = F.map_filter(F.create_map(*[x for k in ("sku", "product_id", "href", "title") for x in (F.lit(k), F.col("c")[k])]), lambda k, v: v != "")
    return seeds(rows.select(*kept, "ord", raw.alias("raw")), "raw", source_url)


def table_seeds(scan: DataFrame, source_url: str, table: str, columns: dict[str, int], least: int = 5) -> DataFrame:
    """Seeds from the rows of tables of one class: cells by place, rows of fewer than ``least`` cells and blank models left out."""
    kept = [c for c in scan.columns if c not in ("scan", "kind")]
    rows = scan.select(*kept, F.posexplode(F.filter("scan.cells", lambda r: (r["table"] == table) & (F.size(r["cells"]) >= least))).alias("ord", "r"))
    cells = [F.nullif(F.get("r.cells", F.lit(i)), F.lit("")).alias(c) for c, i in columns.items()]
    out = rows.select(*kept, "ord", *cells, urls.joined(F.col(source_url), F.col("r.href")).alias("detail_url"))
    first = next(iter(columns))
    return out.where(F.col(first).isNotNull())


def reported_total(page_text: Column, pattern: str = r"共\s*([\d,]+)\s*条") -> Column:
    """The number of results that a page states."""
    return F.regexp_replace(F.regexp_extract(page_text, pattern, 1), ",", "").try_cast("bigint")


def products_from_seeds(df: DataFrame, default: str = "unknown_product") -> DataFrame:
    """Products from catalog rows alone: title fallbacks, empty texts as defaults, status complete."""
    title = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("title", "sku", "product_id") if c in df.columns], F.lit(default))
    out = df.withColumn("title", title).withColumn("fetch_status", F.lit("complete"))
    return out.fillna("", [c for c in PRODUCT_TEXT if c in df.columns and c != "title"])


def attributes_of(scan: Column) -> Column:
    return records.attribute_map(html.table_attributes(scan))


def jsonld_products(scan: DataFrame) -> DataFrame:
    """Product nodes of LD+JSON (alone, in a list or in @graph): sku, mpn, name, brand, price, currency, availability, stock."""
    kept = [c for c in scan.columns if c not in ("scan", "kind")]
    bodies = scan.select(*kept, F.explode(html.json_scripts(F.col("scan"))).alias("_b"))
    v = F.try_parse_json("_b")
    many = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v))
    nodes = bodies.select(*kept, F.posexplode(many).alias("ord", "n"))
    get = lambda *paths: F.coalesce(*[F.try_variant_get("n", p, "string") for p in paths])
    kind = get("$['@type']")
    return nodes.where(kind.endswith("Product")).select(
        *kept, "ord", get("$.sku").alias("sku"), get("$.mpn").alias("mpn"), get("$.name").alias("title"), get("$.brand.name", "$.brand").alias("manufacturer"),
        get("$.offers.price", "$.offers[0].price").alias("price"), get("$.offers.priceCurrency", "$.offers[0].priceCurrency").alias("currency"),
        text.availability(get("$.offers.availability", "$.offers[0].availability")).alias("availability"),
        get("$.offers.inventoryLevel.value", "$.offers[0].inventoryLevel.value").try_cast("double").alias("stock"), get("$.subjectOf.url").alias("datasheet_url"),
    )


def details(seed_rows: DataFrame, scan: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Seeds with the layers of their detail page: page metadata, then JSON-LD, each winning where it has a value.

    ``scan`` has one row per key with ``scan`` and ``status_code``. Seeds without a page or
    with an error keep their catalog values and fetch_status failed; missing lists the
    required fields that stay empty.
    """
    page = scan.select(key, "status_code", "scan").withColumn("_title", html.detail_title(F.col("scan"))).withColumn("attributes", attributes_of(F.col("scan"))).withColumn("_pdf", html.first_pdf(F.col("scan")))
    ld = jsonld_products(scan.select(key, "scan"))
    ld = identity.one_per_key(ld, [key], F.col("ord")).select(key, *[F.col(c).alias(f"_ld_{c}") for c in ("sku", "title", "manufacturer", "price", "availability", "stock", "datasheet_url")])
    joined = seed_rows.join(page.drop("scan"), key, "left").join(ld, key, "left")
    ok = F.coalesce(F.col("status_code") < 400, F.lit(False))
    maker = F.try_element_at("attributes", F.lit("Manufacturer"))
    out = joined.select(
        *[c for c in seed_rows.columns if c not in ("title", "manufacturer", "price", "stock")],
        layered("string", F.col("title"), F.col("_title"), F.col("_ld_title")).alias("title"),
        layered("string", F.col("manufacturer"), maker, F.col("_ld_manufacturer")).alias("manufacturer"),
        layered("string", F.col("price"), F.col("_ld_price")).alias("price"),
        layered("string", F.col("stock"), F.col("_ld_stock").cast("string")).alias("stock"),
        F.col("_ld_availability").alias("availability"), "attributes", F.coalesce("_ld_datasheet_url", "_pdf").alias("datasheet_url"),
        F.when(ok, "success").otherwise("failed").alias("fetch_status"), F.col("status_code"),
    )
    kinds = dict(out.dtypes)
    missing = F.array_compact(F.array(*[F.when(~text.present(F.col(f), kinds[f]), F.lit(f)) for f in required])) if required else F.array().cast("array<string>")
    return out.withColumn("missing_fields", missing)


def requested(df: DataFrame, fields: list[str]) -> DataFrame:
    """Identity columns and the asked ones that exist, in that order, each once."""
    return df.select([c for c in dict.fromkeys([*IDENTITY_FIELDS, *fields]) if c in df.columns])


def tolerant(df: DataFrame, wanted: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Columns by name: (type, aliases); the first alias that there is and that casts, else null."""
    def one(kind: str, names: list[str]) -> Column:
        there = [F.col(f"`{n}`").cast("string").try_cast(kind) for n in names if n in df.columns]
        return reduce(lambda a, b: F.coalesce(a, b), there) if there else F.lit(None).cast(kind)

    return df.select([one(kind, [name, *aliases]).alias(name) for name, (kind, aliases) in wanted.items()])


def parameter_map(params: Column) -> Column:
    """Array of (name, attr, values) as a map ``name`` or ``name_attr`` to the comma-joined values, the last of a name staying."""
    name = lambda p: F.when(F.coalesce(p["attr"], F.lit("")) == "", p["name"]).otherwise(F.concat_ws("_", p["name"], p["attr"]))
    return records.attribute_map(F.transform(params, lambda p: F.struct(name(p).alias("name"), F.concat_ws(", ", p["values"]).alias("value"))))


def detail_request(df: DataFrame, template: str | None, policy: dict[str, str]) -> DataFrame:
    """request_url (an override, else the filled template, else detail_url) and headers (policy, then the row's, then a Referer).

    Optional columns: request_override string, request_headers map<string,string>, source_url.
    """
    null = F.lit(None).cast("string")
    col = lambda c, d=null: F.col(c) if c in df.columns else d
    filled = F.lit(template) if template else null
    for c in ("sku", "product_id", "detail_url", "category_id"):
        filled = F.replace(filled, F.lit("{" + c + "}"), F.coalesce(col(c), F.lit("")))
    base = F.create_map(*[x for k, v in policy.items() for x in (F.lit(k), F.lit(v))]) if policy else F.create_map().cast("map<string,string>")
    own = F.coalesce(col("request_headers", F.lit(None).cast("map<string,string>")), F.create_map().cast("map<string,string>"))
    merged = records.merged_maps(base, own)
    referer = F.when(F.map_contains_key(merged, F.lit("Referer")) | col("source_url").isNull(), merged).otherwise(F.map_concat(merged, F.create_map(F.lit("Referer"), F.coalesce(col("source_url"), F.lit("")))))
    return df.withColumn("request_url", F.coalesce(F.nullif(col("request_override"), F.lit("")), F.nullif(filled, F.lit("")), col("detail_url"))).withColumn("request_headers", referer)


def target_fields(plan_fields: Column, decided_fields: Column) -> Column:
    """The plan's required fields, else those of the site's type, else none."""
    return F.when(F.size(plan_fields) > 0, plan_fields).otherwise(F.coalesce(decided_fields, F.array().cast("array<string>")))


def observation_sizes(df: DataFrame, body: str = "response_text") -> DataFrame:
    """Network observations with the size of the body in its place."""
    return df.withColumn(f"{body}_length", F.length(body)).drop(body)
