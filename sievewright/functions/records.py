"""JSON, map and array helpers for half-structured records.

Where document order matters (the first match of a key), an Arrow UDF walks the text
once; where it does not, VARIANT and maps stay in the JVM.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import repeat

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NODE = "array<struct<ord:int,path:string,depth:int,key:string,kind:string,value:string>>"

# Aliases of the catalog columns, in order of preference, as normalised keys.
ALIASES = {
    "sku": ["sku", "sellersku", "stockcode", "catalognumber"],
    "product_id": ["productid", "id", "itemid", "goodsid", "recordid"],
    "detail_url": ["detailurl", "producturl", "url", "href", "link"],
    "title": ["title", "productname", "name", "partnumber", "mpn", "manufacturerpartnumber", "model"],
    "stock": ["stock", "stockquantity", "inventory", "availablequantity", "quantityavailable"],
    "price": ["price", "prices", "pricelist", "pricing", "unitprice"],
    "manufacturer": ["manufacturer", "manufacturername", "brand", "brandname", "mfr"],
    "moq": ["moq", "minimumorderquantity", "minorderqty"],
    "package": ["package", "packagetype", "packaging", "casepackage"],
    "description": ["description", "shortdescription", "summary"],
}


def guarded(text: Column) -> Column:
    """VARIANT of a text that starts as an object or array; else null, also for bad JSON."""
    return F.when(F.ltrim(text).rlike(r"^[\[{]"), F.try_parse_json(text))


def at_path(value: Column, path: str, kind: str = "string") -> Column:
    """``$.a.b[0]`` of a VARIANT, null where it is missing or of another type."""
    return F.try_variant_get(value, path, kind)


def _walk(node, path: str, depth: int, key: str, out: list, most: int) -> None:
    kind = "object" if isinstance(node, dict) else "array" if isinstance(node, list) else "null" if node is None else type(node).__name__
    text = None if isinstance(node, (dict, list)) or node is None else json.dumps(node, ensure_ascii=False) if isinstance(node, bool) else str(node)
    out.append({"ord": len(out), "path": path, "depth": depth, "key": key, "kind": kind, "value": text})
    if depth >= most:
        return
    if isinstance(node, dict):
        for k, v in node.items():
            _walk(v, f"{path}.{k}", depth + 1, k, out, most)
    elif isinstance(node, list):
        for i, v in enumerate(node):
            _walk(v, f"{path}[{i}]", depth + 1, key, out, most)


def ordered_nodes(text: Column, most_depth: int = 64) -> Column:
    """All nodes of a JSON text, depth first in document order; none for bad JSON."""

    @F.pandas_udf(NODE)
    def walk(texts: pd.Series) -> pd.Series:
        def one(t):
            out: list = []
            try:
                if t and t.lstrip()[:1] in ("{", "["):
                    _walk(json.loads(t), "$", 0, "", out, most_depth)
            except (ValueError, RecursionError):
                return []
            return out

        return texts.map(one)

    return walk(text)


#: So many keys of a batch have their normalised form kept.
MOST_NAMES = 4096
LISTS = "array<struct<ord:int,key:string,n_objects:int,first_keys:array<string>,items:array<string>>>"


def _objects(text) -> list[dict]:
    """The objects of a JSON text, depth first in document order; none for bad JSON."""
    found: list[dict] = []
    try:
        todo = [json.loads(text)] if text and text.lstrip()[:1] in ("{", "[") else []
        while todo:
            node = todo.pop()
            if isinstance(node, dict):
                found.append(node)
                todo += reversed(list(node.values()))
            elif isinstance(node, list):
                todo += reversed(node)
    except (ValueError, RecursionError):
        return []
    return found


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def best_object(text: Column, score: Callable[..., int | None], *seeds: Column) -> Column:
    """(score, text) of the object of a JSON text with the highest score, the first of a tie; null if none has one.

    ``score`` gets an object's normalised keys, its scalar values by normalised key (the first that is not empty; @type as it is)
    and the row's seeds. One pass decides, so that only the chosen object leaves it.
    """

    @F.arrow_udf("struct<score:int,text:string>")
    def walk(texts: pa.Array, *given: pa.Array) -> pa.Array:
        normal: dict[str, str] = {}

        def one(t, mine):
            best = None
            for node in _objects(t):
                values: dict[str, str] = {}
                keys = set()
                for k, v in node.items():
                    name = normal.get(k)
                    if name is None:
                        name = re.sub("[^a-z0-9]", "", k.lower())
                        if len(normal) < MOST_NAMES:
                            normal[k] = name
                    keys.add(name)
                    if not isinstance(v, (dict, list)) and v not in (None, ""):
                        values.setdefault(k if k == "@type" else name, str(v))
                n = score(keys, values, *mine)
                if n is not None and (best is None or n > best[0]):
                    best = (n, node)
            return best and {"score": best[0], "text": _json(best[1])}

        rows = zip(texts.to_pylist(), zip(*(g.to_pylist() for g in given)) if given else repeat(()))
        return pa.array([one(t, mine) for t, mine in rows], pa.struct([("score", pa.int32()), ("text", pa.string())]))

    return walk(text, *seeds)


def list_nodes(text: Column) -> Column:
    """The lists under a key in a JSON text in document order: the key, how many objects, the keys of the first five, the items."""

    @F.pandas_udf(LISTS)
    def walk(texts: pd.Series) -> pd.Series:
        def one(t):
            out: list[dict] = []
            for node in _objects(t):
                for k, v in node.items():
                    if isinstance(v, list):
                        objects = [x for x in v if isinstance(x, dict)]
                        keys = [key for x in objects[:5] for key in x]
                        out.append({"ord": len(out), "key": k, "n_objects": len(objects), "first_keys": keys, "items": [_json(x) for x in v]})
            return out

        return texts.map(one)

    return walk(text)


def first_value(nodes: Column, keys: list[str]) -> Column:
    """Value of the first node in document order with one of the normalised keys and a non-empty value."""
    hit = F.filter(nodes, lambda n: F.regexp_replace(F.lower(n["key"]), "[^a-z0-9]", "").isin(*keys) & ~n["kind"].isin("object", "array", "null") & (n["value"] != ""))
    return F.get(hit, F.lit(0))["value"]


def first_count(nodes: Column, keys: list[str]) -> Column:
    """The first such node as an integer from 0; null if it is a boolean or no integer, for the search stops there."""
    hit = F.get(F.filter(nodes, lambda n: F.regexp_replace(F.lower(n["key"]), "[^a-z0-9]", "").isin(*keys) & ~n["kind"].isin("object", "array", "null") & (n["value"] != "")), F.lit(0))
    number = hit["value"].try_cast("bigint")
    return F.when((hit["kind"] != "bool") & (number >= 0), number)


def normal_keys(entries: Column) -> Column:
    """A map with normalised keys; of keys that become equal the first stays."""
    pairs = F.transform(F.map_entries(entries), lambda e: F.struct(F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]", "").alias("key"), e["value"].alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(F.filter(pairs, lambda e: e["key"] == k), F.lit(0))["value"]))


def aliased(normal: Column, name: str) -> Column:
    """A catalog column from normalised keys by its aliases' order."""
    return F.coalesce(*[F.nullif(F.try_element_at(normal, F.lit(k)), F.lit("")) for k in ALIASES[name]])


def unknown_fields(normal: Column) -> Column:
    """The entries that no alias knows."""
    known = sorted({a for aliases in ALIASES.values() for a in aliases})
    return F.map_filter(normal, lambda k, v: ~k.isin(*known))


def attribute_map(pairs: Column) -> Column:
    """Array of (name, value) as a map: empty names and values drop out, the last of a name stays."""
    good = F.filter(pairs, lambda p: (F.coalesce(p["name"], F.lit("")) != "") & (F.coalesce(p["value"], F.lit("")) != ""))
    names = F.array_distinct(F.transform(good, lambda p: p["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(good, lambda p: p["name"] == n), -1)["value"]))


def attribute_by_alias(attributes: Column, aliases: list[str]) -> Column:
    """Value of the first key that contains one of the aliases."""
    pattern = "|".join(re.escape(a.lower()) for a in aliases)
    return F.get(F.filter(F.map_entries(attributes), lambda e: F.lower(e["key"]).rlike(pattern)), F.lit(0))["value"]


def merged_maps(low: Column, high: Column) -> Column:
    """``high`` over ``low``, whatever the map key policy of the session."""
    return F.map_concat(F.map_filter(low, lambda k, v: ~F.map_contains_key(high, k)), high)


def price_tiers(quantities: Column, prices: Column, currency: Column) -> Column:
    """Paired arrays as (quantity, unit_price, currency), as long as the shorter one."""
    n = F.least(F.size(quantities), F.size(prices))
    zipped = F.arrays_zip(F.slice(quantities, F.lit(1), n).alias("quantity"), F.slice(prices, F.lit(1), n).alias("unit_price"))
    return F.transform(zipped, lambda z: F.struct(z["quantity"].alias("quantity"), z["unit_price"].alias("unit_price"), currency.alias("currency")))


def tiers_or_price(tiers: Column, price: Column, currency: Column) -> Column:
    """The tiers if there are some, else the price from one piece."""
    single = F.when(price.isNotNull(), F.array(F.struct(F.lit(1.0).alias("quantity"), price.cast("double").alias("unit_price"), currency.alias("currency"))))
    return F.when(F.size(tiers) > 0, tiers).otherwise(single)


def text_of(value: Column) -> Column:
    """VARIANT as text: of an object its name, label, value, displayName or url; a list comma-joined."""
    inner = F.coalesce(*[F.nullif(F.try_variant_get(value, f"$.{k}", "string"), F.lit("")) for k in ("name", "label", "value", "displayName", "url")])
    many = F.array_join(F.try_variant_get(value, "$", "array<string>"), ", ")
    kind = F.schema_of_variant(value)
    return F.when(kind.startswith("OBJECT"), inner).when(kind.startswith("ARRAY"), many).otherwise(F.try_variant_get(value, "$", "string"))


def url_of(value: Column) -> Column:
    """VARIANT as a URL: of a list the first non-empty one; of an object url, contentUrl or src."""
    kind = F.schema_of_variant(value)
    first = F.get(F.filter(F.try_variant_get(value, "$", "array<string>"), lambda x: x != ""), F.lit(0))
    inner = F.coalesce(*[F.nullif(F.try_variant_get(value, f"$.{k}", "string"), F.lit("")) for k in ("url", "contentUrl", "src")])
    return F.when(kind.startswith("ARRAY"), first).when(kind.startswith("OBJECT"), inner).otherwise(F.try_variant_get(value, "$", "string"))
