"""URL helpers. try_parse_url never throws, whatever the URL."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that bind a category.
CATEGORY_KEYS = ["cate_id", "cateId", "category_id", "categoryId", "catalogId", "category"]


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def decoded(c: Column) -> Column:
    """Form decoding; what is no valid escape stays."""
    return F.coalesce(F.try_url_decode(c), c)


def encoded(c: Column) -> Column:
    """Form encoding with ``*`` escaped and ``~`` not."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def sorted_query(query: Column) -> Column:
    """The pairs decoded, sorted by key and value and encoded again; blanks and repeats stay, and a bare key gets its ``=``."""
    rest = lambda p: F.when(p.contains("="), F.substring(p, F.locate("=", p) + 1, F.length(p))).otherwise("")
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), decoded(rest(p)).alias("v")))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(encoded(p["k"]), F.lit("="), encoded(p["v"]))), "&")


def _canonical(url: Column, in_order: bool) -> Column:
    host, query = part(url, "AUTHORITY"), F.coalesce(part(url, "QUERY"), F.lit(""))
    query = sorted_query(query) if in_order else query
    path = F.regexp_replace(F.coalesce(part(url, "PATH"), F.lit("")), "/+$", "")
    made = F.concat(
        F.lower(part(url, "PROTOCOL")), F.lit("://"), F.lower(host), F.when(path == "", "/").otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )
    return F.coalesce(made, url)


def canonical_product_url(url: Column) -> Column:
    """Scheme and host in lower case, no trailing slashes or fragment, query pairs sorted (blanks and repeats kept); a relative URL as it is."""
    return _canonical(F.btrim(url), True)


def canonical_page_url(url: Column) -> Column:
    """As canonical_product_url, with the query in its order."""
    return _canonical(url, False)


def start_url(value: Column) -> Column:
    """https unless a scheme is given; null where it is not http(s) or has no host."""
    v = F.btrim(value)
    url = F.when(v.contains("://"), v).otherwise(F.concat(F.lit("https://"), v))
    return F.when(F.lower(part(url, "PROTOCOL")).isin("http", "https") & part(url, "HOST").isNotNull(), url)


def host_of(value: Column) -> Column:
    """Host of a URL or a bare host name, lower case, without a final dot; empty if there is none."""
    v = F.btrim(value)
    url = F.when(v.contains("://"), v).otherwise(F.concat(F.lit("x://"), v))
    return F.coalesce(F.regexp_replace(F.lower(part(url, "HOST")), r"\.+$", ""), F.lit(""))


def same_site(a: Column, b: Column) -> Column:
    """Equal hosts, or one a subdomain of the other."""
    x, y = host_of(a), host_of(b)
    return (x != "") & (y != "") & ((x == y) | x.endswith(F.concat(F.lit("."), y)) | y.endswith(F.concat(F.lit("."), x)))


def query_map(url: Column) -> Column:
    """Query as a map, the last of repeated keys staying in the first one's place."""
    pairs = F.transform(
        F.filter(F.split(F.coalesce(part(url, "QUERY"), F.lit("")), "&"), lambda p: p != ""),
        lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), p.alias("p")),
    )
    keys = F.array_distinct(F.transform(pairs, lambda e: e["k"]))
    value = lambda p: F.when(p.contains("="), F.substring(p, F.locate("=", p) + 1, F.length(p))).otherwise("")
    last = lambda k: F.element_at(F.filter(pairs, lambda e: e["k"] == k), -1)["p"]
    return F.map_from_arrays(keys, F.transform(keys, lambda k: value(last(k))))


def has_parameter(url: Column, name: str) -> Column:
    return F.coalesce(part(url, "QUERY"), F.lit("")).rlike(f"(^|&){name}(=|&|$)")


def has_cursor_parameter(url: Column) -> Column:
    """A query key with ``cursor`` or ``token`` in it."""
    return F.coalesce(F.lower(part(url, "QUERY")), F.lit("")).rlike(r"(^|&)[^=&]*(cursor|token)[^=&]*(=|&|$)")


def set_query_parameter(url: Column, name: str, value: Column) -> Column:
    """Set one parameter: pairs of the same key give way to one in the place of the first, or at the end."""
    query = F.coalesce(part(url, "QUERY"), F.lit(""))
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    mine = lambda p: F.substring_index(p, "=", 1) == name
    place = F.array_position(F.transform(pairs, mine), F.lit(True))
    new = F.concat(F.lit(f"{name}="), value.cast("string"))
    others = F.filter(pairs, lambda p: ~mine(p))
    put = F.when(place > 0, F.concat(F.slice(pairs, F.lit(1), place.cast("int") - 1), F.array(new), F.filter(F.slice(pairs, place.cast("int") + 1, F.size(pairs)), lambda p: ~mine(p))))
    frag = part(url, "REF")
    base = F.regexp_replace(F.substring_index(url, "#", 1), r"\?.*$", "")
    return F.concat(base, F.lit("?"), F.array_join(F.coalesce(put, F.concat(others, F.array(new))), "&"), F.when(frag.isNotNull(), F.concat(F.lit("#"), frag)).otherwise(""))


def _pairs(url: Column) -> Column:
    return F.filter(F.split(F.coalesce(part(url, "QUERY"), F.lit("")), "&"), lambda p: p != "")


def _key(pair: Column) -> Column:
    return F.substring_index(pair, "=", 1)


def _with_pairs(url: Column, pairs: Column) -> Column:
    """The URL without fragment and with other query pairs."""
    base = F.regexp_replace(F.substring_index(url, "#", 1), r"\?.*$", "")
    return F.when(F.size(pairs) > 0, F.concat(base, F.lit("?"), F.array_join(pairs, "&"))).otherwise(base)


def bind_category(url: Column, category_id: Column) -> Column:
    """Put the category's id into whichever known category keys the URL has."""
    bound = F.transform(_pairs(url), lambda p: F.when(_key(p).isin(*CATEGORY_KEYS), F.concat(_key(p), F.lit("="), category_id)).otherwise(p))
    return _with_pairs(url, bound)


def bind_template(template: Column, url: Column) -> Column:
    """Copy the category binding of ``url`` into a template of the same host and path; other templates stay."""
    alike = (host_of(template) == host_of(url)) & (part(template, "PATH") == part(url, "PATH"))
    binding = F.filter(_pairs(url), lambda p: _key(p).isin(*CATEGORY_KEYS))
    taken = F.transform(binding, _key)
    rest = F.filter(_pairs(template), lambda p: ~F.array_contains(taken, _key(p)))
    return F.when(alike, _with_pairs(template, F.concat(rest, binding))).otherwise(template)


def https_of(url: Column) -> Column:
    """``//host`` as ``https://host``."""
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(url)


def _join_links(base: pd.Series, link: pd.Series) -> pd.Series:
    return pd.Series([None if u is None else urljoin(b or "", u) for b, u in zip(base, link)], dtype=object)


def joined(base: Column, link: Column) -> Column:
    """RFC 3986 resolution of a link, which has no built-in counterpart.

    Marked as not deterministic so that Catalyst evaluates it once, in a projection of its own.
    """
    return F.pandas_udf(_join_links, "string").asNondeterministic()(base, link)


def category_id_of(url: Column) -> Column:
    """``cate_id`` of the query, or the number in ``/catalog/<n>``, or ``catalogId``."""
    number = F.nullif(F.regexp_extract(url, r"/catalog/(\d+)", 1), F.lit(""))
    return F.coalesce(F.try_parse_url(url, F.lit("QUERY"), F.lit("cate_id")), number, F.try_parse_url(url, F.lit("QUERY"), F.lit("catalogId")))


def looks_like_product(url: Column) -> Column:
    return F.lower(url).rlike("/product/|/products/|/detail/|/item/")


def base_url(product_api: Column, list_path: Column, category_url: Column, start: Column) -> Column:
    """The product API if its list is known, else the category, else the API, else the start."""
    null = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(F.when(null(list_path).isNotNull(), null(product_api)), null(category_url), null(product_api), start)


def search_url(template: Column, query: Column) -> Column:
    """Fill ``{query}`` with the form-encoded query (``*`` escaped, ``~`` not)."""
    return F.replace(template, F.lit("{query}"), encoded(query))


# The search addresses of the known sites.
SEARCH_TEMPLATES = {
    "ickey": ["https://search.ickey.cn/?keyword={query}"],
    "szlcsc": ["https://so.szlcsc.com/global.html?k={query}"],
    "ti": ["https://www.ti.com/sitesearch/en-us/docs/universalsearch.tsp?searchTerm={query}"],
}


def search_urls(site: str, query: Column) -> Column:
    """Array of a site's search URLs; a site that no profile knows raises."""
    key = site.strip().lower()
    if key not in SEARCH_TEMPLATES:
        raise ValueError(f"unknown site: {site}; known: {', '.join(SEARCH_TEMPLATES)}")
    return F.array(*[search_url(F.lit(t), query) for t in SEARCH_TEMPLATES[key]])


def is_catalog_url(url: Column, domain: str, path: str) -> Column:
    """Whether the host is ``domain`` or under it, and the whole path is like the pattern ``path``."""
    host = host_of(url)
    return F.coalesce(((host == domain) | host.endswith(f".{domain}")) & F.coalesce(part(url, "PATH"), F.lit("")).rlike(f"^(?:{path})$"), F.lit(False))
