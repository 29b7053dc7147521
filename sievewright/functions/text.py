"""String helpers as Column expressions; Python's Unicode white space is ``(?U)\\s`` here."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Availability markers in the order in which they are tried.
OUT_OF_STOCK = ["outofstock", "out_of_stock"]
IN_STOCK = ["instock", "in_stock"]
PRE_ORDER = ["preorder", "pre_order"]
# All columns that a request may ask for, and the words that stand for them.
ALL_FIELDS = ["model", "price", "stock", "package", "manufacturer", "sku", "title", "description", "moq", "attributes", "datasheet_url", "image_url"]
FIELD_WORDS = {
    "price": ["price", "价格", "报价"],
    "stock": ["stock", "库存", "现货"],
    "package": ["package", "封装", "包装"],
    "manufacturer": ["manufacturer", "maker", "厂商", "制造商", "品牌"],
    "model": ["model", "型号"],
    "sku": ["sku", "商品编号"],
    "title": ["title", "标题", "名称"],
    "description": ["description", "描述", "简介"],
    "moq": ["moq", "起订量", "最小采购量"],
    "attributes": ["attributes", "参数", "属性"],
    "datasheet_url": ["datasheet", "数据手册", "规格书"],
    "image_url": ["image", "图片"],
}
# Marks of a page without hits, and the shape of a part number.
NO_RESULTS = ["未找到", "没有找到", "无搜索结果", "no results", "couldn't find anything", "0 results"]
PART_NUMBER = r"[A-Za-z0-9][A-Za-z0-9._/+\-]{4,}"


def stripped(c: Column) -> Column:
    """Trim all Unicode white space, not blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def key_text(c: Column) -> Column:
    """Normalised key: lower case, a-z and 0-9 only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def compact_code(c: Column) -> Column:
    """Upper case, A-Z and 0-9 only."""
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def compact_loose(c: Column) -> Column:
    """Upper case without white space and hyphens; other signs stay."""
    return F.regexp_replace(F.upper(c), r"(?U)[\s-]", "")


def identity_text(c: Column) -> Column:
    """Trimmed, upper case, runs of white space as one blank."""
    return F.upper(F.regexp_replace(stripped(c), r"(?U)\s+", " "))


def _fold_aliases(values: pd.Series) -> pd.Series:
    def fold(v):
        if v is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKC", v).casefold() if c.isalnum() or c == "_")

    return values.map(fold)


def alias_text(c: Column) -> Column:
    """NFKC, case-folded, word characters only. Spark has no NFKC; inputs are small dimensions."""
    return F.pandas_udf(_fold_aliases, "string")(c)


def first_present(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cs])


def availability(c: Column) -> Column:
    """out_of_stock, in_stock, pre_order (tried in that order) or the text itself."""
    low = F.lower(c)

    def has(words: list[str]) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | low.contains(w)
        return out

    return F.when(has(OUT_OF_STOCK), "out_of_stock").when(has(IN_STOCK), "in_stock").when(has(PRE_ORDER), "pre_order").otherwise(c)


def availability_code(c: Column) -> Column:
    """Schema.org codes, case-sensitive, in-stock tried first; else unknown."""
    return F.when(c.contains("InStock"), "in_stock").when(c.contains("OutOfStock"), "out_of_stock").otherwise("unknown")


def cut_at(c: Column, *marks: str) -> Column:
    """The text before the first of each mark in turn, trimmed."""
    for m in marks:
        c = F.substring_index(c, m, 1)
    return stripped(c)


def without_count(c: Column) -> Column:
    """Drop a trailing count in ASCII or full-width brackets."""
    return stripped(F.regexp_replace(c, "[（(][\\d,，]+[）)]$", ""))


def slug_title(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("-"), F.lit(" ")))


def scraped(c: Column, pattern: str) -> Column:
    """First group of a fixed pattern, null if it is not there."""
    return blank_to_null(F.regexp_extract(c, pattern, 1))


def present(c: Column, kind: str) -> Column:
    """Neither null nor empty; 0 and false are present. ``kind`` is the column's simple type."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind.startswith(("array", "map")):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def query_of(text: Column) -> Column:
    """What a small request asks for; null if there is nothing.

    It stands after ``query:`` or else ``model:``, up to a line end, an ideographic full stop or a
    semicolon, without the list of fields; a text of one word is a query itself.
    """
    asked = lambda words: F.regexp_extract(text, rf"(?i)(?:{words})\s*[:：]\s*([^\n。；;]+)", 1)
    found = F.coalesce(blank_to_null(asked("查询|query")), blank_to_null(asked("型号|model")))
    cut = F.regexp_replace(found, r"(?is)\s*(?:需要|fields?)\s*[:：].*$", "")
    alone = stripped(text)
    return F.when(found.isNotNull(), blank_to_null(F.regexp_replace(cut, "^[ ,，.。]+|[ ,，.。]+$", ""))).when((alone != "") & ~alone.rlike(r"(?U)\s"), alone)


def canonical_fields(words: Column) -> Column:
    """Array of field names or words for them as the fields' names, each once; what no field knows drops out."""
    known = {w.lower(): f for f, ws in FIELD_WORDS.items() for w in ws} | {f: f for f in ALL_FIELDS}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.array_distinct(F.array_compact(F.transform(words, lambda w: F.try_element_at(table, F.lower(stripped(w))))))


def requested_fields(text: Column) -> Column:
    """The fields that a small request lists after ``fields:`` or ``需要:``; all of them if it lists none, none that is known, or all."""
    found = F.regexp_extract(text, r"(?i)(?:需要|fields?)\s*[:：]\s*([^\n。；;]+)", 1)
    every = F.array(*[F.lit(f) for f in ALL_FIELDS])
    some = canonical_fields(F.split(found, r"(?U)[,，、/\s]+"))
    return F.when((found == "") | F.lower(found).rlike("全部|所有|all") | (F.size(some) == 0), every).otherwise(some)


def no_results(text: Column) -> Column:
    """Whether a page's text says that nothing was found; white space is collapsed first."""
    low, out = F.lower(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(False)
    for mark in NO_RESULTS:
        out = out | low.contains(mark)
    return F.coalesce(out, F.lit(False))


def looks_part_number(c: Column) -> Column:
    """Five or more letters, digits and . _ / + -, the first a letter or digit."""
    return F.coalesce(stripped(c).rlike(f"^{PART_NUMBER}$"), F.lit(False))


def first_part_number(c: Column) -> Column:
    """The first part number in a text; empty if there is none."""
    return F.coalesce(F.regexp_extract(c, rf"(?U)\b({PART_NUMBER})\b", 1), F.lit(""))


def relevance(query: Column, *values: Column) -> Column:
    """100: equal, 80: the query within a value, 50: a value of five or more within the query, else 0; over compacted texts.

    A query that compacts to nothing is relevant to nothing.
    """
    q = compact_loose(F.coalesce(query, F.lit("")))
    score = F.lit(0)
    for v in values:
        x = compact_loose(F.coalesce(v, F.lit("")))
        one = F.when(x == "", 0).when(x == q, 100).when(x.contains(q), 80).when((F.length(x) >= 5) & q.contains(x), 50).otherwise(0)
        score = F.greatest(score, one)
    return F.when(q == "", 0).otherwise(score)
