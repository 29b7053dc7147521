"""Category trees, page sequences and the rules that end them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.urls import host_of


def page_outcomes(pages: DataFrame, category: str = "category", page: str = "page_no", mode: str = "page") -> DataFrame:
    """Follow each category's pages in order and mark the one that ends it.

    ``pages`` has a row per captured page: n_items, page_size, total_count, signature,
    next_cursor and next_url. Rows gain seen (running count, duplicates included), stop_reason
    (null: go on), anomaly (fewer seen than reported, or not advancing) and visited (at
    or before the first stop). The pages of one category share a task, as they are one
    sequence; their number is bounded by the category.
    """
    w = Window.partitionBy(category).orderBy(page)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    first_page = F.row_number().over(Window.partitionBy(category, "signature").orderBy(page)) > 1
    df = pages.withColumn("_repeat", F.col("signature").isNotNull() & first_page)
    df = df.withColumn("seen", F.sum("n_items").over(upto)).withColumn("_total", F.last("total_count", True).over(upto))
    short = (F.col("_total").isNotNull() & (F.col("seen") < F.col("_total")))
    first_next = F.first(F.struct("next_cursor", "next_url")).over(upto)
    auto = F.when(first_next["next_cursor"].isNotNull(), "cursor").when(first_next["next_url"].isNotNull(), "next_link").otherwise("page")
    kind = auto if mode == "auto" else F.lit(mode)
    reason = (
        F.when(F.col("_repeat"), "repeated_page_signature")
        .when(F.col("n_items") == 0, "empty_product_list")
        .when((F.col("page_size") > 0) & (F.col("n_items") < F.col("page_size")), "returned_count_less_than_page_size")
        .when((kind == "cursor") & F.col("next_cursor").isNull(), "missing_next_cursor")
        .when((kind == "cursor") & (F.col("next_cursor") == F.lag("next_cursor").over(w)), "cursor_not_advancing")
        .when((kind == "next_link") & F.col("next_url").isNull(), "next_link_or_control_absent")
        .when((kind == "next_link") & (F.col("next_url") == F.lag("next_url").over(w)), "next_url_not_advancing")
    )
    df = df.withColumn("stop_reason", reason)
    stuck = F.col("stop_reason").isin("repeated_page_signature", "cursor_not_advancing", "next_url_not_advancing")
    anomaly = F.when(F.col("stop_reason").isNull(), F.lit(False)).when(stuck, F.lit(True)).otherwise(short)
    stopped = F.count("stop_reason").over(before)
    return df.withColumn("anomaly", anomaly).withColumn("visited", F.coalesce(stopped, F.lit(0)) == 0).drop("_repeat", "_total")


def page_count(total: Column, size: Column) -> Column:
    """Pages for a total, one at least."""
    return F.greatest(F.ceil(F.try_divide(total.cast("double"), size)).cast("bigint"), F.lit(1).cast("bigint"))


def positive_int(value: Column, default: int) -> Column:
    """``value`` as an integer from 1, else the default."""
    n = value.try_cast("bigint")
    return F.when(n >= 1, n).otherwise(F.lit(default).cast("bigint"))


def tree_orders(tree: DataFrame) -> DataFrame:
    """key, parent, depth, path of a forest of (key, parent, ordinal), with bfs and dfs places among siblings.

    One equi-join per level, until no level has children: only the frontier joins, and
    a level as wide as the data stays distributed. dfs_path sorts like a stack that
    takes the last discovered child first; bfs order is (depth, path). A node with two parents
    stands under each; nodes that no root reaches are not there. More levels than nodes raise, for only a cycle makes them.
    """
    from sievewright.operators.state import kept_table

    nodes = tree.select("key", "parent", F.col("ordinal").cast("long").alias("ordinal"))
    level = nodes.where("parent is null").select("key", "parent", F.lit(0).alias("depth"), F.array("ordinal").alias("path"), F.array(-F.col("ordinal")).alias("dfs_path"))
    out = level = kept_table(level)
    depth, most = 0, nodes.count()
    while True:
        depth += 1
        up = level.select(F.col("key").alias("parent"), F.col("path").alias("_p"), F.col("dfs_path").alias("_d"))
        level = kept_table(nodes.join(up, "parent").select("key", "parent", F.lit(depth).alias("depth"), F.concat("_p", F.array("ordinal")).alias("path"), F.concat("_d", F.array(-F.col("ordinal"))).alias("dfs_path")))
        if level.isEmpty():
            return out
        if depth > most:
            raise ValueError("the tree has a cycle below a root")
        out = out.unionByName(level)


def traversal_mode(roots: DataFrame, wanted: str = "auto") -> str:
    """bfs from 20 roots on, if the choice is left open."""
    return wanted if wanted != "auto" else "bfs" if len(roots.limit(20).take(20)) >= 20 else "dfs"


def flattened(categories: DataFrame, *levels: str) -> DataFrame:
    """Leaves of nested category arrays with a non-empty id; each level is an array of structs named in ``levels``."""
    df = categories
    for name in levels:
        df = df.select(F.explode(name).alias("_x")).select("_x.*")
    return df.where("coalesce(id, '') <> ''")


def site_of(df: DataFrame, url: str, rules: DataFrame) -> DataFrame:
    """Join rows with the first site rule (domain, ordinal, site_key, site_type) whose domain is the host or a suffix of it.

    The host's suffixes are exploded, so that the suffix match is an equi-join that
    Spark may broadcast by measured size or shuffle; each host is matched once; unmatched rows are ``unknown``.
    """
    keyed = df.withColumn("_host", host_of(F.col(url)))
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hits = keyed.select("_host").distinct().select("_host", F.explode(suffixes).alias("domain")).join(rules, "domain")
    best = hits.groupBy("_host").agg(F.min_by(F.struct("domain", "site_key", "site_type"), "ordinal").alias("_rule"))
    return keyed.join(best, "_host", "left").select(
        *df.columns, F.col("_host").alias("host"), F.coalesce("_rule.site_key", F.lit("")).alias("site_key"),
        F.coalesce("_rule.site_type", F.lit("unknown")).alias("site_type"), F.coalesce("_rule.domain", F.lit("")).alias("matched_domain"),
    )
