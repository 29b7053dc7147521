"""Identity keys and the dedup rules over them. Five keys exist and stay apart."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.text import first_present, identity_text, stripped
from sievewright.functions.urls import canonical_product_url


def _tagged(tag: str, c: Column) -> Column:
    v = identity_text(c)
    return F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(tag), v))


def seed_identity(sku: Column, product_id: Column, url: Column) -> Column:
    """``sku:``, else ``product_id:``, else ``url_sha256:`` of the canonical URL; null if there is none."""
    hashed = F.when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit("url_sha256:"), F.sha2(canonical_product_url(url), 256)))
    return F.coalesce(_tagged("sku:", sku), _tagged("product_id:", product_id), hashed)


def identity_method(key: Column) -> Column:
    return F.when(key.startswith("sku:"), "sku").when(key.startswith("product_id:"), "product_id").when(key.startswith("url_sha256:"), "url_hash").otherwise("missing")


def search_key(model: Column, sku: Column, url: Column, title: Column) -> Column:
    return F.upper(stripped(F.coalesce(first_present(model, sku, url, title), F.lit(""))))


def parse_key(site: Column, key: Column, url: Column) -> Column:
    return F.upper(F.concat_ws("|", F.coalesce(site, F.lit("")), F.coalesce(key, F.lit("")), F.coalesce(url, F.lit(""))))


def validation_key(product_id: Column, raw_id: Column, sku: Column, model: Column, url: Column, row: Column) -> Column:
    return F.coalesce(first_present(product_id, raw_id, sku, model, url), F.concat(F.lit("__MISSING_KEY__:"), row.cast("string")))


def category_key(identifier: Column, url: Column, parent: Column, name: Column) -> Column:
    ident, canon = stripped(F.coalesce(identifier, F.lit(""))), canonical_product_url(url)
    hashed = F.concat(F.lit("name:"), F.sha2(F.concat(F.coalesce(parent, F.lit("")), F.lit("|"), F.coalesce(name, F.lit(""))), 256))
    return F.when(ident != "", F.concat(F.lit("id:"), ident)).when(F.coalesce(url, F.lit("")) != "", F.concat(F.lit("url:"), canon)).otherwise(hashed)


def one_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The whole row that ``order`` puts first for each key.

    min over a struct of order and row aggregates map-side, so a key that very many rows
    share reaches its reducer once for each map task; a ranking window would sort all of
    its rows in one task.
    """
    ranks = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*ranks))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def first_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return one_per_key(df, keys, F.col(ordinal))


def last_wins(df: DataFrame, keys: list[str], *ordinals: Column) -> DataFrame:
    """Compaction: the latest record of each key; rows with a null key drop out."""
    best = F.max_by(F.struct(*[c for c in df.columns if c not in keys]), F.struct(*ordinals))
    keyed = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    rest = [c for c in df.columns if c not in keys]
    return keyed.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def most_complete(df: DataFrame, keys: list[str], weight: Column, ordinal: Column) -> DataFrame:
    """The row of most weight, the first of a tie."""
    return one_per_key(df, keys, -weight, ordinal)


def distinct_in_order(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Keys once, with the place of their first occurrence."""
    return df.groupBy(*keys).agg(F.min(ordinal).alias(ordinal))


def set_signature(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """SHA-256 of the sorted distinct values of each group (as texts, without nulls and empty ones), joined by line feeds; empty without values.

    Values are made distinct before a group comes together, so a group is as large as its set.
    """
    distinct = df.select(*group, F.nullif(F.col(value).cast("string"), F.lit("")).alias("_v")).distinct()
    values = F.array_sort(F.collect_list("_v"))
    signed = F.when(F.size(values) > 0, F.sha2(F.array_join(values, "\n"), 256)).otherwise("")
    return distinct.groupBy(*group).agg(signed.alias("signature"), F.count("_v").alias("n_distinct"))


def batch_numbers(df: DataFrame, group: list[str], order: list[str], size: int, shards: int = 64) -> DataFrame:
    """As ``batches``, for groups that one task should not hold: ranges of the order are counted, then numbered apart.

    A group is cut by quantiles of its first order column, a number.
    """
    places = F.array(*[F.lit(k / shards) for k in range(1, shards)])
    cuts = df.groupBy(*group).agg(F.percentile_approx(order[0], places, F.lit(10_000)).alias("_cuts"))
    dealt = df.join(cuts, group).withColumn("_shard", F.size(F.filter("_cuts", lambda c: c < F.col(order[0])))).drop("_cuts")
    before = Window.partitionBy(*group).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*group, "_shard").count().select(*group, "_shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy(*group, "_shard").orderBy(*order))
    placed = dealt.withColumn("_n", number).join(offsets, [*group, "_shard"])
    return placed.withColumn("batch", F.floor((F.col("_before") + F.col("_n") - 1) / size).cast("long")).drop("_shard", "_n", "_before")


def fingerprint(plan: dict) -> str:
    """SHA-256 of a plan's JSON with sorted keys and no blanks."""
    return hashlib.sha256(json.dumps(plan, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def batches(df: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """Number the rows of each group in order and cut them into batches of ``size``."""
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("batch", F.floor((number - 1) / size).cast("long"))
