"""Record merging: detail wins, full outer, layered, and the order-dependent fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.records import merged_maps
from sievewright.functions.text import present


def _pick(high: Column, low: Column, kind: str) -> Column:
    return merged_maps(F.coalesce(low, F.create_map()), F.coalesce(high, F.create_map())) if kind.startswith("map") else F.when(present(high, kind), high).otherwise(low)


def detail_wins(items: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Every item once per row, with the detail's non-empty values over its own; maps are merged key by key.

    ``details`` has one row per key (see identity.last_wins).
    """
    d = details.select(*[F.col(c).alias(f"_d_{c}") for c in details.columns])
    kinds = dict(items.dtypes) | dict(details.dtypes)
    joined = items.join(d, F.col(key) == F.col(f"_d_{key}"), "left")
    out = [F.col(key)]
    for c in dict.fromkeys([*items.columns, *details.columns]):
        if c != key:
            mine, theirs = c in items.columns, c in details.columns
            out.append((_pick(F.col(f"_d_{c}"), F.col(c), kinds[c]) if mine and theirs else F.col(c if mine else f"_d_{c}")).alias(c))
    return joined.select(out)


def outer_merge(items: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Keys of either side once, the detail's non-empty values first; in_items and in_details tell where from."""
    a = items.withColumn("_a", F.lit(True))
    b = details.select(*[F.col(c).alias(f"_d_{c}") for c in details.columns], F.lit(True).alias("_b"))
    kinds = dict(items.dtypes) | dict(details.dtypes)
    out = [F.coalesce(F.col(f"_d_{key}"), F.col(key)).alias(key)]
    for c in dict.fromkeys([*items.columns, *details.columns]):
        if c != key:
            mine, theirs = c in items.columns, c in details.columns
            out.append((_pick(F.col(f"_d_{c}"), F.col(c), kinds[c]) if mine and theirs else F.col(c if mine else f"_d_{c}")).alias(c))
    joined = a.join(b, F.col(key) == F.col(f"_d_{key}"), "full")
    return joined.select(*out, F.col("_a").isNotNull().alias("in_items"), F.col("_b").isNotNull().alias("in_details"))


def layered(kind: str, *layers: Column) -> Column:
    """The last layer that has a value; a later layer wins."""
    out = layers[0]
    for layer in layers[1:]:
        out = F.when(present(layer, kind), layer).otherwise(out)
    return out


def longest_text_fold(values: Column) -> Column:
    """Fold of an ordered array of texts: a later value replaces the one held if it is longer."""
    return F.aggregate(values, F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull() | (F.length(x) > F.length(acc)), x).otherwise(acc))


def first_number_fold(values: Column) -> Column:
    """Fold of an ordered array of numbers: the first that is there stays."""
    return F.aggregate(values, F.lit(None).cast("double"), lambda acc, x: F.coalesce(acc, x))


def fold_merge(df: DataFrame, key: str, order: list[str], folds: dict[str, str]) -> DataFrame:
    """Merge the rows of each key one after another; ``folds`` maps columns to ``longest``, ``first`` or ``last``.

    Reads as an ordered fold but needs no ordered list: longest is the earliest row of
    the greatest length, first and last the earliest and latest value, and each is a
    maximum over (rank, value) that aggregates map-side.
    """
    place = F.struct(*order)
    aggs = []
    for c, how in folds.items():
        v = F.col(c)
        there = v.isNotNull()
        if how == "longest":
            longest = F.max(F.when(there, F.length(v))).alias(f"_{c}_n")
            aggs += [F.min_by(v, F.when(there, F.struct((-F.length(v)).alias("n"), place.alias("p")))).alias(c), longest]
        else:
            by = F.min_by if how == "first" else F.max_by
            aggs.append(by(v, F.when(there, place)).alias(c))
    return df.groupBy(key).agg(*aggs, F.count("*").alias("n_rows")).select(key, *folds, "n_rows")
