"""Whole jobs over captured data: a catalog run that is validated and published, and a search."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions import html, text
from sievewright.operators import identity, projections, quality, state
from sievewright.sources import sinks


@dataclass
class Outcome:
    """What a run ends with; status is published, paused or empty."""

    status: str
    attempts: int
    report: dict
    directives: list[str] = field(default_factory=list)


def catalog_run(pages: DataFrame, detail_pages: DataFrame, list_path: str = "$.products", required: tuple[str, ...] = ("title",)) -> tuple[DataFrame, DataFrame]:
    """(seeds, products) from captured list pages (url, text) and detail pages (url, text, status_code).

    JSON bodies give their list, HTML pages their product cards; the first seed of an
    identity wins, and its detail page, found by URL, is layered over it.
    """
    json_like = F.ltrim("text").rlike(r"^[\[{]")
    items = projections.list_items(pages.where(json_like).select("url", "text"), "text", list_path)
    cards = html.scanned(pages.where(~json_like).select("url", "text"), "text").drop("text")
    found = projections.seeds(items, "raw", "url").unionByName(projections.card_seeds(cards, "url"), allowMissingColumns=True)
    keyed = found.where("dedup_key is not null").select("url", "ord", *projections.SEED, "dedup_key", "dedup_method")
    seeds = state.kept_table(identity.one_per_key(keyed, ["dedup_key"], F.col("url"), F.col("ord")))
    scans = html.scanned(detail_pages.select(F.col("url").alias("detail_url"), "text", "status_code"), "text").drop("text")
    scans = identity.one_per_key(scans, ["detail_url"], F.col("status_code"))
    products = projections.details(seeds, scans, "detail_url", list(required))
    return seeds, products


def guarded(execute: Callable[[int], tuple[DataFrame, DataFrame]], categories: DataFrame, out: str, most: int = 2) -> Outcome:
    """Run, validate, publish; after a failure run the whole workflow again, and pause after the last.

    ``execute`` takes the number of the attempt and returns (seeds, products); only the
    one-row report comes to the driver.
    """
    for attempt in range(1, max(1, most) + 1):
        seeds, products = execute(attempt)
        products = state.kept_table(products)
        report = quality.valid(quality.count_report(products, "dedup_key", seeds, failed=products.where("fetch_status = 'failed'"))).first().asDict()
        if sinks.publish(report["valid"], categories, products, out):
            return Outcome("published", attempt, report)
    names = ["saved_equals_discovered", "reported_equals_saved", "unique_equals_saved", "no_failed_tasks"]
    codes = ["catalog_or_detail_count_mismatch", "reported_total_not_reached", "duplicate_products", "task_failure"]
    failed = [c for n, c in zip(names, codes) if not report[n]]
    asked = products.sparkSession.range(1).select(quality.directives(F.array(*[F.lit(c) for c in failed]) if failed else F.array().cast("array<string>"))).first()[0]
    return Outcome("paused" if report["saved"] else "empty", most, report, asked)


def search(records: DataFrame, query: str, top: int = 20, order: str = "ord") -> DataFrame:
    """The most relevant records of each site for a query: scored, merged by search key, ranked by score and first place.

    ``records`` has site, model, sku, title, detail_url and an ordinal.
    """
    scored = records.withColumn("score", text.relevance(F.lit(query), F.col("model"), F.col("sku"), F.col("title"))).where("score > 0")
    keyed = scored.withColumn("key", identity.parse_key(F.col("site"), identity.search_key(F.col("model"), F.col("sku"), F.col("detail_url"), F.col("title")), F.lit("")))
    best = identity.one_per_key(keyed, ["key"], -F.col("score"), F.col(order))
    rank = F.row_number().over(Window.partitionBy("site").orderBy(F.desc("score"), order))
    return best.withColumn("rank", rank).where(F.col("rank") <= top)
