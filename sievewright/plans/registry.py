"""All query modules of the library, gathered by name."""

from __future__ import annotations

from sievewright.plans import catalog_queries, merge_queries, product_queries, quality_queries, stream_queries

MODULES = [catalog_queries, merge_queries, product_queries, quality_queries, stream_queries]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
