"""The queries of the text operators, gathered by name."""

from __future__ import annotations

from sievewright.llm import classify_queries, corpus_queries, dedup_queries, lm_queries, quality_queries, warc_queries

MODULES = [classify_queries, corpus_queries, dedup_queries, lm_queries, quality_queries, warc_queries]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
