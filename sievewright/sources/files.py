"""Captured files as tables: JSON, JSON lines, id lists, sitemaps, robots rules."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sievewright.functions import urls


def _or_empty(spark: SparkSession, schema: str, load) -> DataFrame:
    """An empty table for a path that is not there; every other error is raised."""
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A whole JSON file (an array or an object); a missing path is empty."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).option("multiLine", True).json(path))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lenient JSON lines: blank and undecodable lines are left out; a missing path is empty."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path))


def strict_json_lines(spark: SparkSession, path: str, schema: str, site_key: str | None = None) -> DataFrame:
    """Strict JSON lines: a bad line fails the job and is quoted; lines that are no objects are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    checked = F.when(F.try_parse_json("value").isNull(), F.raise_error(F.concat(F.lit("bad JSON line: "), F.substring("value", 1, 80)))).otherwise(F.col("value"))
    rows = lines.select(checked.alias("value")).where(F.ltrim("value").startswith("{")).select(F.from_json("value", schema).alias("r")).select("r.*")
    return rows.where(F.col("site_key") == site_key) if site_key is not None else rows


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Captured responses: url, text, status_code, content_type, transport, elapsed_ms, headers."""
    return spark.read.schema("url string, text string, status_code int, content_type string, transport string, elapsed_ms int, headers map<string,string>").json(path)


def sitemap_locations(pages: DataFrame, text: str) -> DataFrame:
    """(ord, loc, category_id) of every ``loc`` in order, each once, forced to https; texts that are no XML have none."""
    locs = F.regexp_extract_all(F.col(text), F.lit(r"(?is)<(?:\w+:)?loc\s*>\s*(.*?)\s*</(?:\w+:)?loc\s*>"), 1)
    https = F.transform(locs, lambda u: F.regexp_replace(F.replace(u, F.lit("&amp;"), F.lit("&")), "^http://", "https://"))
    rows = pages.select(F.posexplode(F.array_distinct(https)).alias("ord", "loc"))
    return rows.withColumn("category_id", urls.category_id_of(F.col("loc")))


def robots_rules(text: Column) -> Column:
    """(directive, value) of a robots file in order; comments left out."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.btrim(F.regexp_replace(x, "#.*$", "")))
    return F.transform(
        F.filter(lines, lambda x: x.rlike(r"^[A-Za-z-]+\s*:")),
        lambda x: F.struct(F.lower(F.btrim(F.substring_index(x, ":", 1))).alias("directive"), F.btrim(F.regexp_replace(x, r"^[A-Za-z-]+\s*:", "")).alias("value")),
    )


def robots_sitemaps(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(robots_rules(text), lambda r: r["directive"] == "sitemap"), lambda r: r["value"]))


def robots_allowed(status: Column, text: Column, url: Column, agent: str = "*") -> Column:
    """404 allows all, any other error denies all, else the file's rules for the agent decide."""

    def ask(texts: pd.Series, links: pd.Series) -> pd.Series:
        known: dict = {}

        def one(t, u):
            if t not in known:
                known[t] = RobotFileParser()
                known[t].parse((t or "").splitlines())
            return known[t].can_fetch(agent, u or "")

        return pd.Series([one(t, u) for t, u in zip(texts, links)], dtype=bool)

    return F.when(status == 404, True).when(status >= 400, False).otherwise(F.pandas_udf(ask, "boolean")(text, url))


def api_failure(success: Column, message: Column) -> Column:
    """null for a good reply, ``token_expired`` or ``api_error``."""
    return F.when(~success, F.when(message.rlike("(?i)csrf|token|login"), "token_expired").otherwise("api_error"))


def api_products(replies: DataFrame, body: str, item_schema: str) -> DataFrame:
    """One row per product of list replies ``{success, msg, result: {total, products}}``, with the reply's total."""
    reply = F.from_json(F.col(body), f"success boolean, msg string, result struct<total:bigint, products:array<struct<{item_schema}>>>")
    opened = replies.withColumn("_r", reply)
    kept = [c for c in replies.columns if c != body]
    return opened.select(*kept, F.col("_r.result.total").alias("total"), F.explode("_r.result.products").alias("_p")).select(*kept, "total", "_p.*")
