"""Counts, completeness, diagnosis and the decision that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.text import present

# Diagnosis codes and the words that give them, in the order tried.
ISSUE_MARKS = [
    ("rate_limited", ["429"]),
    ("anti_bot_or_access_denied", ["403", "captcha", "challenge"]),
    ("network_instability", ["timeout", "connection", "network"]),
    ("pagination_not_advancing", ["cursor", "pagination", "分页"]),
    ("page_structure_changed", ["selector", "parse", "解析"]),
]
# What to do about diagnoses: (codes of which one is enough, directives), in order.
DIRECTIVES = [
    (["catalog_or_detail_count_mismatch", "reported_total_not_reached"], ["replan_categories_and_pagination", "reset_unfinished_tasks"]),
    (["pagination_not_advancing"], ["switch_pagination_strategy"]),
    (["required_fields_incomplete"], ["refetch_incomplete_details"]),
    (["rate_limited"], ["slow_down_and_resume"]),
    (["anti_bot_or_access_denied"], ["switch_transport"]),
    (["page_structure_changed"], ["reanalyse_page_structure"]),
    (["network_instability"], ["retry_with_backoff"]),
]


def issue_code(text: Column) -> Column:
    """Diagnosis of an issue's whole text: the first group of marks that it holds."""
    low, out = F.lower(text), None
    for code, marks in ISSUE_MARKS:
        hit = F.lit(False)
        for m in marks:
            hit = hit | low.contains(m)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise("task_failure")


def http_failed(status: Column) -> Column:
    return status >= 400


def retryable(status: Column) -> Column:
    return (status == 429) | (status >= 500)


def missing_samples(df: DataFrame, key: str, fields: list[str], most: int = 20) -> DataFrame:
    """(field, n_missing, samples): all rows that lack a field are counted; the first ``most`` of their keys, in order, are its samples."""
    kinds = dict(df.dtypes)
    lacking = F.array_compact(F.array(*[F.when(~present(F.col(f), kinds[f]), F.lit(f)) for f in fields]))
    rows = df.select(key, F.explode(lacking).alias("field"))
    counts = rows.groupBy("field").agg(F.count("*").alias("n_missing"))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("field").orderBy(key))).where(F.col("_r") <= most)
    return counts.join(ranked.groupBy("field").agg(F.array_sort(F.collect_list(key)).alias("samples")), "field")


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n, n_present, completeness to six places, half to even); 0 for an empty table."""
    kinds = dict(df.dtypes)
    counts = df.agg(F.count("*").alias("_n"), *[F.count(F.when(present(F.col(f), kinds[f]), 1)).alias(f) for f in fields])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col("_n").alias("n"), F.col(f).alias("n_present")) for f in fields])).alias("r")
    ratio = F.bround(F.coalesce(F.try_divide(F.col("r.n_present").cast("double"), F.col("r.n")), F.lit(0.0)), 6)
    return counts.select(rows).select("r.field", "r.n", "r.n_present", ratio.alias("completeness"))


def count_report(saved: DataFrame, key: str, discovered: DataFrame, reported: DataFrame | None = None, failed: DataFrame | None = None, unfinished: DataFrame | None = None) -> DataFrame:
    """One row: saved, uniq, discovered, duplicates and the booleans of the count checks.

    Distinct keys are counted after map-side dedup, so frequent keys are no hot spot.
    """
    parts = [saved.select(F.lit("saved").alias("what"), F.col(key).alias("k"))]
    for df, name in ((discovered, "discovered"), (reported, "reported"), (failed, "failed"), (unfinished, "unfinished")):
        if df is not None:
            parts.append(df.select(F.lit(name).alias("what"), F.lit(None).cast(saved.schema[key].dataType).alias("k")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    n = lambda name: F.count(F.when(F.col("what") == name, 1)).alias(name)
    one = rows.agg(n("saved"), F.count_distinct(F.when(F.col("what") == "saved", F.col("k"))).alias("uniq"), n("discovered"), n("reported"), n("failed"), n("unfinished"))
    if reported is None:
        one = one.withColumn("reported", F.lit(None).cast("bigint"))
    return one.select(
        "*", (F.col("saved") - F.col("uniq")).alias("duplicates"),
        (F.col("saved") == F.col("discovered")).alias("saved_equals_discovered"),
        (F.col("uniq") == F.col("saved")).alias("unique_equals_saved"),
        (F.col("reported").isNull() | (F.col("reported") == F.col("saved"))).alias("reported_equals_saved"),
        (F.col("failed") == 0).alias("no_failed_tasks"),
        (F.col("unfinished") == 0).alias("no_unfinished_tasks"),
    )


def valid(report: DataFrame) -> DataFrame:
    """Add ``valid``: something saved and every count check true."""
    return report.withColumn("valid", (F.col("saved") > 0) & F.col("saved_equals_discovered") & F.col("unique_equals_saved") & F.col("reported_equals_saved") & F.col("no_failed_tasks") & F.col("no_unfinished_tasks"))


def decision(is_valid: Column, attempt: Column, most: int = 2) -> Column:
    """Publish, retry the whole workflow, or pause."""
    return F.when(is_valid, "complete").when(attempt < max(1, most), "diagnose_and_retry_workflow").otherwise("pause_task_and_report")


def directives(codes: Column) -> Column:
    """What the diagnoses of an array ask for, in a fixed order, each once; without any, keep what succeeded and rerun the rest."""
    table = [F.when(F.arrays_overlap(codes, F.array(*[F.lit(c) for c in some])), F.lit(d)) for some, ds in DIRECTIVES for d in ds]
    asked = F.array_distinct(F.array_compact(F.array(*table)))
    return F.when(F.size(asked) > 0, asked).otherwise(F.array(F.lit("keep_checkpoint_and_rerun_failed")))


def diagnoses(report: DataFrame, issues: DataFrame) -> DataFrame:
    """(code, task, url, message), each once: the failed count checks of a one-row report, then the issues (task, url, message) by their marks.

    ``report`` is count_report's row with n_incomplete, the number of products that lack
    required fields. A report of nothing saved without any of these is an empty_result.
    """
    checks = [
        ("catalog_or_detail_count_mismatch", ~F.col("saved_equals_discovered"), F.concat_ws(" ", F.lit("discovered"), "discovered", F.lit("saved"), "saved")),
        ("reported_total_not_reached", ~F.col("reported_equals_saved"), F.concat_ws(" ", F.lit("reported"), "reported", F.lit("saved"), "saved")),
        ("duplicate_products", ~F.col("unique_equals_saved"), F.concat_ws(" ", F.lit("duplicates"), "duplicates")),
        ("required_fields_incomplete", F.col("n_incomplete") > 0, F.concat_ws(" ", F.lit("incomplete"), "n_incomplete")),
        ("unfinished_tasks", ~F.col("no_unfinished_tasks"), F.concat_ws(" ", F.lit("unfinished"), "unfinished")),
    ]
    empty = F.lit("")
    row = lambda code, message: F.struct(F.lit(code).alias("code"), empty.alias("task"), empty.alias("url"), message.alias("message"))
    told = issues.select(*[F.coalesce(F.col(c), empty).alias(c) for c in ("task", "url", "message")])
    told = told.withColumn("code", issue_code(F.concat_ws(" ", "task", "url", "message"))).select("code", "task", "url", "message").distinct()
    failed = report.select(F.explode(F.array_compact(F.array(*[F.when(fails, row(code, m)) for code, fails, m in checks]))).alias("r")).select("r.*")
    some = failed.unionByName(told)
    quiet = some.limit(1).select(F.lit("empty_result").alias("code"))
    nothing = report.where("saved = 0").select(F.explode(F.array(row("empty_result", F.lit("nothing saved")))).alias("r")).select("r.*")
    return some.unionByName(nothing.join(quiet, "code", "left_anti"))


def run_status(n_ok: Column, n_failed: Column, n_pending: Column) -> Column:
    """paused while work is left; else complete, partial or failed."""
    return F.when(n_pending > 0, "paused").when((n_ok > 0) & (n_failed == 0), "complete").when(n_ok > 0, "partial").otherwise("failed")


def rolled_up_status(n_ok: Column, n_failed: Column) -> Column:
    return F.when((n_ok > 0) & (n_failed == 0), "success").when(n_ok > 0, "partial").otherwise("failed")
