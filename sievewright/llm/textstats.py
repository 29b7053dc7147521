"""Statistics of whole texts as Spark column expressions; nothing leaves the JVM.

A word is a maximal run of characters other than blank, tab, LF, VT, FF and CR.
Null texts count as empty. Every expression handles one row on its own, so there is no
shuffle, and memory is bounded by the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: The ratios that learners see, by name; each is a function of the counts below.
FEATURES = [
    "n_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "mark_ratio",
    "digit_ratio", "line_words", "distinct_ratio",
]


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and the counts behind FEATURES.

    n_repeat_words looks for 3-word windows by their 64-bit hash. A text whose windows
    are all different takes the short way (array_distinct in generated code); else the
    (hash, position) pairs are sorted, neighbours with equal hashes give the positions
    of repeated windows, and a fold adds up the words they cover.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("_words", F.array_remove(F.split(t, BLANKS), ""))
    df = df.withColumn("_n", F.size("_words"))
    df = df.withColumn(
        "_windows",
        F.when(F.col("_n") < 4, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.col("_n") - 3),
                lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
            )
        ),
    )
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size("_windows") > F.size(F.array_distinct("_windows")),
            F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twins = F.zip_with(
        F.col("_sorted"), F.slice("_sorted", 2, F.size("_sorted")),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    places = F.array_sort(F.array_distinct(F.flatten(F.array_compact(twins))))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    full_lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", full_lines)
    return df.select(
        "*",
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_sorted").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("[!?.,;:]")).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("n_digits"),
    ).drop("_words", "_n", "_windows", "_sorted", "_lines")


def feature_columns() -> dict[str, Column]:
    """FEATURES as columns over the counts; 0 where the denominator is 0."""

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0).cast("double")

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "upper_ratio": ratio("n_upper", "word_chars"),
        "mark_ratio": ratio("n_marks", "word_chars"),
        "digit_ratio": ratio("n_digits", "word_chars"),
        "line_words": ratio("n_words", "n_lines"),
        "distinct_ratio": ratio("n_distinct", "n_words"),
    }
