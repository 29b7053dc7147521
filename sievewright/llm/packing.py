"""Packing: length buckets of least padding, and token-budget batches inside them.

Dynamic programming over the histogram of all lengths (distinct lengths only reach the
driver, whose number is bounded by the longest document, not by the rows) places the
bucket boundaries. A document is padded to its bucket's boundary, and a batch holds as
many rows as the token budget allows at that boundary. Rows are numbered within a bucket
by dealing it into shards, counting the shards and numbering within each, so that a
bucket with a third of all rows is no single task and still only its last batch is short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.staging import staged


def word_count(text: Column) -> Column:
    """Words of a text between blanks and 0x09 to 0x0D; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The at most ``buckets`` boundaries, the largest length last, that pad the least tokens in all.

    best[j] of a round is the least padding of the j shortest distinct lengths. With C
    and S the running sums of rows and of tokens, a bucket from i to j costs
    length[j] * (C[j] - C[i]) - (S[j] - S[i]): a line in length[j] for each i, so the
    minima come from a convex hull in linear time.
    """
    lengths = sorted(histogram)
    n = len(lengths)
    rows, tokens = [0], [0]
    for x in lengths:
        rows.append(rows[-1] + histogram[x])
        tokens.append(tokens[-1] + x * histogram[x])
    best: list[float] = [0] + [float("inf")] * n
    back: list[list[int]] = []
    for _ in range(min(buckets, n)):
        hull: list[tuple[int, float, int]] = []  # slope, intercept, i
        at, now, came = 0, [float("inf")] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if best[j - 1] < float("inf"):
                m, b = -rows[j - 1], best[j - 1] + tokens[j - 1]
                while len(hull) - at > 1 and (b - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - m):
                    hull.pop()
                hull.append((m, b, j - 1))
            x = lengths[j - 1]
            while len(hull) - at > 1 and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            if len(hull) > at:
                now[j] = hull[at][0] * x + hull[at][1] + x * rows[j] - tokens[j]
                came[j] = hull[at][2]
        now[0] = 0
        best, back = now, back + [came]
    out, j = [], n
    for came in reversed(back):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = came[j]
    return out[::-1]


def pack(docs: DataFrame, length: Column, buckets: int = 16, budget: int = 65536, rows_a_shard: int = 20_000) -> DataFrame:
    """doc_id, n_tokens, bucket, boundary, batch_id, place and padding for every row of ``docs``.

    Bucket numbers start at 0 with the shortest; batch_id counts through all buckets. A
    document longer than the budget has a batch of its own. Null lengths count as 0;
    ties and repeated rows are ordered by doc_id and length; other columns are ignored;
    an empty table gives an empty result.
    """
    sizes = staged(docs.select("doc_id", F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens")), "lengths")
    histogram = {r[0]: r[1] for r in sizes.groupBy("n_tokens").count().collect()}
    edges = boundaries(histogram, buckets)
    if not edges:
        return sizes.selectExpr("doc_id", "n_tokens", "0 as bucket", "0L as boundary", "0L as batch_id", "0L as place", "0L as padding")
    inside, low = [0] * len(edges), 0
    for x in sorted(histogram):
        while x > edges[low]:
            low += 1
        inside[low] += histogram[x]
    capacity = [max(1, budget // max(1, e)) for e in edges]
    start = [0]
    for n, c in zip(inside, capacity):
        start.append(start[-1] + -(-n // c))
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("bucket") + 1)
    bucket = F.lit(len(edges) - 1)
    for k in range(len(edges) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= edges[k], k).otherwise(bucket)
    shards = max(8, -(-sum(inside) // rows_a_shard))
    dealt = sizes.withColumn("bucket", bucket.cast("int")).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("bucket", "shard").count().select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens"))
    placed = dealt.withColumn("number", number).join(offsets, ["bucket", "shard"]).withColumn("at", F.col("offset") + F.col("number") - 1)
    return placed.select(
        "doc_id", "n_tokens", "bucket", pick(edges).alias("boundary"),
        (pick(start[:-1]) + F.floor(F.col("at") / pick(capacity))).cast("long").alias("batch_id"),
        (F.col("at") % pick(capacity)).cast("long").alias("place"),
        (pick(edges) - F.col("n_tokens")).alias("padding"),
    )
