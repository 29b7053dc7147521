"""Structured Streaming forms of dedup, appending, upserts and pagination."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sievewright.operators.state import shared_folder


def to_table(stream: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Run a stream over all that is there (availableNow) into Parquet and read the result; exactly once by the sink's commit log."""
    spark = stream.sparkSession
    path = path or f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    writer: DataStreamWriter = stream.writeStream.format("parquet").outputMode("append")
    query = writer.option("path", f"{path}/data").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def deduplicated(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """First row per key; with an event time the state is bounded by the delay, else it keeps every key."""
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def upserted(stream: DataFrame, path: str, state: str) -> None:
    """Append each micro-batch with its number to a journal; compaction then keeps the latest row per key."""

    def put(batch: DataFrame, epoch: int) -> None:
        # A batch that is run again overwrites its own partition.
        batch.write.mode("overwrite").parquet(f"{path}/ingest_seq={epoch}")

    stream.writeStream.foreachBatch(put).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


PAGE_OUT = "category bigint, page_no bigint, n_items bigint, seen bigint, stop_reason string, anomaly boolean"


def paginated(stream: DataFrame) -> DataFrame:
    """The page-number state machine over a stream of (category, page_no, n_items, page_size, total_count, signature).

    Each category keeps the pages seen, the running count, the last total and its
    signatures; pages after the stop are dropped. The pages of a micro-batch are taken in order.
    """

    def step(key, frames: Iterator[pd.DataFrame], state):
        seen, total, stopped, signatures = state.get if state.exists else (0, None, False, [])
        signatures, rows = set(signatures), []
        for p in pd.concat(list(frames)).sort_values("page_no").itertuples():
            if stopped:
                continue
            reason = None
            if p.signature is not None and p.signature in signatures:
                rows.append((key[0], p.page_no, p.n_items, seen + p.n_items, "repeated_page_signature", True))
                stopped = True
                continue
            if p.signature is not None:
                signatures.add(p.signature)
            seen += int(p.n_items)
            total = int(p.total_count) if p.total_count is not None and p.total_count == p.total_count else total
            if p.n_items == 0:
                reason = "empty_product_list"
            elif p.page_size and p.n_items < p.page_size:
                reason = "returned_count_less_than_page_size"
            stopped = reason is not None
            rows.append((key[0], p.page_no, p.n_items, seen, reason, bool(stopped and total is not None and seen < total)))
        state.update((seen, total, stopped, sorted(signatures)))
        yield pd.DataFrame(rows, columns=["category", "page_no", "n_items", "seen", "stop_reason", "anomaly"])

    return stream.groupBy("category").applyInPandasWithState(step, PAGE_OUT, "seen bigint, total bigint, stopped boolean, signatures array<string>", "append", "NoTimeout")


def event_counts(stream: DataFrame, event_time: str, key: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Tumbling counts per key; a window is emitted once the watermark has passed it."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), key).agg(F.count("*").alias("n"))
