"""Global counts for local readers: texts in chunks, keys in buckets, answers back to the chunks.

The texts are dealt by doc_id into chunks of a few MB. Each chunk sends its distinct
keys (hashes), sorted, delta-coded and cut into buckets by range, so a key that a
third of all rows hold is sent once for each chunk. A bucket adds up what all chunks
sent and answers in the order in which each chunk sent its keys. The chunk is then read
again from the same exchange, makes the same keys again and meets the answers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import textbytes as tb
from sievewright.llm.common import input_bytes

SENT = "bucket int, chunk bigint, kind int, keys binary, extra binary"
ANSWER = "chunk bigint, bucket int, kind int, answer binary"


def _groups(docs: DataFrame, least: int, share: int, most: int, at_least: int) -> int:
    """Groups of ``least`` bytes of input, larger ones (up to ``most``) on inputs of more than ``share`` of them.

    A row goes from each chunk to each bucket, so their numbers may not both grow with the input.
    """
    size = input_bytes(docs)
    return max(at_least, -(-size // min(most, max(least, size // share))))


def chunk_count(docs: DataFrame) -> int:
    return _groups(docs, 3 << 20, 1 << 12, 16 << 20, 4)


def bucket_count(docs: DataFrame, least: int = 1 << 20, at_least: int = 256) -> int:
    return _groups(docs, least, 1 << 14, 16 << 20, at_least)


def in_chunks(docs: DataFrame, chunks: int, carry: list[str] | None = None) -> DataFrame:
    """(chunk, doc_id, text) and the columns of ``carry``, as _carry_0 and so on."""
    rest = [F.col(f"`{c}`").alias(f"_carry_{k}") for k, c in enumerate(carry or [])]
    return docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("long").alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text", *rest)


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as their differences, byte planes one after another, without planes of zeros."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    planes = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(keys) > 1 else 1
    rest = np.ascontiguousarray(steps[1:].view(np.uint8).reshape(-1, 8).T[:planes])
    return bytes([planes]) + steps[:1].tobytes() + rest.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes, first = data[0], np.frombuffer(data[1:9], np.uint64)
    rest = np.frombuffer(data[9:], np.uint8).reshape(planes, -1)
    wide = np.zeros((rest.shape[1], 8), np.uint8)
    wide[:, :planes] = rest.T
    return np.cumsum(np.concatenate((first, wide.view(np.uint64).ravel())), dtype=np.uint64)


def bucket_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Range buckets of keys that have ``bits`` bits (32 at least)."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)


def cut(keys: np.ndarray, bits: int, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of the runs of sorted keys."""
    b = bucket_of(keys, bits, buckets)
    at = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, int)
    return [(int(b[s]), int(s), int(e)) for s, e in zip(at, np.append(at[1:], len(b)))]


def squeezed(data: bytes) -> bytes:
    """Zstandard, with the length in front: byte planes have little entropy, which the shuffle's own codec does not use."""
    return len(data).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True) if data else b""


def opened_one(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True) if data else b""


def opened(column: pa.ChunkedArray) -> list[bytes]:
    return [opened_one(x) for x in column.to_pylist()]


def sent(rows: list[tuple[int, int, int, bytes, bytes]]) -> pa.Table:
    cols = list(zip(*[(*r[:3], squeezed(r[3]), squeezed(r[4])) for r in rows])) if rows else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "kind", "keys", "extra"])


def answers(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """Rows for chunks, squeezed, and rows for none (-1) as they are."""
    cols = list(zip(*[(*r[:3], squeezed(r[3]) if r[0] >= 0 else r[3]) for r in rows])) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["chunk", "bucket", "kind", "answer"])


def gathered(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """(bucket, answer) of one kind in order of bucket, from the answers to a chunk."""
    mine = table.filter(pa.compute.equal(table.column("kind"), kind))
    return sorted(zip(mine.column("bucket").to_pylist(), opened(mine.column("answer"))))


def in_order(table: pa.Table) -> pa.Table:
    """A chunk in a fixed order."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if table.num_rows else table


def texts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, bytes and offsets of a chunk in that order."""
    table = in_order(table)
    data, offsets = tb.buffers(table.column("text"))
    return table.column("doc_id").to_numpy(), data, offsets


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes without the upper ones of zeros."""
    v = values.astype(np.uint64)
    n = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    return bytes([n]) + np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8).T[:n]).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    n = data[0]
    flat = np.frombuffer(data, np.uint8, offset=1).reshape(n, -1)
    wide = np.zeros((flat.shape[1], 8), np.uint8)
    wide[:, :n] = flat.T
    return wide.view(np.uint64).ravel()


def all_planes(parts: list[tuple[int, bytes]]) -> np.ndarray:
    return np.concatenate([unplanes(a) for _, a in parts]) if parts else np.zeros(0, np.uint64)
