"""Repeated passages by bucket-pointer refinement of sampled suffixes.

Suffixes fall into initial buckets by their leading q-gram; buckets are refined by the
bucket identifiers of later offsets until they agree in ``length`` bytes, each round
reusing the identifiers of the round before. Three things make that distributed:

* Only suffixes at anchors are bucketed: the leftmost least q-gram of each window of
  ``length`` bytes. Equal windows have the same anchor at the same place, so nothing is
  lost, and about one byte in fourteen is an anchor.
* Anchors whose bucket holds one document drop out before any text is sent. The
  others send the bytes around them; the bytes before an anchor are refined in the same
  way as those after it, and a window is a pair of a left and a right bucket.
* An anchor that very many documents share sends a hash for each window instead, which
  splits its bucket. Within a chunk of texts, equal surroundings are sent once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import chunked
from sievewright.llm import textbytes as tb

GRAM, BITS, HOT = 24, 48, 1000
SHARED, CONTEXT, WINDOW = 0, 1, 2


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and q-gram hashes of the anchors of all windows of ``length`` bytes that fit into a text."""
    n, width = len(data), length - GRAM + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = tb.running(data, tb.RAW)
    g = tb.mix((sums[GRAM:] - sums[: n + 1 - GRAM]) * tb.powers(n + 1)[1][: n + 1 - GRAM])
    bits = np.uint64(max(20, int(n).bit_length()))
    least = ((g >> bits) << bits) | np.arange(len(g), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[: n - length + 1], least[width - have : width - have + n - length + 1])
    fits = np.zeros(n + 1, np.int32)
    inner = np.diff(offsets) >= length
    np.add.at(fits, offsets[:-1][inner], 1)
    np.add.at(fits, offsets[1:][inner] - length + 1, -1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1)))[np.cumsum(fits)[: len(least)] > 0].astype(np.int64)
    at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
    return at, g[at]


class Chunk:
    """The anchors of a chunk and what it sends and hears about them."""

    def __init__(self, table: pa.Table, length: int, buckets: int):
        self.length, self.buckets, self.side = length, buckets, length - GRAM
        self.ids, self.data, self.offsets = chunked.texts_of(table)
        at, h = [], []
        for i, j in tb.slices(self.offsets):
            a, g = anchors(self.data[self.offsets[i] : self.offsets[j]], self.offsets[i : j + 1] - self.offsets[i], length)
            at.append(a + self.offsets[i])
            h.append(g)
        self.at = np.concatenate(at) if at else np.zeros(0, np.int64)
        keys = (np.concatenate(h) if h else np.zeros(0, np.uint64)) >> np.uint64(64 - BITS)
        self.doc = np.searchsorted(self.offsets, self.at, side="right") - 1
        self.keys, self.place = np.unique(keys, return_inverse=True)

    def send_keys(self, chunk: int) -> pa.Table:
        pairs = np.unique(np.stack([self.place, self.ids[self.doc]], 1), axis=0) if len(self.at) else np.zeros((0, 2), np.int64)
        docs = np.minimum(np.bincount(pairs[:, 0], minlength=len(self.keys)), 255).astype(np.uint8)
        return chunked.sent([(b, chunk, SHARED, chunked.pack(self.keys[s:e]), docs[s:e].tobytes()) for b, s, e in chunked.cut(self.keys, BITS, self.buckets)])

    def hear_keys(self, heard: pa.Table) -> None:
        """Keep the anchors whose bucket holds other documents, and find their surroundings, each once."""
        got = np.frombuffer(b"".join(a for _, a in chunked.gathered(heard, SHARED)), np.uint8)
        keep = got[self.place] > 0
        at, doc, place = self.at[keep], self.doc[keep], self.place[keep]
        left = np.minimum(at - self.offsets[doc], self.side)
        right = np.minimum(self.offsets[doc + 1] - at - GRAM, self.side)
        padded = np.concatenate([np.zeros(self.side, np.uint8), self.data, np.zeros(self.side, np.uint8)])
        around = np.empty((len(at), GRAM + 2 * self.side + 2), np.uint8)
        if len(at):
            around[:, :-2] = tb.take_bytes(padded, at, GRAM + 2 * self.side)
            cols = np.arange(self.side)
            around[:, : self.side][cols < (self.side - left)[:, None]] = 0
            around[:, -2 - self.side : -2][cols >= right[:, None]] = 0
        around[:, -2], around[:, -1] = left, right
        whole = np.ascontiguousarray(around).view(f"V{around.shape[1]}").ravel()
        # Texts are in order of doc_id, and anchors in order of texts: the first of equal surroundings has the least doc_id.
        _, first, self.same = np.unique(whole, return_index=True, return_inverse=True)
        order = np.argsort(place[first], kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        first, self.same = first[order], rank[self.same]
        self.around, self.key, self.first_doc = around[first], place[first], self.ids[doc[first]]
        self.hot = got[self.key] > 1
        self.occurs_at, self.occurs_doc = at, self.ids[doc]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes of the windows of hot anchors and the least document of each; for every window its hash's place, surroundings and shift."""
        rows = np.flatnonzero(self.hot)
        if not len(rows):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), rows, rows, rows
        flat = np.ascontiguousarray(self.around[rows, :-2])
        wide = flat.shape[1]
        sums = tb.running(flat.ravel(), tb.RAW)
        out = []
        for shift in range(self.side + 1):
            ok = np.flatnonzero((self.around[rows, -2] >= shift) & (self.around[rows, -1] >= self.side - shift))
            start = ok * wide + self.side - shift
            out.append((tb.span_hash(sums, start, start + self.length), rows[ok], np.full(len(ok), shift)))
        h, r, s = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((self.first_doc[r], h))
        h, r, s = h[order], r[order], s[order]
        distinct, first, same = np.unique(h, return_index=True, return_inverse=True)
        return distinct, self.first_doc[r][first], same, r, s

    def send_surroundings(self, chunk: int) -> pa.Table:
        rows, cold = [], np.flatnonzero(~self.hot)
        keys = self.keys[self.key[cold]]
        for b, s, e in chunked.cut(keys, BITS, self.buckets):
            # Columns one after another: like bytes stand together.
            body = np.ascontiguousarray(self.around[cold[s:e]]).tobytes()
            rows.append((b, chunk, CONTEXT, self.first_doc[cold[s:e]].tobytes(), body))
        h, least, *_ = self.windows()
        for b, s, e in chunked.cut(h, 64, self.buckets):
            rows.append((b, chunk, WINDOW, h[s:e].tobytes(), least[s:e].tobytes()))
        return chunked.sent(rows)

    def hear_surroundings(self, heard: pa.Table) -> np.ndarray:
        """For every byte: whether it is to go."""
        masks = np.zeros(len(self.key), np.uint64)
        cold = np.flatnonzero(~self.hot)
        masks[cold] = np.frombuffer(b"".join(a for _, a in chunked.gathered(heard, CONTEXT)), np.uint64)
        _, least, same, r, s = self.windows()
        gone = np.frombuffer(b"".join(a for _, a in chunked.gathered(heard, WINDOW)), np.uint8) > 0
        gone = gone[same] | (self.first_doc[r] > least[same])
        np.bitwise_or.at(masks, r[gone], np.uint64(1) << s[gone].astype(np.uint64))
        later = self.occurs_doc > self.first_doc[self.same]
        starts = np.zeros(len(self.data) + 1, bool)
        for shift in range(self.side + 1):
            fits = (self.around[:, -2] >= shift) & (self.around[:, -1] >= self.side - shift)
            gone = (masks >> np.uint64(shift)) & np.uint64(1) > 0
            hit = gone[self.same] | (later & fits[self.same])
            starts[self.occurs_at[hit] - shift] = True
        count = np.concatenate(([0], np.cumsum(starts)))[:-1]
        below = np.maximum(np.arange(1, len(self.data) + 1) - self.length, 0)
        return count[1:] > count[below]


def _share(table: pa.Table) -> pa.Table:
    """Which keys of a bucket more than one document holds (1), or very many (2)."""
    chunks, keys, docs = table.column("chunk").to_pylist(), [chunked.unpack(k) for k in chunked.opened(table.column("keys"))], chunked.opened(table.column("extra"))
    bucket = table.column("bucket")[0].as_py()
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.frombuffer(b"".join(docs), np.uint8))
    say = np.where(total >= HOT, 2, np.where(total > 1, 1, 0)).astype(np.uint8)[place]
    at = np.cumsum([0] + [len(k) for k in keys])
    return chunked.answers([(c, bucket, SHARED, say[a:b].tobytes()) for c, a, b in zip(chunks, at, at[1:])])


def _refine(length: int):
    side = length - GRAM

    def identify(ids: np.ndarray, more: np.ndarray, base: int) -> np.ndarray:
        """Bucket identifiers refined by those of one more offset."""
        return np.unique(ids * base + more, return_inverse=True)[1]

    def contexts(docs: np.ndarray, around: np.ndarray) -> np.ndarray:
        """For each surroundings the shifts at which an earlier document has the same window."""
        n = len(docs)
        masks = np.zeros(n, np.uint64)
        order = np.argsort(docs, kind="stable")
        docs, around = docs[order], around[order]
        gram = np.ascontiguousarray(around[:, side : side + GRAM]).view(np.uint64)
        bucket = np.zeros(n, np.int64)
        for k in range(gram.shape[1]):
            bucket = identify(bucket, np.unique(gram[:, k], return_inverse=True)[1], n)
        lone = np.bincount(bucket)[bucket] < 2
        live = np.flatnonzero(~lone)
        docs, around, bucket = docs[live], around[live], bucket[live].astype(np.int64)
        m = max(1, len(live))
        lefts, rights = [bucket], [bucket]
        for k in range(side):
            lefts.append(identify(lefts[-1], around[:, side - 1 - k].astype(np.int64), 256).astype(np.int64))
            rights.append(identify(rights[-1], around[:, side + GRAM + k].astype(np.int64), 256).astype(np.int64))
        out = np.zeros(len(live), np.uint64)
        for shift in range(side + 1):
            ok = np.flatnonzero((around[:, -2] >= shift) & (around[:, -1] >= side - shift))
            _, first, same = np.unique(lefts[shift][ok] * m + rights[side - shift][ok], return_index=True, return_inverse=True)
            gone = docs[ok] > docs[ok][first][same]
            out[ok[gone]] |= np.uint64(1 << shift)
        masks[order[live]] = out
        return masks

    def run(table: pa.Table) -> pa.Table:
        bucket, rows = table.column("bucket")[0].as_py(), []
        kinds, chunks = table.column("kind").to_numpy(), table.column("chunk").to_numpy()
        keys, extra = chunked.opened(table.column("keys")), chunked.opened(table.column("extra"))
        mine = np.flatnonzero(kinds == CONTEXT)
        if len(mine):
            docs = [np.frombuffer(keys[i], np.int64) for i in mine]
            around = np.frombuffer(b"".join(extra[i] for i in mine), np.uint8).reshape(-1, GRAM + 2 * side + 2)
            masks = contexts(np.concatenate(docs), around)
            at = np.cumsum([0] + [len(d) for d in docs])
            rows += [(int(chunks[i]), bucket, CONTEXT, masks[a:b].tobytes()) for i, a, b in zip(mine, at, at[1:])]
        mine = np.flatnonzero(kinds == WINDOW)
        if len(mine):
            h = [np.frombuffer(keys[i], np.uint64) for i in mine]
            docs = np.concatenate([np.frombuffer(extra[i], np.int64) for i in mine])
            both = np.concatenate(h)
            order = np.lexsort((docs, both))
            _, first, same = np.unique(both[order], return_index=True, return_inverse=True)
            gone = np.zeros(len(both), np.uint8)
            gone[order] = docs[order] > docs[order][first][same]
            at = np.cumsum([0] + [len(x) for x in h])
            rows += [(int(chunks[i]), bucket, WINDOW, gone[a:b].tobytes()) for i, a, b in zip(mine, at, at[1:])]
        return chunked.answers(rows)

    return run


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def repeated_passages(docs: DataFrame, length: int = 50, with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the text left over) for every row of ``docs`` (doc_id, text).

    The columns of ``carry`` go along unchanged.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a
    smaller doc_id; repeats within one document stay. Null and empty texts have no
    bytes; rows of one doc_id never remove each other's bytes; rows without a doc_id stay whole and remove nothing; other columns are ignored; an empty table gives an
    empty result. In ``kept``, bytes of a character that was cut are left out.
    """
    if not GRAM < length <= GRAM + 40:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 40}")
    carry = carry or []
    nameless = docs.where("doc_id is null")
    docs = docs.where("doc_id is not null")
    texts, buckets = chunked.in_chunks(docs, chunked.chunk_count(docs), carry), chunked.bucket_count(docs)

    def first(key, table):
        return Chunk(table, length, buckets).send_keys(key[0].as_py())

    def second(key, table, heard):
        c = Chunk(table, length, buckets)
        c.hear_keys(heard)
        return c.send_surroundings(key[0].as_py())

    def third(key, table, heard):
        c = Chunk(table, length, buckets)
        c.hear_keys(heard)
        gone = c.hear_surroundings(heard)
        n = np.diff(c.offsets)
        removed, spans, sha, kept = [], [], [], []
        for a, b in zip(c.offsets[:-1], c.offsets[1:]):
            g = gone[a:b]
            left = c.data[a:b][~g].tobytes()
            removed.append(int(g.sum()))
            spans.append(int((g[1:] & ~g[:-1]).sum() + g[:1].sum()))
            sha.append(hashlib.sha256(left).hexdigest())
            if with_text:
                kept.append(left.decode("utf-8", "ignore"))
        out = [pa.array(c.ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        rest = chunked.in_order(table)
        out += [pa.array(kept, pa.string())] * with_text + [rest.column(f"_carry_{k}") for k in range(len(carry))]
        return pa.table(out, names=names + ["kept"] * with_text + carry)

    schema = RESULT + ", kept string" * with_text + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    by_chunk = texts.groupBy("chunk")
    shared = by_chunk.applyInArrow(first, chunked.SENT).groupBy("bucket").applyInArrow(_share, chunked.ANSWER)
    masks = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(second, chunked.SENT).groupBy("bucket").applyInArrow(_refine(length), chunked.ANSWER)
    found = by_chunk.cogroup(shared.unionAll(masks).groupBy("chunk")).applyInArrow(third, schema)
    body = F.coalesce(F.col("text"), F.lit(""))
    none = F.lit(0).cast("long")
    whole = [F.lit(None).cast("long").alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(body.cast("binary"), 256).alias("kept_sha256")]
    return found.unionAll(nameless.select(*whole, *[body.alias("kept")] * with_text, *[F.col(f"`{c}`") for c in carry]))
