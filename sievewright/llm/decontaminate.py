"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits with A-Z folded. The n-grams of the test items are
counted over all documents; an item's seeds are its n-grams that are not far more
frequent than its middle one, so phrases that any text may hold start no alignment. A
document that shares a seed with an item is aligned with it around the shared places; the
score over that of a perfect match tells edited and paraphrased copies.

Test items travel as a broadcast table in blocks of at most ``BLOCK_WORDS`` words, so its
size is bounded; a larger benchmark takes more passes over the texts. Nothing is
shuffled but the counts of the seeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import textbytes as tb

GRAM, BLOCK_WORDS, COMMON = 4, 500_000, 20
MATCH, MISMATCH, GAP = 2, -1, -1
RESULT = "doc_id bigint, item_id bigint, similarity double, score int, n_seeds int, start_word int, end_word int, passage string"
_PLACE = np.random.default_rng(4).integers(0, 1 << 63, GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n-gram of a sequence of word hashes."""
    m = max(0, len(words) - n + 1)
    total = np.full(m, n, np.uint64)
    for k in range(n):
        total += words[k : k + m] * _PLACE[k]
    return tb.mix(total)


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: (score, start, end) in ``doc``; of equal scores the first end, and its latest start.

    A row per word of the item; the gaps within a row are a running maximum.
    """
    n = len(doc)
    steps = np.arange(n + 1) * -GAP
    above, above_from = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    place = np.arange(n + 1)
    for w in item:
        diagonal = above[:-1] + np.where(doc == w, MATCH, MISMATCH)
        h, origin = np.zeros(n + 1, np.int64), place.copy()
        up, up_from = above + GAP, above_from
        h[1:] = np.maximum(diagonal, 0)
        origin[1:] = np.where(diagonal > 0, above_from[:-1], place[1:])
        take = up > h
        h, origin = np.where(take, up, h), np.where(take, up_from, origin)
        # h[j] = max over k <= j of h[k] + GAP * (j - k)
        lifted = h + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, place, 0))
        h, origin = top - steps, origin[source]
        k = int(h.argmax())
        if h[k] > best[0]:
            best = int(h[k]), int(origin[k]), k
        above, above_from = h, origin
    return best


@dataclass
class Seeds:
    """Sorted seed hashes of each gram length with their items, and the items' words."""

    items: list[tuple[int, np.ndarray]]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # length: (hashes, item places), sorted by hash
    bits: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, np.ndarray]], keep: set[int] | None = None) -> Seeds:
        grams: dict[int, list] = {}
        for k, (_, words) in enumerate(items):
            n = min(GRAM, len(words))
            if n:
                for h in np.unique(gram_hashes(words, n)):
                    if keep is None or (k, int(h)) in keep:
                        grams.setdefault(n, []).append((int(h), k))
        bits, out = np.zeros(1 << 20, bool), {}
        for n, pairs in grams.items():
            pairs.sort()
            h = np.array([p[0] for p in pairs], np.uint64)
            out[n] = h, np.array([p[1] for p in pairs])
            bits[h >> np.uint64(44)] = True
        return cls(items, out, bits)

    def hits(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, text, word place, place in the seeds of that length) of the shared n-grams of a slice."""
        for n, (seeds, _) in self.grams.items():
            h = gram_hashes(words, n)
            at = np.flatnonzero(self.bits[h >> np.uint64(44)])
            k = np.searchsorted(seeds, h[at])
            ok = (k < len(seeds)) & (seeds[np.minimum(k, len(seeds) - 1)] == h[at])
            at, k = at[ok], k[ok]
            text = np.searchsorted(first, at, side="right") - 1
            inside = at + n <= first[text + 1] if len(at) else np.zeros(0, bool)
            yield n, text[inside], at[inside], k[inside]


def _slices(batch: pa.RecordBatch):
    data, offsets = tb.buffers(batch.column("text"))
    for i, j in tb.slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, hashes, first = tb.words(part, offsets[i : j + 1] - offsets[i], tb.NOT_ALNUM)
        yield i, part, starts, ends, hashes, first


def _item_words(rows) -> list[tuple[int, np.ndarray]]:
    out = []
    for item_id, text in rows:
        data, offsets = tb.buffers(pa.array([text or ""], pa.string()))
        out.append((item_id, tb.words(data, offsets, tb.NOT_ALNUM)[2]))
    return out


def _frequencies(docs: DataFrame, seeds: Seeds) -> dict[int, int]:
    """Documents with each n-gram of the items, by hash."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        total = {n: np.zeros(len(h), np.int64) for n, (h, _) in s.grams.items()}
        for batch in batches:
            for _, _, _, _, words, first in _slices(batch):
                for n, text, _, k in s.hits(words, first):
                    if len(k):
                        size = len(total[n])
                        total[n] += np.bincount(np.unique(text.astype(np.int64) * size + k) % size, minlength=size)
        for n, (h, _) in s.grams.items():
            at = np.flatnonzero(total[n])
            yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(total[n][at])], ["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"] & ((1 << 64) - 1): r["n"] for r in rows}


def _rare(items: list[tuple[int, np.ndarray]], df: dict[int, int]) -> set[tuple[int, int]]:
    """(item place, n-gram) of the seeds: frequency at most COMMON times the item's median."""
    keep = set()
    for k, (_, words) in enumerate(items):
        n = min(GRAM, len(words))
        grams = [int(h) for h in np.unique(gram_hashes(words, n))] if n else []
        counts = sorted(df.get(g, 0) for g in grams)
        if grams:
            limit = COMMON * max(1, counts[(len(counts) - 1) // 2])
            keep |= {(k, g) for g in grams if df.get(g, 0) <= limit}
    return keep


def _alignments(docs: DataFrame, seeds: Seeds, least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), []
            for base, data, starts, ends, words, first in _slices(batch):
                places: dict[tuple[int, int], list[int]] = {}
                for n, text, at, k in s.hits(words, first):
                    seeds_of, items = s.grams[n]
                    last = np.searchsorted(seeds_of, seeds_of[k], side="right") if len(k) else k
                    for t, a, lo, hi in zip(text.tolist(), at.tolist(), k.tolist(), last.tolist()):
                        for item in items[lo:hi]:
                            places.setdefault((t, int(item)), []).append(a)
                for (t, item), at in sorted(places.items()):
                    item_id, item_words = s.items[item]
                    reach, best = 2 * len(item_words), (0, 0, 0)
                    at.sort()
                    lo, spans = None, []
                    for a in at:  # places that are near share a span
                        b, e = max(int(first[t]), a - reach), min(int(first[t + 1]), a + reach + GRAM)
                        if lo is not None and b <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], e)
                        else:
                            spans.append((b, e))
                            lo = b
                    for b, e in spans:
                        score, x, y = align(words[b:e], item_words)
                        if score > best[0]:
                            best = score, b + x, b + y
                    similarity = best[0] / (MATCH * len(item_words))
                    if similarity >= least and best[2] > best[1]:
                        passage = data[starts[best[1]] : ends[best[2] - 1]].tobytes().decode("utf-8", "replace")
                        out.append((ids[base + t], item_id, similarity, best[0], len(at), best[1] - int(first[t]), best[2] - int(first[t]), passage))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            cols = list(zip(*out)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "similarity", "score", "n_seeds", "start_word", "end_word", "passage"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """RESULT: a row for each document and test item whose best alignment reaches ``least`` of a perfect one.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Items shorter than an
    n-gram are sought as a whole; null, empty and wordless items and texts match nothing. Repeated
    items with one item_id are told apart only by their scores; repeated documents give a row each. Other columns are ignored; an
    empty table on either side gives an empty result.
    """
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (4 * BLOCK_WORDS)))
    found = None
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        items = _item_words(sorted((r["item_id"], r["text"]) for r in rows if r["item_id"] is not None))
        df = _frequencies(docs, Seeds.of(items))
        part = _alignments(docs, Seeds.of(items, _rare(items, df)), least)
        found = part if found is None else found.unionAll(part)
    return found
