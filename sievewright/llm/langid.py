"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters of a text are folded (A-Z and Latin-1 capitals to small letters, all that is
no letter to a blank) and their 1- to ``ORDERS``-grams hashed to ``2**BITS`` features.
The term frequency is the share of a text's n-grams, and the inverse document frequency
counts every usable document. The weights are learned with follow-the-regularised-leader
(per-coordinate rates, elastic net) on a bounded sample, in one task on an executor; a
temperature fitted on a part of the sample calibrates the scores. As the frequency is a
share, a text's logits are a mean of table rows over its n-grams, so scoring is linear
in the text and needs no shuffle; the table has a fixed size, and so may be broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm import textbytes as tb
from sievewright.llm.common import hashed_order

BITS, ORDERS = 15, 3
SIZE = 1 << BITS
SCALE = 40.0
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    if not _FOLD:
        t = np.array([c if not 0xD800 <= c < 0xE000 and chr(c).isalpha() else 0x20 for c in range(1 << 16)], np.uint32)
        t[65:91] += 32
        t[[c for c in range(0xC0, 0xDF) if c != 0xD7]] += 32
        _FOLD.append(t)
    return _FOLD[0]


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the feature of every n-gram of a slice, SIZE where it would leave its text; and the texts' first places."""
    wide = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    first = lead[offsets]
    if len(wide) != first[-1]:  # not UTF-8: take bytes for characters
        wide, first = data.astype(np.uint32), offsets
    chars = np.where(wide < 1 << 16, _fold_table()[np.minimum(wide, (1 << 16) - 1)], wide).astype(np.uint64)
    h = chars + np.uint64(1)
    for order in range(1, ORDERS + 1):
        if order > 1:
            h = h * np.uint64(0x100000001B3)
            h[: -(order - 1)] += chars[order - 1 :] if len(chars) >= order else 0
        ids = ((h * np.uint64(0x9E3779B97F4A7C15 + 2 * order)) >> np.uint64(64 - BITS)).astype(np.int32)
        for back in range(1, order):
            at = first[1:] - back
            ids[at[at >= first[:-1]]] = SIZE
        yield ids, first


def _per_text(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, features of all its n-grams) for every text that has some."""
    data, offsets = tb.buffers(batch.column("text"))
    for i, j in tb.slices(offsets):
        if offsets[j] == offsets[i]:
            continue
        by_order = list(grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
        first = by_order[0][1]
        for d in range(j - i):
            ids = np.concatenate([x[first[d] : first[d + 1]] for x, _ in by_order])
            ids = ids[ids < SIZE]
            if len(ids):
                yield i + d, ids


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(SIZE, np.int64), 0
    seen = np.zeros(SIZE, bool)
    for batch in batches:
        n += batch.num_rows
        for _, ids in _per_text(batch):
            seen[:] = False
            seen[ids] = True
            df += seen
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n))], ["feature", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids, tf = [], [], []
        for row, f in _per_text(batch):
            u, c = np.unique(f, return_counts=True)
            rows.append(row)
            ids.append(u.astype(np.int32).tobytes())
            tf.append((c / len(f)).astype(np.float32).tobytes())
        picked = batch.select(["doc_id", "lang"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*picked.columns, tb.binary_column(ids), tb.binary_column(tf)], ["doc_id", "lang", "ids", "tf"])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> np.ndarray:
    """Weights (SIZE x classes) by follow-the-regularised-leader with per-coordinate rates."""
    z, n = np.zeros((SIZE, classes)), np.zeros((SIZE, classes))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for epoch in range(epochs):
        for r in np.random.default_rng(epoch).permutation(len(rows)):
            ids, x, y = rows[r]
            w = weights(z[ids], n[ids])
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / alpha
            z[ids] += g - sigma * w
            n[ids] += g * g
    return weights(z, n)


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    if not len(y):
        return 1.0
    loss = lambda s: -np.log(np.maximum(_softmax(logits / np.exp(s))[np.arange(len(y)), y], 1e-12)).mean()
    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass(frozen=True)
class Model:
    """table: per feature and language, inverse document frequency times weight over temperature; SIZE rows and one of zeros."""

    languages: tuple[str, ...]
    table: np.ndarray


def train(documents: DataFrame, usable: Column, max_each: int = 750) -> Model | None:
    """Learn from the rows where ``usable`` holds and lang and text are not null; None if there are none.

    Document frequencies count all those rows; the weights see at most ``max_each`` of each
    language, first in a fixed hashed order, so a rare language is learned like any other. Rows that repeat
    count each time and ties are broken by doc_id; columns other than doc_id, text and lang are not read.
    """
    rows = documents.select("doc_id", "text", "lang").where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    df = rows.select("text").mapInArrow(_count_documents, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = dict(map(tuple, df.collect()))
    total = counts.pop(-1, 0)
    if not total:
        return None
    idf = np.zeros(SIZE)
    at = np.fromiter(counts, int)
    idf[at] = np.log((1 + total) / (1 + np.fromiter(counts.values(), int))) + 0.1
    place = F.row_number().over(Window.partitionBy("lang").orderBy(hashed_order(F.col("_id")), "_id"))
    # The hash is uniform, so of n rows about four times as many as wanted lie below this bound; only these are ranked.
    bound = -(2.0**63) + 2.0**64 * F.least(F.lit(1.0), 4.0 * max_each / F.col("_n"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    few = rows.select(F.col("doc_id").alias("_id"), "lang").join(sizes, "lang").where(hashed_order(F.col("_id")).cast("double") <= bound)
    ids = few.withColumn("_place", place).where(F.col("_place") <= max_each).select("_id")
    sample = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi").mapInArrow(_sparse, "doc_id bigint, lang string, ids binary, tf binary")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r["doc_id"], r["lang"], r["ids"], r["tf"]) for b in batches for r in b.to_pylist())
        names = sorted({r[1] for r in got})
        data = []
        for _, lang, i, t in got:
            i = np.frombuffer(i, np.int32)
            data.append((i, SCALE * np.frombuffer(t, np.float32) * idf[i], names.index(lang)))
        held = data[::5]
        w = ftrl([r for k, r in enumerate(data) if k % 5], len(names)) if len(data) > 4 else ftrl(data, max(1, len(names)))
        t = temperature(np.array([x @ w[i] for i, x, _ in held]), np.array([y for *_, y in held])) if names else 1.0
        table = (SCALE * idf[:, None] * w / t).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(names)]), tb.binary_column([table.tobytes()])], ["names", "weights"])

    names, weights = sample.repartition(1).mapInArrow(fit, "names string, weights binary").first()
    names = tuple(json.loads(names))
    if not names:
        return None
    return Model(names, np.vstack([np.frombuffer(bytes(weights), np.float32).reshape(SIZE, -1), np.zeros((1, len(names)), np.float32)]))


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """Add lang_pred and score (probability of lang_pred) to ``documents``, whose other columns stay.

    Null texts and texts without a letter are ``und`` with score 0, as is everything
    without a model. Rows are judged one by one on their text alone; an empty table
    gives an empty result. The clash columns lang_pred and score are replaced.
    """
    columns = [c for c in documents.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in columns) + ", lang_pred string, score double"
    names, shared = (model.languages, documents.sparkSession.sparkContext.broadcast(model.table)) if model else ((), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            data, offsets = tb.buffers(batch.column("text"))
            for i, j in tb.slices(offsets) if names else ():
                if offsets[j] == offsets[i]:
                    continue
                total, count = np.zeros((j - i, len(names))), np.zeros(j - i)
                for ids, first in grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
                    some = np.flatnonzero(np.diff(first))
                    for k in range(len(names)):
                        total[some, k] += np.add.reduceat(shared.value[:, k].take(ids), first[some])
                    count[some] += np.add.reduceat((ids < SIZE).astype(np.int32), first[some])
                p = _softmax(total / np.maximum(count, 1)[:, None])
                best[i:j], score[i:j] = p.argmax(1), p.max(1)
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            pred = pa.array([names[b] if ok and b >= 0 else "und" for b, ok in zip(best, letter)], pa.string())
            score = np.where(letter & (best >= 0), score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pred, pa.array(score)], [*columns, "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter")
    return documents.select(*columns, letter).mapInArrow(run, schema)
