"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are runs of letters and digits, with A-Z folded. The vector space has all terms of
a bounded labelled sample (at most ``MAX_EACH`` examples of each label); their document
frequencies count all documents. A term's weight grows with the chi-squared statistic of
its association with the label in the sample, and no term's falls below its TF-IDF.

Terms of more than one in ``OFTEN`` examples are products of dense matrices for ``QUERIES``
queries at once; they alone give each query a least similarity that its nearest examples
reach. The others stand in an inverted index whose lists are cut into blocks of examples, each with
its largest weight: a block is opened only if its bound reaches that similarity, so the
search is exact. Votes weigh by squared similarity, and isotonic regression on
leave-one-out votes, which the executors work out, calibrates them.

The examples have a fixed number, so the broadcast index grows with their texts only;
scoring the corpus is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm import textbytes as tb
from sievewright.llm.common import hashed_order

MAX_EACH, OFTEN, QUERIES, NEAREST, PULL, BLOCK = 3000, 16, 64, 15, 0.5, 32
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,toxic:int>>"


def _terms(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row of the slice, text within the slice, term hash) of all words."""
    data, offsets = tb.buffers(batch.column("text"))
    for i, j in tb.slices(offsets):
        _, _, hashes, first = tb.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tb.NOT_ALNUM)
        yield i, np.repeat(np.arange(j - i), np.diff(first)), hashes


class Vocabulary:
    """Sorted term hashes behind a bit table that most other words fail."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.hashes >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` of known terms, and their numbers."""
        at = np.flatnonzero(self.bits[hashes >> np.uint64(44)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        ok = self.hashes[k] == hashes[at]
        return at[ok], k[ok]


def _vectors(batch: pa.RecordBatch, vocabulary: Vocabulary) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, term numbers, counts) for the texts that have known terms."""
    size = max(1, len(vocabulary.hashes))
    for base, owner, hashes in _terms(batch):
        at, k = vocabulary.find(hashes)
        keys, counts = np.unique(owner[at].astype(np.int64) * size + k, return_counts=True)
        rows, first = np.unique(keys // size, return_index=True)
        for r, a, b in zip(rows, first, np.append(first[1:], len(keys))):
            yield base + int(r), keys[a:b] % size, counts[a:b]


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the spans, and the span of each."""
    size = ends - starts
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    return np.arange(total) + np.repeat(starts - upto + size, size), np.repeat(np.arange(len(size)), size)


@dataclass
class Index:
    """Normalised example vectors: a dense matrix of the frequent terms, an inverted index of the others."""

    hashes: np.ndarray
    idf: np.ndarray
    doc_ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray  # of the labels' shares in the whole over those in the sample
    prior: float
    examples: list = field(repr=False)  # (terms, counts)
    steps: tuple = ()  # calibration: thresholds and values

    def __post_init__(self):
        self.vocabulary = Vocabulary(self.hashes)
        n, t = len(self.examples), len(self.hashes)
        rows = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x, _ in self.examples]) if n else np.zeros(0, np.int32)
        vecs = [self.weigh(x, c) for x, c in self.examples]
        terms = np.concatenate([x for x, _ in self.examples]) if n else np.zeros(0, int)
        values = np.concatenate(vecs) if n else np.zeros(0)
        order = np.argsort(terms, kind="stable")
        rows, values, terms = rows[order], values[order], terms[order]
        often = np.bincount(terms, minlength=t) > max(1, n // OFTEN)
        self.place = np.where(often, np.cumsum(often) - 1, -1)
        self.dense = np.zeros((int(often.sum()), n))
        wide = often[terms]
        self.dense[self.place[terms[wide]], rows[wide]] = values[wide]
        self.rows, self.values, terms = rows[~wide], values[~wide], terms[~wide]
        # A list's run of examples of one block: its first posting, its block and its largest weight.
        cut = np.ones(len(terms), bool)
        cut[1:] = (terms[1:] != terms[:-1]) | (self.rows[1:] // BLOCK != self.rows[:-1] // BLOCK)
        self.starts = np.append(np.flatnonzero(cut), len(terms))
        self.blocks = self.rows[cut] // BLOCK
        self.most = np.maximum.reduceat(self.values, self.starts[:-1]) if len(terms) else np.zeros(0)
        self.at = np.searchsorted(terms[cut], np.arange(t + 1))

    def __getstate__(self) -> dict:
        """What the lists are made of; they are made again where they are read, which is less to send."""
        flat = [np.concatenate([e[k] for e in self.examples]).astype(np.int32) if self.examples else np.zeros(0, np.int32) for k in (0, 1)]
        kept = ("hashes", "idf", "doc_ids", "labels", "weights", "prior", "steps")
        return {k: getattr(self, k) for k in kept} | {"flat": flat, "sizes": np.array([len(x) for x, _ in self.examples], int)}

    def __setstate__(self, state: dict) -> None:
        terms, counts = state.pop("flat")
        cut = np.cumsum(state.pop("sizes"))[:-1]
        self.__dict__ |= state
        self.examples = list(zip(np.split(terms, cut), np.split(counts, cut))) if len(self.doc_ids) else []
        self.__post_init__()

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / max(1e-12, np.sqrt((w * w).sum()))

    def cosines(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST + 1) -> np.ndarray:
        """Of every query (terms, counts) with every example; exact wherever it may be among the k largest, and never too large elsewhere."""
        n = len(self.doc_ids)
        weights, wide = [self.weigh(x, c) for x, c in queries], np.zeros((len(queries), len(self.dense)))
        for q, ((x, _), w) in enumerate(zip(queries, weights)):
            often = self.place[x] >= 0
            wide[q, self.place[x[often]]] = w[often]
        out = wide @ self.dense
        bounds = np.maximum.reduceat(out, np.arange(0, n, BLOCK), axis=1) if n else out
        for q, ((x, _), w) in enumerate(zip(queries, weights)):
            runs, each = _spans(self.at[x], self.at[x + 1])
            if not len(runs):
                continue
            w = w[each]
            bound = bounds[q] + np.bincount(self.blocks[runs], self.most[runs] * w, bounds.shape[1])
            least = np.partition(out[q], -k)[-k] - 1e-8 if n > k else -1.0
            opened = (bound >= least)[self.blocks[runs]]
            runs, w = runs[opened], w[opened]
            at, each = _spans(self.starts[runs], self.starts[runs + 1])
            out[q] += np.bincount(self.rows[at], self.values[at] * w[each], n)
        return out

    def best(self, cosines: np.ndarray, skip: int = -1, k: int = NEAREST) -> list[tuple[float, int]]:
        """The k examples of largest cosine (above 0), ties by place; ``skip`` is left out."""
        if skip >= 0:
            cosines[skip] = 0
        least = np.partition(cosines, -k)[-k] - 1e-8 if len(cosines) > k else 0
        hits = sorted((-round(float(cosines[r]), 9), int(r)) for r in np.flatnonzero((cosines > 0) & (cosines >= least)))
        return [(-s, r) for s, r in hits[:k]]

    def nearest(self, terms: np.ndarray, counts: np.ndarray, skip: int = -1, k: int = NEAREST) -> list[tuple[float, int]]:
        return self.best(self.cosines([(terms, counts)])[0], skip, k)

    def vote(self, near: list[tuple[float, int]]) -> float:
        s = np.array([x * x * self.weights[self.labels[r]] for x, r in near])
        y = np.array([self.labels[r] for _, r in near])
        return float(((s * y).sum() + PULL * self.prior) / (s.sum() + PULL))

    def left_out(self, low: int, high: int) -> list[tuple[float, int]]:
        """Votes of some examples by all the others."""
        out = []
        for base in range(low, high, QUERIES):
            some = self.examples[base : min(high, base + QUERIES)]
            for r, cosines in enumerate(self.cosines(some), base):
                out.append((round(self.vote(self.best(cosines, skip=r)) if len(self.examples[r][0]) else self.prior, 6), r))
        return out

    def calibrate(self, got: list[tuple[float, int]]) -> None:
        """Isotonic regression (pool adjacent violators) of the labels on leave-one-out votes."""
        got.sort()
        pools: list[list[float]] = []  # weight, weighted positives, first and last vote
        for v, r in got:
            w = self.weights[self.labels[r]]
            if pools and pools[-1][3] == v:
                pools[-1][0] += w
                pools[-1][1] += w * self.labels[r]
            else:
                pools.append([w, w * self.labels[r], v, v])
            while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
                w, p, _, last = pools.pop()
                pools[-1][0] += w
                pools[-1][1] += p
                pools[-1][3] = last
        self.steps = (np.array([(p[2] + p[3]) / 2 for p in pools]), np.array([(p[1] + 2 * self.prior) / (p[0] + 2) for p in pools]))

    def scores(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[tuple[float, int]]]]:
        for cosines in self.cosines(queries):
            near = self.best(cosines)
            v = self.vote(near)
            yield (float(np.interp(v, *self.steps)) if self.steps and len(self.steps[0]) else self.prior), near


def _bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, counts = [b""] * batch.num_rows, [b""] * batch.num_rows
        for base, owner, hashes in _terms(batch):
            cut = np.searchsorted(owner, np.arange(owner[-1] + 2)) if len(owner) else [0]
            for d in range(len(cut) - 1):
                u, c = np.unique(hashes[cut[d] : cut[d + 1]], return_counts=True)
                terms[base + d], counts[base + d] = u.tobytes(), c.astype(np.int32).tobytes()
        yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "y"]).columns, tb.binary_column(terms), tb.binary_column(counts)], ["doc_id", "y", "terms", "counts"])


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In one task over the bounded sample: its terms, their chi-squared statistics, and the examples in them."""
    rows = sorted((r["doc_id"], r["y"], r["terms"], r["counts"]) for b in batches for r in b.to_pylist())
    bags = [(i, y, np.frombuffer(t, np.uint64), np.frombuffer(c, np.int32)) for i, y, t, c in rows]
    y = np.array([b[1] for b in bags], int)
    terms, place = np.unique(np.concatenate([b[2] for b in bags]) if bags else np.zeros(0, np.uint64), return_inverse=True)
    owner = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags]) if bags else np.zeros(0, int)
    n, pos = max(1, len(bags)), max(1, y.sum())
    a = np.bincount(place, y[owner], len(terms)) if len(terms) else np.zeros(0)
    df = np.bincount(place, minlength=len(terms)).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = n * (a * n - df * pos) ** 2 / (df * (n - df) * pos * max(1, n - pos))
    chi2[~np.isfinite(chi2) | (df < 4)] = 0
    cut = np.concatenate(([0], np.cumsum([len(b[2]) for b in bags]))).astype(int)
    out = [(i, label, place[cut[k] : cut[k + 1]].astype(np.int32), c) for k, (i, label, _, c) in enumerate(bags)]
    yield pa.RecordBatch.from_arrays([tb.binary_column([pickle.dumps((terms, chi2, out))])], ["model"])


def train(documents: DataFrame, labels: DataFrame, usable: Column, max_each: int = MAX_EACH) -> Index:
    """Index the labelled rows where ``usable`` (over ``_id``) holds: at most ``max_each`` of each label, first in a hashed order.

    A text that occurs again under the label stands once, under its smallest doc_id. Rows without
    a label or a doc_id are left out; null and empty texts are examples without terms; without labelled
    rows the index is empty and every score is the prior.
    """
    wanted = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("_id").isNotNull() & usable)
    share = dict(map(tuple, wanted.groupBy("y").count().collect()))
    ids = [wanted.where(F.col("y") == y).orderBy(hashed_order(F.col("_id")), "_id").limit(max_each) for y in (0, 1)]
    sample = documents.select("doc_id", "text").join(F.broadcast(ids[0].unionAll(ids[1])), F.col("doc_id") == F.col("_id"))
    same = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    sample = sample.groupBy(same.alias("same"), "y").agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("r")).select("r.doc_id", "r.text", "y")
    got = sample.mapInArrow(_bag, "doc_id bigint, y int, terms binary, counts binary").repartition(1).mapInArrow(_select, "model binary").first()
    hashes, chi2, rows = pickle.loads(bytes(got["model"]))
    vocabulary = Vocabulary(hashes)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(vocabulary.hashes), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for base, owner, h in _terms(batch):
                at, k = vocabulary.find(h)
                df += np.bincount(np.unique(owner[at].astype(np.int64) * max(1, len(df)) + k) % max(1, len(df)), minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], n))], ["term", "n"])

    counted = documents.select("text").mapInArrow(frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(hashes) + 1)  # the last place has the number of documents
    df[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 0.1
    idf *= 1 + np.log1p(chi2)
    y = np.array([r[1] for r in rows], int)
    in_sample = [max(1, int((y == k).sum())) for k in (0, 1)]
    weights = np.array([share.get(k, 0) / in_sample[k] for k in (0, 1)])
    weights = weights / max(1e-9, weights[1]) if weights[1] else np.ones(2)
    prior = (share.get(1, 0) + 0.5) / (share.get(0, 0) + share.get(1, 0) + 1)
    index = Index(hashes, idf, np.array([r[0] for r in rows], np.int64), y, weights, prior, [(r[2], r[3]) for r in rows])
    del rows, got
    spark, n = documents.sparkSession, len(index.examples)
    shared = spark.sparkContext.broadcast(pickle.dumps(index))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shared.value)
        for batch in batches:
            got = [x for low in batch.column("id").to_pylist() for x in model.left_out(low * QUERIES, min(n, (low + 1) * QUERIES))]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in got], pa.float64()), pa.array([r for _, r in got], pa.int64())], ["vote", "row"])

    groups = -(-n // QUERIES)
    found = spark.range(0, groups, 1, min(64, max(1, groups))).mapInArrow(votes, "vote double, row bigint").collect()  # a row for each example
    shared.unpersist()
    index.calibrate([(r["vote"], r["row"]) for r in found])
    return index


def score(documents: DataFrame, index: Index) -> DataFrame:
    """doc_id, score and evidence (the three nearest examples) for every row of ``documents`` (doc_id, text).

    Texts without a known term, null and empty ones included, get the calibrated score of
    such examples and no evidence. Rows are scored one by one on their text alone; other
    columns are ignored; an empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(pickle.dumps(index))
    held: list[Index] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(pickle.loads(shared.value))
        model = held[0]
        blank, _ = next(model.scores([(np.zeros(0, int), np.zeros(0, int))]))
        for batch in batches:
            out, proof = np.full(batch.num_rows, blank), [[] for _ in range(batch.num_rows)]
            found = _vectors(batch, model.vocabulary)
            while some := list(islice(found, QUERIES)):
                for (row, _, _), (v, near) in zip(some, model.scores([(terms, counts) for _, terms, counts in some])):
                    out[row], proof[row] = v, [{"doc_id": int(model.doc_ids[r]), "similarity": s, "toxic": int(model.labels[r])} for s, r in near[:3]]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out), pa.array(proof, kind)], ["doc_id", "score", "evidence"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, score double, evidence {EVIDENCE}")
