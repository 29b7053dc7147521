"""Quality classifier: a sparse ensemble of conjunctive rules (after Friedman and Popescu's RuleFit).

Shallow gradient-boosted trees on a bounded labelled sample (``max_train_rows``) give
candidate rules, one for each path from a root; a lasso-penalised logistic regression
keeps few of them. The kept rules and weights become one Spark column expression, so
scoring the corpus is a projection in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import sample_of
from sievewright.llm.decision_list import Condition
from sievewright.llm.textstats import FEATURES, feature_columns, with_counts


@dataclass(frozen=True)
class Ensemble:
    """score = sigmoid(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def column(self) -> Column:
        columns = feature_columns()
        total = F.lit(self.bias)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for c in conditions:
                holds = holds & c.column(columns)
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for conditions, weight in self.rules:
            holds = np.ones(len(x), bool)
            for c in conditions:
                holds &= c.holds(x)
            total += weight * holds
        return 1 / (1 + np.exp(-total))


def _tree_paths(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: int, cuts: list[np.ndarray]):
    """Fit one regression tree on gradients; yields (path, leaf value or None, rows)."""
    todo = [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        best, gain = None, 1e-6
        if len(path) < depth and len(rows) >= 2 * least:
            g0, h0 = g[rows].sum(), h[rows].sum()
            for k in range(x.shape[1]):
                bins = np.searchsorted(cuts[k], x[rows, k], side="left")
                m = len(cuts[k]) + 1
                gl, hl, nl = (np.cumsum(np.bincount(bins, w, m))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                s = gl**2 / (hl + 1) + (g0 - gl) ** 2 / (h0 - hl + 1) - g0**2 / (h0 + 1)
                s[(nl < least) | (len(rows) - nl < least)] = -1
                if len(s) and s.max() > gain:
                    best, gain = (k, float(cuts[k][int(np.argmax(s))])), float(s.max())
        leaf = best is None
        yield path, (g[rows].sum() / (h[rows].sum() + 1) if leaf else None), rows
        if best:
            k, cut = best
            low = x[rows, k] <= cut
            todo += [(path + (Condition(FEATURES[k], False, cut),), rows[low]), (path + (Condition(FEATURES[k], True, cut),), rows[~low])]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, least: int = 10, rate: float = 0.3, penalty: float = 0.002, steps: int = 800) -> Ensemble:
    """Trees, rules, then lasso logistic weights by accelerated proximal gradient. One class only: its prior."""
    n = len(y)
    prior = (y.sum() + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    if n == 0 or y.min() == y.max():
        return Ensemble(bias, ())
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, 64))) for k in range(x.shape[1])]
    margin, paths = np.full(n, bias), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(n)
        for path, value, rows in _tree_paths(x, y - p, p * (1 - p), depth, least, cuts):
            if path:
                paths.setdefault(tuple(sorted(path, key=str)), None)
            if value is not None:
                step[rows] = value
        margin += rate * step
    rules = list(paths)
    a = np.ones((n, len(rules)), np.float32)
    for j, path in enumerate(rules):
        for c in path:
            a[:, j] *= c.holds(x)
    mean, scale = a.mean(0), np.maximum(a.std(0), 0.05)
    z = (a - mean) / scale
    w, b, v, vb, t = np.zeros(len(rules), np.float32), bias, np.zeros(len(rules), np.float32), bias, 1.0
    rate = 1 / (0.25 * (np.linalg.norm(z[: min(n, 4000)], 2) ** 2 / min(n, 4000) + 1))
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ v + vb))) - y
        new = v - rate * (z.T @ r / n).astype(np.float32)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        nb, nt = vb - rate * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    return Ensemble(float(b - (w * mean / scale).sum()), tuple((rules[j], float(w[j] / scale[j])) for j in kept))


def train(documents: DataFrame, labels: DataFrame, usable: Column, max_train_rows: int = 6000) -> Ensemble:
    """Fit on labelled rows where ``usable`` (over ``_id``) holds; at most ``max_train_rows``, in a fixed hashed order."""
    wanted = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where(F.col("_y").isNotNull() & F.col("_id").isNotNull() & usable)
    sample = sample_of(wanted, "_id", max_train_rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    stats = with_counts(texts).select("_id", "_y", *[c.alias(n) for n, c in feature_columns().items()])
    rows = sorted(tuple(r) for r in stats.collect())
    x = np.array([r[2:] for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([float(r[1]) for r in rows]))


def score(documents: DataFrame, model: Ensemble) -> DataFrame:
    """Add ``score`` (0 to 1) to (doc_id, text) and the counts.

    Null texts count as empty, which have a score as any text; rows are scored one by
    one, so ties and repeats do not matter; an empty table gives an empty result.
    """
    return with_counts(documents.select("doc_id", "text")).withColumn("score", model.column()).drop("text")
