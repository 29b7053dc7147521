"""Quality rules: ordered threshold conjunctions learned by sequential covering.

The learner sees a bounded sample of labelled statistics (``max_train_rows``, 6,000 by
default, the rows first in a fixed hashed order). Two thirds grow a rule by FOIL gain,
one third prunes it from its end; rows that the rule covers leave, and the next rule is
grown on what is left. The rules become one ordered CASE WHEN expression, so that
applying them is a projection: no shuffle, no Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import sample_of
from sievewright.llm.textstats import FEATURES, feature_columns, with_counts


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` if above, else ``feature <= cut``."""

    feature: str
    above: bool
    cut: float

    def column(self, columns: dict[str, Column]) -> Column:
        c = columns[self.feature]
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v > self.cut if self.above else v <= self.cut


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the row is rejected. precision: of the pruning rows it covered."""

    conditions: tuple[Condition, ...]
    precision: float

    def column(self, columns: dict[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(columns)
        return out

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for c in self.conditions:
            out &= c.holds(x)
        return out


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> list[Condition]:
    inside, rule = np.ones(len(x), bool), []
    while len(rule) < most and bad[inside].any() and not bad[inside].all():
        p0 = bad[inside].mean()
        best, gain = None, 1e-9
        for k, name in enumerate(FEATURES):
            v, y = x[inside, k], bad[inside]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cuts = np.flatnonzero(v[1:] > v[:-1])
            if not len(cuts):
                continue
            hit, n = np.cumsum(y)[cuts].astype(float), cuts + 1.0
            for above, p, m in ((False, hit, n), (True, y.sum() - hit, len(y) - n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / m) - math.log2(p0)), -1)
                i = int(np.argmax(g))
                if g[i] > gain:
                    best, gain = Condition(name, above, float((v[cuts[i]] + v[cuts[i] + 1]) / 2)), float(g[i])
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.7, min_covered: int = 5) -> list[Rule]:
    """The ordered rules that tell ``bad`` rows. Without rows of both classes there are none."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    third = np.arange(len(x)) % 3 == 2
    while len(rules) < max_rules and (bad & left & ~third).sum() >= min_covered:
        grow, prune = left & ~third, left & third
        conditions = _grow(x[grow], bad[grow], max_conditions)
        if not conditions:
            break

        def worth(cs: list[Condition]) -> tuple[float, float, int]:
            hit = Rule(tuple(cs), 0).holds(x[prune])
            p, n = int((bad[prune] & hit).sum()), int((~bad[prune] & hit).sum())
            return (p - n) / max(1, p + n), (p + 1) / (p + n + 2), p + n

        kept = max((conditions[:k] for k in range(1, len(conditions) + 1)), key=lambda cs: (worth(cs)[0], -len(cs)))
        rule = Rule(tuple(kept), worth(kept)[1])
        covered = rule.holds(x) & left
        if rule.precision < min_precision or covered.sum() < min_covered:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def train(documents: DataFrame, labels: DataFrame, max_train_rows: int = 6000) -> list[Rule]:
    """Learn the list from ``labels.quality`` (0: bad) on a bounded sample; null labels and null ids are left out.

    The sampled ids number ``max_train_rows`` at most, so broadcasting them is bounded;
    the statistics of the sample come to the driver as plain rows of a few numbers.
    """
    wanted = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_y is not null and _id is not null")
    sample = sample_of(wanted, "_id", max_train_rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    stats = with_counts(texts).select("_id", "_y", *[c.alias(n) for n, c in feature_columns().items()])
    rows = sorted(tuple(r) for r in stats.collect())
    if not rows:
        return []
    x = np.array([r[2:] for r in rows], float)
    return learn(x, np.array([r[1] == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one CASE WHEN over the counts: number of the first rule that holds, from 1; 0: none."""
    columns = feature_columns()
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(rule.column(columns), k) if out is None else out.when(rule.column(columns), k)
    return F.lit(0) if out is None else out.otherwise(0)


def quality_rules(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): the counts, base_failed, rule and kept.

    Null or empty texts have no words and fail the base test; ties and repeated rows
    are judged row by row; an empty table gives an empty result; other columns of
    ``documents`` are not used.
    """
    counted = with_counts(documents.select("doc_id", "text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counted.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
        .drop("text")
    )
