"""Text quality by a sparse ensemble of rules.

Every text is described by statistics that Spark computes in one pass: shares of kinds of characters,
lengths of words and lines, repetition. Small regression trees are grown on the residuals of each other;
every path from a root to a node is a rule, a conjunction of thresholds on statistics. A logistic
regression with a lasso penalty chooses among all rules and gives the weights; the rules with a
weight are compiled into one column expression, so that scoring is a projection of the statistics.

The statistics cover whole texts, all documents. The trees and weights are fitted on about FIT_ROWS
labelled documents, taken by the hash of their ids. Neither label, language, source nor id is part of a score.

Results in special cases: a null text is an empty one; an empty text has statistics of 0 and a score;
equal texts score equally; rows without a label, with a null one or one other than 0 and 1 teach nothing, a
document with several labels counts with the largest; without training rows of both labels all
documents score the share of label 1 (0.5 without any). An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import chosen, held_out, texts, training_labels, written

# Fit on at most so many labelled documents.
FIT_ROWS = 20_000
TREES, DEPTH, CUTS, SHRINK = 40, 3, 48, 0.3
LEAST_ROWS = 0.002
PENALTY = 3e-4
STEPS = 600
THRESHOLD = 0.7


def statistics(text: Column) -> dict[str, Column]:
    """Numbers about a text, all 0 for an empty one."""
    n = F.length(text)
    words = F.array_remove(F.split(text, r"\s+"), "")
    lines = F.split(text, "\n")
    count = F.size(words)
    share = lambda rest: 1 - F.length(rest) / n
    without = lambda pattern: F.regexp_replace(text, pattern, "")
    raw = {
        "log_chars": F.log(n + 1.0),
        "letters": share(without(r"\p{L}+")),
        "capitals": share(without(r"\p{Lu}+")),
        "digits": share(F.translate(text, "0123456789", "")),
        "signs": share(F.translate(text, "#$%&*@^~_=+<>/\\", "")),
        "bars": share(F.translate(text, "|", "")),
        "marks": share(F.translate(text, "!?", "")),
        "stops": share(F.translate(text, ".,;:", "")),
        "brackets": share(F.translate(text, "()[]{}\"'", "")),
        "word_length": n / count,
        "words_new": F.size(F.array_distinct(words)) / count,
        "line_words": count / F.size(lines),
        "lines_new": F.size(F.array_distinct(lines)) / F.size(lines),
        "log_words": F.log(count + 1.0),
    }
    return {k: F.when((n > 0) & (count > 0), v).otherwise(0.0).cast("double") for k, v in raw.items()}


NAMES = (
    "log_chars", "letters", "capitals", "digits", "signs", "bars", "marks", "stops", "brackets",
    "word_length", "words_new", "line_words", "lines_new", "log_words",
)


@dataclass(frozen=True)
class Rule:
    """A conjunction: per condition the statistic's number, whether it must be above, the threshold."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(x[:, f] > t) == above for f, above, t in self.conditions])

    def column(self) -> Column:
        one = lambda f, above, t: F.col(NAMES[f]) > t if above else F.col(NAMES[f]) <= t
        return reduce(and_, [one(*c) for c in self.conditions])


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self) -> Column:
        """Probability of label 1, of the statistics."""
        z = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights, strict=True):
            z = z + F.when(rule.column(), float(w)).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _split(bins: np.ndarray, rows: np.ndarray, residual: np.ndarray, least: int) -> tuple[int, int] | None:
    """Statistic and cut with the largest reduction of squared error among these rows."""
    best, found = 1e-9, None
    total, size = residual[rows].sum(), len(rows)
    for f in range(bins.shape[1]):
        b = bins[rows, f]
        n = np.cumsum(np.bincount(b, minlength=CUTS + 1))[:-1]
        s = np.cumsum(np.bincount(b, residual[rows], CUTS + 1))[:-1]
        ok = (n >= least) & (size - n >= least)
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(size - n, 1), 0) - total**2 / size
        cut = int(gain.argmax())
        if gain[cut] > best:
            best, found = gain[cut], (f, cut)
    return found


def grown_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees, each once."""
    cuts = np.quantile(x, np.linspace(0.01, 0.99, CUTS), axis=0)
    bins = np.stack([np.searchsorted(cuts[:, f], x[:, f], "left") for f in range(x.shape[1])], 1)
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    least = max(5, int(LEAST_ROWS * len(y)))
    rng, rules = np.random.default_rng(7), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        residual = y - p
        leaves = [((), rng.permutation(len(y))[: max(1, 2 * len(y) // 3)], np.arange(len(y)))]
        for _ in range(DEPTH):
            below = []
            for path, rows, everyone in leaves:
                cut = _split(bins, rows, residual, least) if len(rows) >= 2 * least else None
                if not cut:
                    below.append((path, rows, everyone))
                    continue
                f, c = cut
                for above in (False, True):
                    longer = (*path, (f, above, float(cuts[c, f])))
                    rules[Rule(longer)] = None
                    pick = lambda r, f=f, c=c, above=above: r[(bins[r, f] > c) == above]
                    below.append((longer, pick(rows), pick(everyone)))
            leaves = below
        for _, rows, everyone in leaves:
            if len(rows):
                step = residual[rows].sum() / max(1e-3, (p[rows] * (1 - p[rows])).sum())
                z[everyone] += SHRINK * np.clip(step, -4, 4)
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Logistic regression with an absolute penalty on the weights, by accelerated proximal steps."""
    x = x.astype(float)
    mean = x.mean(axis=0)
    x = x - mean
    w, bias = np.zeros(x.shape[1]), 0.0
    v, vb, t = w, bias, 1.0
    norm = np.random.default_rng(3).standard_normal(x.shape[1])
    for _ in range(20):
        norm = x.T @ (x @ norm)
        norm /= max(1e-12, np.linalg.norm(norm))
    step = 4 * len(y) / max(1e-9, float(np.linalg.norm(x @ norm) ** 2) * 1.05 + len(y))
    for _ in range(STEPS):
        error = (1 / (1 + np.exp(-np.clip(x @ v + vb, -40, 40))) - y) / len(y)
        u = v - step * (x.T @ error)
        new, new_b = np.sign(u) * np.maximum(0, np.abs(u) - step * penalty), vb - step * error.sum()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - bias)
        w, bias, t = new, new_b, s
    return w, float(bias - mean @ w)


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else float(y.mean())
        return Ensemble((), (), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rules = grown_rules(x, y)
    if not rules:
        return Ensemble((), (), float(np.log(y.mean() / (1 - y.mean()))))
    w, bias = lasso(np.stack([r.holds(x) for r in rules], 1), y, PENALTY)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble(tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept), bias)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = texts(docs).select("doc_id", *[c.alias(k) for k, c in statistics(F.col("text")).items()])
    stats = written(stats)
    known = training_labels(labels, label)
    # A threshold on the hash of the ids: what reaches the driver is about FIT_ROWS rows, in however many partitions.
    rows = stats.join(known.where(chosen(FIT_ROWS / max(1, known.count()))), "doc_id")
    rows = rows.toPandas().sort_values(["doc_id", "label", *NAMES])
    ensemble = fit(rows[list(NAMES)].to_numpy(float), rows["label"].to_numpy(float))
    return stats.withColumn("score", ensemble.column()).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
