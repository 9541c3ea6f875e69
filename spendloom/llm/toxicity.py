"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document is the set of its lower-case character n-grams, each hashed to one of SLOTS numbers.
For every number the training documents are counted by label, in Spark; r is the log ratio of the
smoothed shares among toxic and other documents. Numbers whose shares differ within chance are left
out. A logistic regression over the remaining presences, each scaled by its r, gives the weights. Counts
and weights are fitted on about FIT_ROWS training documents of each label at most, taken by the hash of their
ids; the prior of the labels is their share among all training documents. A score reads the whole text and neither label, language, source nor id.

Results in special cases: null text is an empty one; an empty text has no n-grams and scores the
bias alone; texts with equal words score equally; without training rows of both labels every
document scores the share of toxic ones (0.5 without any). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import fresh, held_out, training_labels, training_rows, written

ORDERS = (4, 5)
SLOTS = 1 << 19
# Learn from about this many training documents of each label (0, 1) at most.
FIT_ROWS = (24_000, 8_000)
# The shares of a feature must differ between labels by so many standard errors.
LEAST_Z = 5.0
# The model has at most so many features: those whose shares differ most, in standard errors.
FEATURES = 4_096
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """weights: of the numbers in `features`, to be added to bias where a text has them."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def gram_slots(text: str) -> np.ndarray:
    """The distinct numbers of a text's n-grams, ascending."""
    units = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    for n in ORDERS:
        if len(units) < n:
            continue
        h = np.full(len(units) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ units[i : len(units) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        found.append((h >> np.uint64(20)) & np.uint64(SLOTS - 1))
    if not found:
        return np.empty(0, np.int64)
    seen = np.zeros(SLOTS, bool) if sum(map(len, found)) > SLOTS // 64 else None
    slots = np.concatenate(found).astype(np.int64)
    if seen is None:
        return np.unique(slots)
    seen[slots] = True
    return np.flatnonzero(seen)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per label and number: how many of this task's documents have it. At most 2 * SLOTS rows."""
    counts = np.zeros((2, SLOTS + 1), np.int64)  # the last column counts documents
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label, gram_slots(text)] += 1
            counts[label, SLOTS] += 1
    label, slot = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[label, slot])],
        names=["label", "slot", "n"],
    )


def _log_ratios(train: DataFrame) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Numbers whose ratio is beyond chance, their ratios, documents by label. Collects at most
    FEATURES rows, whatever the size of the corpus."""
    by = train.select("text", "label").mapInArrow(_counted, "label int, slot int, n long")
    sums = written(
        by.groupBy("slot").agg(
            *[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)]
        )
    )
    total = sums.where(F.col("slot") == SLOTS).collect()
    if not total:
        return np.empty(0, np.int64), np.empty(0), (0, 0)
    docs = total[0].n0, total[0].n1
    if not all(docs):
        return np.empty(0, np.int64), np.empty(0), docs
    ratio = F.log((F.col("n1") + 0.5) / (docs[1] + 1)) - F.log((F.col("n0") + 0.5) / (docs[0] + 1))
    pooled = (F.col("n0") + F.col("n1")) / float(sum(docs))
    error = F.sqrt(pooled * (1 - pooled) * (1 / docs[0] + 1 / docs[1]))
    apart = F.abs(F.col("n1") / float(docs[1]) - F.col("n0") / float(docs[0]))
    kept = sums.where((F.col("slot") < SLOTS) & (error > 0) & (apart >= LEAST_Z * error))
    best = kept.orderBy((apart / error).desc(), "slot").limit(FEATURES)
    kept = best.select("slot", ratio.alias("ratio")).toPandas()
    kept = kept.sort_values("slot")
    return kept["slot"].to_numpy(np.int64), kept["ratio"].to_numpy(float), docs


def _fit(rows: list[np.ndarray], label: np.ndarray, scale: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge by accelerated gradient steps over sparse presences."""
    lengths = np.array([len(r) for r in rows])
    index, owner = np.concatenate(rows), np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    # Each label weighs as much as it does among all training documents, however many of it are fitted.
    weight = np.where(label == 1, prior / max(1, label.sum()), (1 - prior) / max(1, (1 - label).sum()))
    w, bias, ridge = np.zeros(len(scale)), np.log(prior / (1 - prior)), 1e-5
    curve = np.bincount(owner, (scale[index]) ** 2, len(rows))
    step = 4.0 / max(1e-9, float((weight * (curve + 1)).sum()))
    v, vb, was, was_b = w, bias, w, bias
    for t in range(400):
        z = vb + np.bincount(owner, (v * scale)[index], len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        w = v - step * (np.bincount(index, error[owner], len(scale)) * scale + ridge * v)
        bias = vb - step * error.sum()
        momentum = t / (t + 3)
        v, vb, was, was_b = w + momentum * (w - was), bias + momentum * (bias - was_b), w, bias
    return w * scale, float(bias)


def _documents_by_label(docs: DataFrame, labels: DataFrame, label: str) -> tuple[int, int]:
    """How many training documents have label 0 and 1, all of them; reads no text."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    found = dict(ids.join(training_labels(labels, label), "doc_id").groupBy("label").agg(F.count("*")).collect())
    return found.get(0, 0), found.get(1, 0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """The model learned from a bounded sample of the training documents, with the prior of all."""
    all0, all1 = _documents_by_label(docs, labels, label)
    rows = written(training_rows(docs, labels, label, FIT_ROWS, (all0, all1)))
    features, ratios, (n0, n1) = _log_ratios(rows)
    if not n0 or not n1:
        share = 0.5 if not all0 + all1 else all1 / (all0 + all1)
        return Model(features[:0], ratios[:0], float(np.log((share + 1e-6) / (1 - share + 1e-6))))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.isin(features, gram_slots(t), assume_unique=True)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.astype("<u2").tobytes() for f in found], pa.binary()), batch.column(1)],
                names=["present", "label"],
            )

    got = rows.select("text", "label").mapInArrow(present, "present binary, label int").collect()
    w, bias = _fit(
        [np.frombuffer(r.present, "<u2") for r in got],
        np.array([r.label for r in got]),
        ratios,
        all1 / (all0 + all1),
    )
    return Model(features, w, bias)


def scorer(model: Model):
    """A Pandas UDF from text to the probability of label 1."""
    weights = np.zeros(SLOTS)
    weights[model.features] = model.weights
    bias = model.bias

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        z = np.array([bias + weights[gram_slots(t or "")].sum() for t in text], dtype=float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return score


def with_score(docs: DataFrame, model: Model, text: Column, name: str) -> DataFrame:
    return docs.withColumn(name, scorer(model)(F.coalesce(text.cast("string"), F.lit(""))))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return with_score(slim, model, F.col("text"), "score").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, learn_from: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the model doesn't hold for toxic; all columns stay."""
    score = fresh(docs, "_score")
    scored = with_score(docs, train(learn_from, labels), F.col("text"), score)
    return scored.where(F.col(score) < THRESHOLD).select(*docs.columns)
