"""Toxicity: linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Fit (every labelled row, in buckets; the mean of the buckets' weights): presence of hashed character n-grams;
``log((pos + 1) / P) - log((neg + 1) / N)`` scales every feature; L2 logistic regression on the scaled features; the
margins of all rows, each by a model that did not learn from it, give the Platt calibration and the cut.  Scoring (Arrow batches): whole texts, one sum of
weights over the distinct n-grams of each text.

Defined results: a null or empty text has no word n-gram and gets the score of an empty text; repeated rows get equal
scores, one row each; a null id is never held out; without labels of both classes every score is the smoothed share of
label 1 among the usable labels (0.5 if there are none); an empty table gives an empty result; extra columns are kept
by ``filter_toxic`` and ignored by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalpost.llm import common, linear, ngrams

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5


@dataclass(frozen=True)
class Model:
    orders: tuple[int, ...]
    bits: int
    weight: np.ndarray      # float32 per slot, 0 where unused
    bias: float
    scale: float            # score = sigmoid(scale * margin + shift)
    shift: float

    def features(self, text: str) -> np.ndarray:
        return ngrams.char_slots(text.lower(), self.orders, self.bits)

    def score(self, texts: list[str]) -> np.ndarray:
        margin = np.empty(len(texts))
        for i, t in enumerate(texts):
            slot = self.features(t)
            slot = np.unique(slot[self.weight[slot] != 0])
            margin[i] = self.weight[slot].astype(np.float64).sum()
        return linear.sigmoid(self.scale * (margin + self.bias) + self.shift)


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, target: str = "toxic",
        orders: tuple[int, ...] = (4, 5, 6), bits: int = 20, bucket_rows: int = 2000,
        max_features: int = 4_000, min_rows: int = 3, min_z: float = 4.0, l2: float = 1e-3, seed: int = 11) -> Model:
    """Learns from the whole text of every usable labelled row, ``bucket_rows`` or more in a bucket (``linear.labelled``).

    Features of a bucket are the slots whose log-count ratio is at least ``min_z`` standard errors from 0 (the best 200,
    if fewer reach it), ``max_features`` at most."""
    usable = ~common.held_out(F.col("doc_id"), FOLDS, HELD_OUT) if usable is None else usable
    given = linear.labelled(common.id_text(docs), labels, target, usable, bucket_rows)
    blank = Model(orders, bits, np.zeros(1 << bits, np.float32), 0.0, 0.0, 0.0)
    if not given.found.all():
        share = (given.sizes[1] + 1) / (given.sizes.sum() + 2)
        return Model(orders, bits, blank.weight, 0.0, 0.0, float(np.log(share / (1 - share))))
    found = given.found

    def learn(texts: list[str], y: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(set(y.tolist())) < 2:
            return
        sets = [np.unique(ngrams.char_slots(t.lower(), orders, bits)) for t in texts]
        part = np.random.default_rng(seed).permutation(len(y)) % 5
        prior = np.where(y == 1, found[1] / (y == 1).sum(), found[0] / (y == 0).sum())

        def train(use: np.ndarray) -> tuple[np.ndarray, float]:
            label, size = y[use], 1 << bits
            neg, pos = np.zeros((2, size), np.float32)
            for i in np.flatnonzero(use):
                (pos if y[i] else neg)[sets[i]] += 1
            n1, n0 = (label == 1).sum() + 2, (label == 0).sum() + 2
            some = np.flatnonzero(pos + neg >= min_rows)
            p, n = pos[some], neg[some]
            ratio = np.log((p + 1) / n1) - np.log((n + 1) / n0)
            z = np.abs(ratio) / np.sqrt(1 / (p + 1) + 1 / (n + 1))
            keep = np.argsort(-z, kind="stable")[:max_features]
            keep = keep[: max(int((z[keep] >= min_z).sum()), min(200, int((z[keep] > 0).sum())))]
            at = np.full(size, -1, np.int32)
            at[some[keep]] = np.arange(len(keep))
            small = linear.Rows.of([a[a >= 0] for a in (at[sets[i]] for i in np.flatnonzero(use))])
            w, b = linear.fit_logistic(small, label, len(keep), l2, scale=ratio[keep], weight=prior[use])
            full = np.zeros(size, np.float32)
            full[some[keep]] = w
            return full, b

        # out-of-fold margins give the calibration slope and the cut that 0.5 stands for
        margin = np.zeros(len(y))
        for k in range(5):
            held = part == k
            if len(set(y[~held].tolist())) == 2:
                full, b = train(~held)
                margin[held] = [full[sets[i]].sum(dtype=np.float64) + b for i in np.flatnonzero(held)]
        full, b = train(np.ones(len(y), bool))
        yield linear.parts(full, b, margin, y)

    learnt = given.learn(learn, linear.PARTS, "toxicity-parts")
    full, b = linear.mean_weights(learnt.where("slot >= -1"), 1 << bits)
    held = learnt.where("slot = -2").select(F.col("value").alias("margin"), "y")
    margin, y, prior = linear.margin_counts(held, given.copies)
    a, _ = linear.fit_platt(margin, y, prior, count=float(prior.sum()))
    return Model(orders, bits, full.astype(np.float32), float(b), float(a), float(-a * best_cut(margin, y, prior)))


def best_cut(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap whose cut has the best F1 of label 1; among equals the one nearest 0."""
    order = np.argsort(-margin, kind="stable")
    hit = np.cumsum((weight * y)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * y).sum())
    cut = np.append((margin[order][:-1] + margin[order][1:]) / 2, margin[order][-1] - 1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return float(cut[best[np.argmin(np.abs(cut[best]))]])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.concatenate([shared.value.score(texts) for _, texts in common.slices(batch.column(1))]
                                 or [np.empty(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    rows = common.id_text(docs)
    out = rows.mapInArrow(run, rows.select("doc_id", F.lit(0.0).alias("score")).schema)
    return out.select("doc_id", common.held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def filter_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is under ``threshold``, all columns as they were; every row, if the model had no
    labels of both classes to learn from."""
    if not model.weight.any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.score(texts) < threshold for _, texts in common.slices(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(got or [np.empty(0, bool)]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
