"""Quality classifier: Bradley-Terry ranking of preference pairs, thresholded by a score quantile.

Every text becomes a vector of bounded shape features.  Each pair (preferred, rejected) of labelled rows adds
``log(1 + exp(-w . (f_preferred - f_rejected)))``; the minimum over w is the Bradley-Terry model whose document score
is ``w . f``.  The cut is the quantile of the labelled rows' scores at the labels' share of class 0; the returned score
is a logistic curve of the distance to the cut that passes 0.7 there, so ``score >= 0.7`` is "above the quantile".

Defined results: null and empty texts have the features of an empty text and get a score; repeated rows get equal
scores, one row each; ties score equally; a null id is never held out; without labels of both classes every score is
0.7; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalpost.llm import common, linear, ngrams

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7

_SYMBOLS = re.compile(r"[#*$%&|<>@{}\[\]\\^~=_+]")
_PIPES = re.compile(r"\|")
_BANGS = re.compile(r"[!?]")
_DIGITS = re.compile(r"[0-9]")
_STOPS = re.compile(r"[.,;:]")
_UPPER = re.compile(r"[A-ZÀ-Þ]")
_LETTER = re.compile(r"[A-Za-zÀ-ɏ]")

NAMES = ("log_words", "symbols", "pipes", "bangs", "digits", "stops", "upper", "letters", "word_length", "distinct",
         "top_word", "repeated_pairs", "repeated_4grams", "repeated_lines", "longest_run", "short")


def features(text: str) -> np.ndarray:
    """Shares and logarithms of whole-text counts, each bounded; never the label, language, source or id."""
    tokens = ngrams.words(text)
    chars, n = max(1, len(text)), len(tokens)
    count = Counter(tokens)
    hashed = ngrams.word_hashes(tokens)
    repeated = []
    for k in (2, 4):
        grams = ngrams.rolled(hashed, k)
        repeated.append(1 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0)
    lines = [x for x in text.split("\n") if x.strip()]
    same = hashed[1:] == hashed[:-1]
    run = int(np.diff(np.flatnonzero(np.concatenate([[True], ~same, [True]]))).max()) if n else 0
    share = lambda p: min(1.0, len(p.findall(text)) / chars)
    return np.array([
        min(np.log1p(n), 12) / 4, share(_SYMBOLS) ** 0.5, share(_PIPES) ** 0.5, share(_BANGS) ** 0.5,
        share(_DIGITS) ** 0.5, share(_STOPS) ** 0.5, share(_UPPER) ** 0.5, share(_LETTER),
        min(20.0, sum(map(len, tokens)) / n) / 6 if n else 0.0,
        np.log1p(len(count)) / np.log1p(n) if n else 0.0, max(count.values()) / n if n else 0.0, *repeated,
        1 - len(set(lines)) / len(lines) if lines else 0.0, np.log1p(run) / 3, 1.0 if n < 20 else 0.0])


@dataclass(frozen=True)
class Model:
    weight: np.ndarray
    cut: float
    slope: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return linear.sigmoid(self.slope * (rows @ self.weight - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD)))


def bradley_terry(rows: np.ndarray, y: np.ndarray, l2: float) -> np.ndarray:
    """Newton minimum of the mean logistic loss over the feature differences of all (preferred, rejected) pairs."""
    good, bad = rows[y == 1], rows[y == 0]
    w, pairs = np.zeros(rows.shape[1]), len(good) * len(bad)
    for _ in range(60):
        p = linear.sigmoid((bad @ w)[None, :] - (good @ w)[:, None])
        grad = -(p.sum(axis=1) @ good - p.sum(axis=0) @ bad) / pairs + l2 * w
        p *= 1 - p
        cross = good.T @ (p @ bad)
        hess = ((good * p.sum(axis=1)[:, None]).T @ good + (bad * p.sum(axis=0)[:, None]).T @ bad - cross - cross.T)
        step = np.linalg.solve(hess / pairs + l2 * np.eye(len(w)), grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, target: str = "quality",
        bucket_rows: int = 3000, l2: float = 1e-4) -> Model:
    """Learns from every usable labelled row: all pairs inside a bucket (``linear.labelled``), the mean weights of the
    buckets, and the cut and spread of all rows' scores."""
    usable = ~common.held_out(F.col("doc_id"), FOLDS, HELD_OUT) if usable is None else usable
    given = linear.labelled(common.id_text(docs), labels, target, usable, bucket_rows)
    if not given.found.all():
        return Model(np.zeros(len(NAMES)), 0.0, 0.0)

    def train(texts: list[str], y: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = np.stack([features(t) for t in texts])
        w = [bradley_terry(rows, y, l2)] if len(set(y.tolist())) == 2 else []
        yield pa.RecordBatch.from_arrays([pa.array([*y.tolist(), *[-1] * len(w)], pa.int32()),
                                          pa.array([*rows.tolist(), *(x.tolist() for x in w)], pa.list_(pa.float64()))],
                                         ["y", "row"])

    learnt = given.learn(train, "y int, row array<double>", "quality-rows")
    # one row a bucket, added in their own order whatever the partitions
    w = np.mean(sorted(r["row"] for r in learnt.where("y = -1").collect()), axis=0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(w))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows @ w)], ["y", "raw"])

    raw = common.saved(learnt.where("y >= 0").mapInArrow(scored, "y int, raw double"), "quality-scores")
    copied = (F.when(F.col("y") == 1, 1 / given.copies[1]).otherwise(1 / given.copies[0]))
    spread = raw.agg((F.sum(F.col("raw") * F.col("raw") * copied) / F.sum(copied)).alias("square"),
                     (F.sum(F.col("raw") * copied) / F.sum(copied)).alias("mean")).first()
    std = round(float(np.sqrt(max(0.0, spread["square"] - spread["mean"] ** 2))), 9)
    return Model(w, _cut(raw, given), 2.0 / (std + 1e-9))


def _cut(raw: DataFrame, given: linear.Labelled) -> float:
    """Middle between the scores on both sides of the labels' share of class 0, each row counted once."""
    a, b = given.copies[1], given.copies[0]
    # a row of a class that is in r buckets weighs 1 / r; the other class is repeated to the same scale
    times = F.when(F.col("y") == 1, b).otherwise(a)
    all_ = raw if a == b == 1 else raw.select("raw", F.explode(F.sequence(F.lit(1), times)))
    rank = int(given.found[0]) * a * b
    low = linear.value_at(all_, "raw", rank - 1)
    above = all_.agg(F.count_if(F.col("raw") <= low).alias("n"),
                     F.min(F.when(F.col("raw") > low, F.col("raw"))).alias("next")).first()
    high = low if above["n"] > rank or above["next"] is None else above["next"]
    return (low + high) / 2


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for _, texts in common.slices(batch.column(1)) for t in texts]
            got = model.score(np.stack(rows)) if rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["doc_id", "score"])

    rows = common.id_text(docs)
    out = rows.mapInArrow(run, rows.select("doc_id", F.lit(0.0).alias("score")).schema)
    return out.select("doc_id", common.held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
