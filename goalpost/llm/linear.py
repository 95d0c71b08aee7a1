"""Linear models of every labelled row: rows in buckets, one fit a bucket, the mean of the fits; counts over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goalpost.llm import common


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Labelled:
    """Every labelled row, dealt to buckets of bounded size: one model a bucket, the fit is their mean.

    ``sizes`` are the classes' sizes among all usable labels, ``found`` among those that have a document."""
    rows: DataFrame         # bucket, doc_id, y, text; one partition a bucket
    buckets: int
    sizes: np.ndarray
    found: np.ndarray
    copies: tuple[int, int]

    def learn(self, train: Callable[[list[str], np.ndarray], Iterator[pa.RecordBatch]], schema: str,
              name: str) -> DataFrame:
        """The written rows of ``train(texts, y)`` of all buckets; texts by doc_id, one text (the least) an id."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            bucket = None

            def trained() -> Iterator[pa.RecordBatch]:
                ids = sorted(held)
                if ids:
                    yield from train([held[i][1] for i in ids], np.array([held[i][0] for i in ids], np.int64))

            for batch in batches:
                for b, i, y, text in zip(*batch.columns, strict=True):
                    b, i, y, text = b.as_py(), i.as_py(), y.as_py(), text.as_py() or ""
                    if b != bucket:
                        yield from trained()
                        held, bucket = {}, b
                    if i not in held or text < held[i][1]:
                        held[i] = (y, text)
            yield from trained()

        return common.saved(self.rows.mapInArrow(run, schema), name)


def labelled(docs: DataFrame, labels: DataFrame, target: str, usable: Column, bucket_rows: int) -> Labelled:
    """Every usable labelled document with its whole text, in buckets of ``bucket_rows`` to twice as many rows.

    A row's bucket follows from its id alone.  The rows of a class that would have under a tenth of ``bucket_rows`` in a
    bucket are put into several buckets (all, if need be), the same number for each row of the class."""
    rows = (labels.where(usable & F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
                  .groupBy("doc_id").agg(F.max(target).cast("int").alias("y")))
    ids = docs.select("doc_id").distinct().withColumn("__there", F.lit(True))
    counted = rows.join(ids, "doc_id", "left").groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                                                F.count("__there").alias("found")).collect()
    sizes, found = np.zeros(2), np.zeros(2)
    for r in counted:
        sizes[r["y"]], found[r["y"]] = r["n"], r["found"]
    buckets = max(1, int(found.sum()) // bucket_rows)
    copies = tuple(min(buckets, max(1, -(-buckets * (bucket_rows // 10) // max(1, int(n))))) for n in found)
    # the bound is on the width of the table sent; more labels are joined by shuffle
    known = F.broadcast(rows) if sizes.sum() <= 200_000 else rows
    times = F.when(F.col("y") == 1, copies[1]).otherwise(copies[0])
    dealt = docs.join(known, "doc_id")
    if max(copies) > 1:
        dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), times - 1)).alias("__copy"))
    else:
        dealt = dealt.withColumn("__copy", F.lit(0))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) + F.floor(F.col("__copy") * F.lit(buckets) / times)
    dealt = dealt.select(F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"), "doc_id", "y", "text")
    return Labelled(dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket"), buckets, sizes, found,
                    copies)


def margin_counts(margins: DataFrame, copies: tuple[int, int], step: float = 1 / 256) -> tuple[np.ndarray, ...]:
    """Margin, label and weight of every label and range of ``step`` of all rows (margin, y)."""
    rows = (margins.groupBy("y", F.floor(F.col("margin") / step).alias("at"))
                   .agg(F.count(F.lit(1)).alias("n")).orderBy("y", "at").collect())
    y = np.array([r["y"] for r in rows], np.int64)
    weight = np.array([r["n"] for r in rows], np.float64) / np.where(y == 1, copies[1], copies[0])
    return np.array([(r["at"] + 0.5) * step for r in rows], np.float64), y, weight


def mean_weights(parts: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Mean over buckets of the weights (slot, value) and of the bias (slot -1)."""
    unit = float(1 << 32)       # whole multiples of its inverse: their sum does not depend on the order of the rows
    rows = (parts.groupBy("slot").agg(F.sum((F.col("value") * unit).cast("long")).alias("value"),
                                      F.count(F.lit(1)).alias("n")).toPandas())
    slot, value = rows["slot"].to_numpy(np.int64), rows["value"].to_numpy(np.float64) / unit
    bias = slot == -1
    models = float(rows["n"][bias].sum())
    full = np.zeros(size)
    full[slot[~bias]] = value[~bias] / models
    return full, float(value[bias].sum() / models)


PARTS = "slot int, value double, y int"


def parts(w: np.ndarray, b: float, margin: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """A bucket's part of a fit: nonzero weights, the bias (slot -1) and the margins of rows not learnt from (slot -2)."""
    slot = np.flatnonzero(w)
    slots = np.concatenate([slot, [-1], np.full(len(margin), -2)])
    label = np.concatenate([np.full(len(slot) + 1, -1), y])
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(np.concatenate([w[slot], [b], margin])),
                                       pa.array(label, pa.int32())], ["slot", "value", "y"])


def value_at(rows: DataFrame, column: str, rank: int) -> float:
    """The value of 0-based ``rank`` among the numbers of a column, by counts of ever narrower ranges."""
    rows = rows.select(F.col(column).alias("v"))
    lo, hi = rows.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        at = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit((hi - lo) / 1024)), F.lit(1023))
        for r in (rows.where(F.col("v").between(lo, hi)).groupBy(at.alias("at"))
                      .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                      .orderBy("at").collect()):
            if rank < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


@dataclass(frozen=True)
class Rows:
    """Binary rows: ``slot[start[i]:start[i + 1]]`` are the features of row i."""
    slot: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(sets: list[np.ndarray]) -> Rows:
        return Rows(np.concatenate(sets) if sets else np.empty(0, np.int32),
                    np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))

    def sums(self, weight: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weight[self.slot])])
        return total[self.start[1:]] - total[self.start[:-1]]

    def spread(self, value: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slot, weights=np.repeat(value, np.diff(self.start)), minlength=size)


def fit_logistic(rows: Rows, y: np.ndarray, size: int, l2: float, steps: int = 120, scale: np.ndarray | None = None,
                 weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated full-batch descent with a per-feature step (Adam)."""
    scale = np.ones(size) if scale is None else scale
    weight = np.ones(len(y)) if weight is None else weight
    weight = weight / weight.sum()
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        err = (sigmoid(rows.sums(w * scale) + b) - y) * weight
        g = rows.spread(err, size) * scale + l2 * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - t / (steps + 1)) + 0.005
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-9)
    return w * scale, b


def fit_platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 200,
              count: float | None = None) -> tuple[float, float]:
    """(a, b) with P(1) = sigmoid(a * margin + b), by Newton steps on weighted, smoothed targets; a stays positive.

    ``count``: how many rows the margins stand for, if not one each."""
    count = len(y) if count is None else count
    spread = margin.std() or 1.0
    centre = margin.mean()
    x = (margin - centre) / spread
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    n = weight.sum()
    weight = weight / n * count
    hi, lo = (count * pos / n + 1) / (count * pos / n + 2), 1 / (count * neg / n + 2)
    target = np.where(y == 1, hi, lo)
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * x + b)
        h = weight * p * (1 - p) + 1e-9
        ga, gb = (weight * (p - target) * x).sum() + 1e-3 * a, (weight * (p - target)).sum()
        haa, hab, hbb = (h * x * x).sum() + 1e-3, (h * x).sum(), h.sum()
        det = haa * hbb - hab * hab + 1e-12
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / (abs(da) + abs(db) + 1e-9))
        a, b = max(1e-3, a - step * da), b - step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return a / spread, b - a * centre / spread
