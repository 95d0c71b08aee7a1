"""Quality rules: counted base rules, then a calibrated logistic regression on hashed word and character n-grams.

The base counts follow their definitions over the whole text.  The method's verdict is the calibrated probability of
label 1 against a fixed threshold.  Fit and calibration use every labelled row, in buckets; scoring is one Arrow pass.

Defined results: a null text has no words and fails the base rules; an empty text likewise; repeated rows give one
row each; without labels of both classes the method keeps what the base rules keep; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goalpost.llm import common, linear, ngrams

# fixed values of the base rules
MIN_WORDS, MAX_REPEATED_PCT, WINDOW = 20, 30, 8
_SYMBOLS = "#*$%&|<>"
_ANY_WORD = re.compile(r"[^\x20\x09-\x0D]")

#: A text under this probability of label 1 is dropped.
THRESHOLD = 0.5


def repeated_words(tokens: list[str], hashes: np.ndarray | None = None) -> int:
    """Words inside 8-word windows that the text holds twice or more, the first included."""
    n = len(tokens) - WINDOW + 1
    if n < 2:
        return 0
    # equal windows have equal hashes: without these, nothing is held twice
    window = np.sort(ngrams.rolled(ngrams.word_hashes(tokens) if hashes is None else hashes, WINDOW))
    if not (window[1:] == window[:-1]).any():
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens))
    # a window's class in three doublings of exact pair numbering: 2, 4, then 8 words
    for k in (1, 2, 4):
        pair = ids[:-k] * (int(ids.max()) + 1) + ids[k:]
        found, ids = np.unique(pair, return_inverse=True)
        if len(found) == len(pair):
            return 0        # no shorter window is held twice, so no longer one
    twice = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(tokens) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if _ANY_WORD.search(line):
            n += line in seen
            seen.add(line)
    return n


def base_counts(text: str, tokens: list[str], hashes: np.ndarray | None = None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    return (len(tokens), len(text) - sum(map(text.count, ngrams.BLANKS)), sum(map(text.count, _SYMBOLS)),
            duplicate_lines(text), repeated_words(tokens, hashes))


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED_PCT * n_words


@dataclass(frozen=True)
class Model:
    word_orders: tuple[int, ...]
    char_orders: tuple[int, ...]
    bits: int
    weight: np.ndarray
    bias: float
    scale: float
    shift: float

    def features(self, text: str, hashes: np.ndarray) -> np.ndarray:
        """Slots of a text and the hashes of its words."""
        return np.concatenate([ngrams.hash_slots(hashes, self.word_orders, self.bits),
                               ngrams.char_slots(text, self.char_orders, self.bits)])

    def probability(self, text: str, hashes: np.ndarray) -> float:
        margin = margin_of(self.weight, self.features(text, hashes)) + self.bias
        return float(linear.sigmoid(self.scale * margin + self.shift))


def root_shares(slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of a text and the square roots of their shares: length alone moves nothing."""
    slot = np.sort(slot)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(slot)), bool), slot[1:] != slot[:-1]]))
    n = np.diff(first, append=len(slot))
    return slot[first], np.sqrt(n / max(1, len(slot))).astype(np.float32)


def margin_of(weight: np.ndarray, slot: np.ndarray) -> float:
    found, root = root_shares(slot)
    return float(weight[found] @ root)


def fit(docs: DataFrame, labels: DataFrame, usable=None, target: str = "quality", word_orders: tuple[int, ...] = (1, 2),
        char_orders: tuple[int, ...] = (2, 3, 4), bits: int = 18, bucket_rows: int = 1600,
        min_rows: int = 10, l2: float = 1e-4, steps: int = 100, seed: int = 5) -> Model:
    """Learns from the whole text of every usable labelled row, ``bucket_rows`` or more in a bucket (``linear.labelled``):
    the mean of the buckets' weights, calibrated on the held-back fifths of all buckets."""
    usable = F.lit(True) if usable is None else usable
    given = linear.labelled(common.id_text(docs), labels, target, usable, bucket_rows)
    size = 1 << bits
    blank = Model(word_orders, char_orders, bits, np.zeros(size, np.float32), 0.0, 0.0, 0.0)
    if not given.found.all():
        # nothing to learn from: a probability over the threshold keeps what the base rules keep
        return Model(word_orders, char_orders, bits, blank.weight, 0.0, 0.0, 4.0)
    plain = Model(word_orders, char_orders, bits, np.zeros(0, np.float32), 0.0, 0.0, 0.0)   # light: sent to every task

    def learn(texts: list[str], y: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(set(y.tolist())) < 2:
            return
        rows = [root_shares(plain.features(t, ngrams.word_hashes(ngrams.words(t)))) for t in texts]
        part = np.random.default_rng(seed).permutation(len(y)) % 5
        # the held-back fifth is scored by a model without it; the weights come from all rows
        w, b, margin = _fit_roots(rows, y, part != 0, size, min_rows, l2, steps)
        held = np.flatnonzero(part == 0) if len(set(y[part != 0].tolist())) == 2 else np.empty(0, np.int64)
        yield linear.parts(w, b, margin[held], y[held])

    learnt = given.learn(learn, linear.PARTS, "quality-parts")
    w, b = linear.mean_weights(learnt.where("slot >= -1"), size)
    margin, y, weight = linear.margin_counts(
        learnt.where("slot = -2").select(F.col("value").alias("margin"), "y"), given.copies)
    a, c = linear.fit_platt(margin, y, weight, count=float(weight.sum())) if len(set(y.tolist())) == 2 else (1.0, 0.0)
    return Model(word_orders, char_orders, bits, w.astype(np.float32), float(b), float(a), float(c))


class _Segments:
    """Sums of entries by row or column: of (number, entry's value) products, for two columns of numbers at once.

    The entries are gone over in pieces of whole segments, so that a piece stays in the cache."""

    def __init__(self, of: np.ndarray, at: np.ndarray, value: np.ndarray, piece: int = 1 << 15):
        n = np.bincount(of)
        self.found = np.flatnonzero(n)
        start = (np.cumsum(n) - n)[self.found]
        cut = np.append(np.flatnonzero(np.diff(start // piece, prepend=-1)), len(start))
        end = np.append(start, len(at))
        pairs = np.repeat(value, 2)
        self.pieces = [(slice(i, j), at[end[i]:end[j]], pairs[2 * end[i]:2 * end[j]], start[i:j] - start[i])
                       for i, j in zip(cut[:-1], cut[1:], strict=True)]

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        """(segments found, 2) of the numbers (n, 2), taken as the two parts of complex ones."""
        pair = np.ascontiguousarray(numbers, np.float32).view(np.complex64)[:, 0]
        out = np.empty(len(self.found), np.complex64)
        for to, at, value, start in self.pieces:
            held = pair.take(at, mode="clip")
            held.view(np.float32)[:] *= value
            np.add.reduceat(held, start, out=out[to])
        return out.view(np.float32).reshape(-1, 2)


class _Table:
    """Rows of (columns, values) for the gradients of two fits at once: the columns that an eighth of the rows hold as a
    dense block, the others' entries once by row and once by column.  ``place``: the columns' numbers, -1 for none."""

    def __init__(self, rows, width: int, place: np.ndarray | None = None):
        self.n, self.width = len(rows), width
        col, value = np.concatenate([s for s, _ in rows]), np.concatenate([v for _, v in rows])
        row = np.repeat(np.arange(self.n, dtype=np.int32), [len(s) for s, _ in rows])
        if place is not None:
            col = place[col]
            known = col >= 0
            row, col, value = row[known], col[known], value[known]
        dense = np.bincount(col, minlength=width) >= max(1, self.n / 8)
        self.hot, place = np.flatnonzero(dense), np.cumsum(dense) - 1
        at = dense[col]
        self.block = np.zeros((self.n, len(self.hot)), np.float32)
        self.block[row[at], place[col[at]]] = value[at]
        col, value, row = col[~at], value[~at], row[~at]
        # rows come in order already, so a stable sort by column keeps them so
        order = np.argsort(col, kind="stable")
        self.by_row = _Segments(row, col.astype(np.intp), value)
        self.by_col = _Segments(col, row[order].astype(np.intp), value[order])

    def sums(self, w: np.ndarray) -> np.ndarray:
        """The sum of value times weight of every row, for one fit's weights."""
        out = (self.block @ w[self.hot]).astype(np.float64)
        out[self.by_row.found] += self.by_row.sums(np.stack([w, w], axis=1))[:, 0]
        return out

    def spread(self, err: np.ndarray) -> np.ndarray:
        """The sum of value times the rows' numbers of every column, for one fit's errors."""
        err = np.stack([err, err], axis=1)
        return self.gradient(np.zeros((self.width, 2), np.float32), lambda at, _: err[at])[0][:, 0]

    def gradient(self, w: np.ndarray, error, piece: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """The sums of value times error by column (width, 2) and of the errors (2,); ``error(at, margins)`` of a slice of
        the rows.  The dense block is read once, in pieces that stay in the cache for both products."""
        margin, total = np.zeros((self.n, 2)), np.empty((self.n, 2))
        margin[self.by_row.found] = self.by_row.sums(w)
        hot, spread = w[self.hot], np.zeros((2, len(self.hot)))
        for i in range(0, self.n, piece):
            at = slice(i, i + piece)
            total[at] = error(at, margin[at] + self.block[at] @ hot)
            spread += total[at].T.astype(np.float32) @ self.block[at]
        out = np.zeros((self.width, 2))
        out[self.hot] = spread.T
        out[self.by_col.found] = self.by_col.sums(total)
        return out, total.sum(axis=0)


def _fit_roots(rows, y, train, size, min_rows, l2, steps):
    """Class-balanced logistic regressions of the ``train`` rows and of all rows, each over the slots that ``min_rows`` of
    its texts hold (at least two); one pass over the entries a step serves both.

    All rows' weights and bias, and every row's margin under the fit of the ``train`` rows."""
    learns = np.stack([train, np.ones(len(y), bool)], axis=1)
    count = np.zeros((2, size), np.int32)
    for (s, _), k in zip(rows, train, strict=True):
        count[0 if k else 1][s] += 1
    count[1] += count[0]
    over = count >= [[max(2, min(min_rows, int(n) // 10))] for n in learns.sum(axis=0)]
    used = np.flatnonzero(over.any(axis=0))
    over = over[:, used].T
    at = np.full(size, -1, np.int32)
    at[used] = np.arange(len(used))
    table = _Table([(s, 10 * v) for s, v in rows], len(used), at)
    weight = np.where((y == 1)[:, None], 0.5 / np.maximum(1, learns[y == 1].sum(axis=0)),
                      0.5 / np.maximum(1, learns[y == 0].sum(axis=0))) * learns
    w, b = np.zeros((len(used), 2), np.float32), np.zeros(2)
    m, v = np.zeros((len(used) + 1, 2)), np.zeros((len(used) + 1, 2))
    for t in range(1, steps + 1):
        g, total = table.gradient(w, lambda at, x: (linear.sigmoid(x + b) - y[at, None]) * weight[at])
        g += l2 * w
        g *= over
        g = np.append(g, total[None], axis=0)
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g * g
        step = 0.03 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w -= step[:-1].astype(np.float32)
        b = b - step[-1]
    full = np.zeros(size)
    full[used] = 10 * w[:, 1]
    return full, b[1], table.sums(w[:, 0]) + b[0]


_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
                        T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
                        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                        T.StructField("probability", T.DoubleType())])


def apply_rules(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, base verdict, the method's probability and the final verdict for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # 4 bytes a slot: 1 MB at 18 bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, texts in common.slices(batch.column(1)):
                for text in texts:
                    tokens = ngrams.words(text)
                    hashes = ngrams.word_hashes(tokens)
                    counts = base_counts(text, tokens, hashes)
                    failed = base_failed(counts[0], counts[4])
                    p = shared.value.probability(text, hashes)
                    rows.append((*counts, failed, not failed and p >= threshold, p))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                _SCHEMA.names)

    return common.id_text(docs).mapInArrow(run, _SCHEMA)
