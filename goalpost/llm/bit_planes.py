"""Hard-negative mining with full exact scores by the Four-Russians method.

Candidates are packed once: a tile holds the bit planes of its rows' integer components in two's complement, one byte
for each plane, row and group of eight dimensions.  For an anchor, each group's 256 subset sums of its eight components
are tabled once; a candidate's score is then, over planes and groups, the tabled sum its packed byte points to, shifted
by the plane (the top plane counts negatively).  No multiplication is left for a pair, and every pair gets its exact
integer score.

Anchors and tiles meet in the cells of a grid: each anchor page goes to one column of cells and each tile to one row of
them, so every pair meets in exactly one cell, whose two sides are bounded.  A first pass finds each anchor's positives;
a second pass, which knows their scores, keeps each cell's best different-label rows inside every positive's window.
Labels play no part in the layout, so a label with most of the rows fills no task.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part; a vector
shorter than the longest counts as if it ended in zeros; rows are rows, also where they repeat an id (a copy of the
anchor is another row); a row without an id is no anchor and comes last among equal scores; equal scores go by smaller
id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalpost.llm.common import saved
from goalpost.llm.vectors import NO_ID, best_places, block_rows, extent, ids_of, matrix, quantised

#: Rows of a tile, anchors of a page, and about how many anchors one cell holds (with ``block_rows`` rows).
TILE, PAGE, CELL_ANCHORS = 1024, 64, 1024


def plane_count(least: int, greatest: int) -> int:
    """Bits of the two's complement that holds every component."""
    return max(int(greatest).bit_length(), (-int(least) - 1).bit_length() if least < 0 else 0) + 1


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of ``x`` (rows, dims): uint8 (planes, groups of eight dims, rows), the first dim in the lowest bit."""
    wide = np.zeros((len(x), -(-x.shape[1] // 8) * 8), np.int64)
    wide[:, :x.shape[1]] = x
    out = np.empty((planes, wide.shape[1] // 8, len(x)), np.uint8)
    for j in range(planes):
        out[j] = np.packbits(((wide >> j) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, greatest: int) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight dims, the sum of each anchor's components named by the byte's bits.

    32 bits wide where a score of components up to ``greatest`` in size fits, so that a lookup moves half the memory."""
    n, dims = anchors.shape
    wide = np.zeros((n, -(-dims // 8) * 8), np.int64)
    wide[:, :dims] = anchors
    groups = wide.T.reshape(-1, 8, n)
    table = np.zeros((len(groups), 256, n), np.int64)
    for bit in range(8):
        table[:, 1 << bit:2 << bit] = table[:, :1 << bit] + groups[:, bit, None]
    # a plane's shifted sum is at most dims * greatest * 2^(planes - 1), and 2^(planes - 1) at most 2 * greatest
    return table.astype(np.int32) if 4 * dims * greatest * greatest < 2 ** 31 else table


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact inner products of the tables' anchors with the packed rows: lookups, shifts and additions."""
    shape = packed.shape[2], table.shape[2]
    total, part, one = (np.zeros(shape, table.dtype) for _ in range(3))
    top = len(packed) - 1
    for j, plane in enumerate(packed):
        np.take(table[0], plane[0], axis=0, out=part, mode="clip")
        for sums, byte in zip(table[1:], plane[1:], strict=True):
            np.take(sums, byte, axis=0, out=one, mode="clip")
            part += one
        part <<= j
        (np.subtract if j == top else np.add)(total, part, out=total)
    return total


def _tiles(vectors: DataFrame, width: int, planes: int) -> DataFrame:
    """One row a tile: its rows' names, ids and labels, and their packed planes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                x = matrix(part.column(3), width)
                yield pa.RecordBatch.from_pydict({
                    "rows": [part.column(0).to_numpy()], "ids": [ids_of(part.column(1))],
                    "labels": [part.column(2).to_numpy()], "packed": [pack(x, planes).tobytes()]})

    return saved(vectors.select("row", "id", "label", "x").mapInArrow(
        run, "rows array<long>, ids array<long>, labels array<long>, packed binary"), "plane-tiles")


def _cells(pages: DataFrame, tiles: DataFrame, anchors: int, rows: int, planes: int, width: int, worker, schema: str
           ) -> DataFrame:
    """``worker(anchors so far, tiles)`` for each cell: pages and tiles sorted so that a cell's pages come first."""
    columns, lines = -(-anchors // CELL_ANCHORS), -(-rows // block_rows(rows))
    spread = lambda n, of: F.pmod(F.xxhash64(of), F.lit(n)).cast("int")
    blank = {c: F.lit(None).cast(t) for c, t in pages.dtypes + tiles.dtypes}
    a = (pages.withColumns({c: blank[c] for c in tiles.columns})
              .withColumn("column", spread(columns, "anchor_rows"))
              .withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(lines - 1)))).withColumn("kind", F.lit(0)))
    b = (tiles.withColumns({c: blank[c] for c in pages.columns})
              .withColumn("line", spread(lines, "rows"))
              .withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))).withColumn("kind", F.lit(1)))
    names = ["column", "line", "kind", *pages.columns, *tiles.columns]
    dealt = (a.select(names).unionByName(b.select(names)).repartition("column", "line")
              .sortWithinPartitions("column", "line", "kind"))
    groups = -(-width // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, state = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(k)[i] for k, n in enumerate(names)}
                here = r["column"].as_py(), r["line"].as_py()
                if here != cell:
                    if state is not None:
                        yield from state.finish()
                    cell, state = here, worker()
                if r["kind"].as_py() == 0:
                    state.page(r)
                else:
                    packed = np.frombuffer(r["packed"].as_buffer(), np.uint8).reshape(planes, groups, -1)
                    state.tile(*(r[n].values.to_numpy() for n in ("rows", "ids", "labels")), packed)
        if state is not None:
            yield from state.finish()

    return dealt.mapInArrow(run, schema)


class _Positives:
    """A cell's best rows of each anchor's own label."""

    def __init__(self, k: int, width: int, greatest: int):
        self.k, self.width, self.greatest, self.pages = k, width, greatest, []

    def page(self, r: dict) -> None:
        x = np.frombuffer(r["anchor_x"].as_buffer(), np.int64).reshape(-1, self.width)
        names = zip(*(r[n].values.to_numpy() for n in ("anchor_rows", "anchor_ids", "anchor_labels")), strict=True)
        self.pages.append((subset_sums(x, self.greatest), [[*n, np.empty((0, 3), np.int64)] for n in names]))

    def tile(self, rows, ids, labels, packed) -> None:
        by_label = {v: np.flatnonzero(labels == v) for v in np.unique(labels)}
        for table, anchors in self.pages:
            columns = scores(table, packed).T.astype(np.int64)
            for s, anchor in zip(columns, anchors, strict=True):
                row, _, label, held = anchor
                at = by_label.get(label)
                if at is None:
                    continue
                if len(held) == self.k:
                    at = at[s[at] >= held[-1, 0]]
                at = at[rows[at] != row]
                if len(at):
                    anchor[3] = _merged(held, s, ids, rows, at, self.k)

    def finish(self) -> Iterator[pa.RecordBatch]:
        for row, own, label, held in (a for _, anchors in self.pages for a in anchors):
            if len(held):
                n = len(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row)), pa.array(np.full(n, own)), pa.array(np.full(n, label)),
                     pa.array(held[:, 2]), pa.array(held[:, 1]), pa.array(held[:, 0])],
                    ["anchor_row", "anchor_id", "anchor_label", "positive_row", "positive_id", "positive_score"])


def _merged(held: np.ndarray, s, ids, rows, at, k: int) -> np.ndarray:
    """The best ``k`` of ``held`` and the places ``at``, as (score, id, row)."""
    at = at[best_places(s[at], ids[at], rows[at], k)]
    both = np.concatenate([held, np.stack([s[at], ids[at], rows[at]], axis=1)])
    return both[best_places(*both.T, k)]


class _Negatives:
    """A cell's best rows of another label inside the window of each positive of each anchor."""

    def __init__(self, k: int, width: int, greatest: int, low: int):
        self.k, self.width, self.greatest, self.low, self.pages = k, width, greatest, low, []

    def page(self, r: dict) -> None:
        x = np.frombuffer(r["anchor_x"].as_buffer(), np.int64).reshape(-1, self.width)
        names = zip(r["anchor_rows"].values.to_numpy(), r["anchor_labels"].values.to_numpy(),
                    r["positives"].as_py(), strict=True)
        self.pages.append((subset_sums(x, self.greatest), [
            (row, label, [[p["positive_row"], p["positive_score"], np.empty((0, 3), np.int64)] for p in found])
            for row, label, found in names]))

    def tile(self, rows, ids, labels, packed) -> None:
        for table, anchors in self.pages:
            columns = scores(table, packed).T.astype(np.int64)
            for s, (_, label, positives) in zip(columns, anchors, strict=True):
                tops = [p[1] for p in positives]
                near = np.flatnonzero((s <= max(tops)) & (100 * s >= self.low * min(tops)) & (labels != label))
                for p in positives if len(near) else ():
                    _, top, held = p
                    v = s[near]
                    inside = (v <= top) & (100 * v >= self.low * top)
                    if len(held) == self.k:
                        inside &= v >= held[-1, 0]
                    at = near[inside]
                    if len(at):
                        p[2] = _merged(held, s, ids, rows, at, self.k)

    def finish(self) -> Iterator[pa.RecordBatch]:
        for row, _, positives in (a for _, anchors in self.pages for a in anchors):
            for p, _, held in positives:
                if len(held):
                    n = len(held)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, row)), pa.array(np.full(n, p)), pa.array(held[:, 2]),
                         pa.array(held[:, 1]), pa.array(held[:, 0])],
                        ["anchor_row", "positive_row", "negative_row", "negative_id", "negative_score"])


def _pages(anchors: DataFrame, width: int) -> DataFrame:
    """Anchors in pages of at most ``PAGE``, with their positives where they have any."""
    with_positives = "positives" in anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE):
                part = batch.slice(at, PAGE)
                cols = {"anchor_rows": [part.column(0).to_numpy()], "anchor_ids": [part.column(1).to_numpy()],
                        "anchor_labels": [part.column(2).to_numpy()],
                        "anchor_x": [matrix(part.column(3), width).tobytes()]}
                arrays = [pa.array(v) for v in cols.values()]
                if with_positives:
                    found = part.column(4)
                    arrays.append(pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found))
                yield pa.RecordBatch.from_arrays(arrays, [*cols, *(["positives"] if with_positives else [])])

    schema = "anchor_rows array<long>, anchor_ids array<long>, anchor_labels array<long>, anchor_x binary"
    if with_positives:
        schema += ", positives array<array<struct<positive_row: long, positive_score: long>>>"
    cols = ["row", "id", "label", "x", *(["positives"] if with_positives else [])]
    return saved(anchors.select(cols).mapInArrow(run, schema), "plane-pages")


def _first(rows: DataFrame, by: list[str], score: str, id_col: str, row_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(id_col), F.col(row_col))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
         id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``rows`` that marks the anchors.  Negatives of a positive score from ``low`` percent
    of its score up to its score."""
    vectors = quantised(rows.where(label.isNotNull()), "plane-vectors", id_col, vec_col, label=label.cast("long"),
                        anchor=F.coalesce(is_anchor, F.lit(False)))
    n, width, least, greatest = extent(vectors)
    width, planes, greatest = max(width, 1), plane_count(least, greatest), max(abs(least), abs(greatest))
    anchors = vectors.where("anchor").select("row", "id", "label", "x")
    count = max(anchors.count(), 1)
    tiles = _tiles(vectors, width, planes)
    grid = {"anchors": count, "rows": max(n, 1), "planes": planes, "width": width}
    near = saved(_cells(_pages(anchors, width), tiles, **grid, worker=lambda: _Positives(positives, width, greatest),
                        schema="anchor_row long, anchor_id long, anchor_label long, positive_row long, "
                               "positive_id long, positive_score long"), "plane-near")
    best = saved(_first(near, ["anchor_row"], "positive_score", "positive_id", "positive_row", positives)
                 .drop("rank"), "plane-positives")
    windows = best.groupBy(F.col("anchor_row").alias("row")).agg(
        F.collect_list(F.struct("positive_row", "positive_score")).alias("positives"))      # at most ``positives`` each
    found = saved(_cells(_pages(anchors.join(windows, "row"), width), tiles, **grid,
                         worker=lambda: _Negatives(negatives, width, greatest, low),
                         schema="anchor_row long, positive_row long, negative_row long, negative_id long, "
                                "negative_score long"), "plane-negatives")
    by = ["anchor_row", "positive_row"]
    chosen = _first(found, by, "negative_score", "negative_id", "negative_row", negatives)
    known = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c)).alias(c)
    return chosen.join(best, by).select("anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"),
                                        known("negative_id"), "positive_score", "negative_score")
