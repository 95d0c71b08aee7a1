"""M-tree search and bit-plane mining against brute force: ties, copies, nulls, odd lengths, hot vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from goalpost.llm import bit_planes, metric_tree, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int, id double, rank string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "r", 1, 2.0, "k", 3) for i, v, lab in rows], SCHEMA)


def clean(rows):
    """(id, integer vector, label) of the rows that take part; shorter vectors end in zeros."""
    ok = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), lab) for i, v, lab in rows
          if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    width = max((len(v) for _, v, _ in ok), default=0)
    return [(i, np.pad(v, (0, width - len(v))), lab) for i, v, lab in ok]


def brute_top(rows, k=5, every=50):
    rows, out = clean(rows), []
    place = lambda i: (i is None, i or 0)
    for a, (q, x, _) in enumerate(rows):
        if q is None or q % every:
            continue
        s = sorted(((-int(x @ y), place(c), c) for b, (c, y, _) in enumerate(rows) if b != a), key=lambda t: t[:2])
        out += [(q, n + 1, c, -v) for n, (v, _, c) in enumerate(s[:k])]
    return sorted(out, key=str)


def brute_mine(rows, every=100):
    rows = [(i, x, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, x, lab in clean(rows)
            if lab is not None]
    place, out = (lambda i: (i is None, i or 0)), []
    for a, (q, x, lab) in enumerate(rows):
        if q is None or q % every:
            continue
        s = sorted(((-int(x @ y), place(c), c, m) for b, (c, y, m) in enumerate(rows) if b != a), key=lambda t: t[:2])
        for v, _, p, _ in [t for t in s if t[3] == lab][:5]:
            near = [t for t in s if t[3] != lab and 80 * -v <= 100 * -t[0] <= 100 * -v][:5]
            out += [(q, p, n + 1, c, -v, -w) for n, (w, _, c, _) in enumerate(near)]
    return sorted(out, key=str)


def mine(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, bit_planes.mine(df, label, F.col("vec_id") % 100 == 0).collect()), key=str)


def top(df):
    return sorted(map(tuple, metric_tree.top_k(df).collect()), key=str)


def clustered(n, seed, hot=0.0, dims=24):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dims))
    x = centre[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dims))
    x[rng.random(n) < hot] = x[0]
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, rng.integers(0, 10, n), strict=True))]


@pytest.fixture(scope="module")
def small_blocks():
    """Many blocks, pages, stripes and cells on little data."""
    with pytest.MonkeyPatch.context() as m:
        for name, v in (("PAGE", 8), ("FANOUT", 4), ("STRIPE", 7), ("QUERY_PAGE", 3)):
            m.setattr(metric_tree, name, v)
        for name, v in (("TILE", 16), ("PAGE", 2), ("CELL_ANCHORS", 4)):
            m.setattr(bit_planes, name, v)
        for module in (metric_tree, bit_planes, vectors):
            m.setattr(module, "block_rows", lambda n: 150)
        yield


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_hot_vectors_match_brute_force(spark, small_blocks, hot):
    rows = clustered(900, 5, hot)
    df = frame(spark, rows)
    assert top(df) == brute_top(rows)
    assert mine(df) == brute_mine(rows)


def test_awkward_rows(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = clustered(120, 9, dims=5) + [
        (0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (100, [], 2), (100, [-9.0, 8.0, 7.0, -6.0, 5.0], 3), (None, [1.0] * 5, 1),
        (None, [1.0] * 5, 4), (50, None, 1), (150, [nan] * 5, 1), (200, [inf, 0.0, 0.0, 0.0, 0.0], 2), (250, [None] * 5, 2),
        (300, [1.0, 2.0, 3.0, 4.0, 5.0], None), (350, [-1.0] * 5, 0), (700, [0.0] * 5, 9)]
    df = frame(spark, rows)
    assert top(df) == brute_top(rows)
    assert mine(df) == brute_mine(rows)


def test_few_and_no_rows(spark):
    for rows in ([], [(0, [1.0, 2.0], 1)], [(0, None, 1)], [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]):
        df = frame(spark, rows)
        assert top(df) == brute_top(rows)
        assert mine(df) == brute_mine(rows)


def test_tree_spares_distances():
    """Stored parent distances leave out entries before their distance is computed, and the answer stays exact."""
    rows = clean(clustered(4000, 1))
    x, ids = np.array([v for _, v, _ in rows]), np.arange(len(rows))
    space = metric_tree.Space(x.shape[1], int((x * x).sum(axis=1).max()))
    tree = metric_tree.Tree(space, True)
    for p in metric_tree.grow(space, x, ids, ids):
        assert len(p["rows"]) <= max(metric_tree.PAGE, metric_tree.FANOUT)
        tree.add(*(p[c] for c in ("page", "leaf", "vectors", "radius", "parent", "least", "child", "rows")))
    for i in range(0, 4000, 97):
        s = x @ x[i]
        order = np.lexsort((ids, -s))
        assert tree.search(x[i], i, 5, []) == [(int(s[j]), int(j), int(j)) for j in order[order != i][:5]]
    assert tree.spared and tree.computed < 0.2 * 42 * len(rows)


def test_planes_are_exact():
    rng = np.random.default_rng(2)
    for low, high, dims in ((-159, 90, 64), (0, 1, 3), (-1, 0, 9), (-2 ** 20, 2 ** 20, 17), (5, 5, 1)):
        x = rng.integers(low, high + 1, (300, dims))
        planes = bit_planes.plane_count(int(x.min()), int(x.max()))
        tables = bit_planes.subset_sums(x[:7], int(np.abs(x).max()))
        assert (bit_planes.scores(tables, bit_planes.pack(x, planes)) == x @ x[:7].T).all()
