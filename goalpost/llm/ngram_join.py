"""N-gram Jaccard join: count vectors of hashed tokens, an R-tree on them, and exact verification.

A document's tokens are its distinct word n-grams (64-bit hashes).  Two sets link when
``100 * intersection >= percent * union``, which for sizes x and y means an overlap of at least
``ceil(p (x + y) / (100 + p))`` and so at most ``D`` tokens that only one of them has.

1. Tokens are hashed into K > D groups (K depends on a size class alone).  Linked sets differ in at most D groups, so
   they hold the same tokens in some other group: the digest of each group is a routing key and only documents that
   share one meet.  Groups without tokens route nothing: K leaves E groups to spare, and the rare sets with more than E
   empty groups also route by the tokens of their prefix under a fixed order, which linked sets must share.
2. The counts of 256 groups are the set's point.  The summed coordinate minima of two points bound their overlap.
   Every routing key first proposes one link from each member to its busiest member; proposals whose bound reaches the
   needed overlap are verified on the whole sets and give components.
3. Where a key still holds several components, an R-tree over its members' points (boxes of coordinate maxima, joined
   top-down against themselves) finds every pair across components whose bound reaches the needed overlap; a finer
   count vector of each set, about two tokens a coordinate whatever its size, bounds the overlap of those again, and
   what it leaves is verified too.  Keys with very many members are dealt out as pairs of blocks of bounded size.

No link between different sets is lost; equal sets are one node throughout.  Defined results: null and empty texts have
no token and link with nothing; a text shorter than an n-gram is one token; rows that repeat an id are one document
(its sets are joined), one result row each; a row without an id has its own size and no component; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalpost.llm.common import broadcast_if_small, id_text, saved, slices
from goalpost.llm.components import connected

GROUPS = 256            # coordinates of a point
FEW = 64                # members up to which a routing key's member list is compared with the other keys' lists
BLOCK = 4096            # members of a routing key that one task compares with one other such block
LEAF, FANOUT = 32, 8
FINEST = 8192           # most coordinates of the finer count vector
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _STEP
    h = (h ^ (h >> np.uint64(29))) * _SALT
    return h ^ (h >> np.uint64(32))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; ASCII letters lower-cased, ASCII white space between words."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = pd.util.hash_array(np.array(tokens, dtype=object), categorize=False)
    n = len(h) - width + 1
    if n <= 0:
        out = np.array([len(h)], np.uint64) * _SALT
        for x in h:
            out = out * _STEP + x
        return out
    out = h[:n].copy()
    for k in range(1, width):
        out *= _STEP
        out += h[k:n + k]
    return np.unique(mix(out))


def needed(total, percent: int):
    """Least overlap of two linked sets whose sizes add to ``total``."""
    return -(-percent * total // (100 + percent))


def size_classes(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """(largest size, groups K, spare groups E) of each class up to the one that holds ``largest``; K is 0 where two
    linked sets must be equal."""
    out, hi = [], 0
    while not out or out[-1][0] < largest:
        differ = (100 - percent) * 2 * hi // (100 + percent)
        spare = -(-differ // 12) + 1
        out.append((hi, differ + 1 + spare if differ else 0, spare))
        hi = max(hi + 1, hi * 3 // 2)
    return out


def routing_keys(tokens: np.ndarray, percent: int, classes: list[tuple[int, int, int]]) -> np.ndarray:
    """Routing keys of a set: for its own class and for every class that a larger linked set may be in."""
    n, keys = len(tokens), []
    for c, (hi, k, spare) in enumerate(classes):
        low = classes[c - 1][0] + 1 if c else 0
        if not k or hi < n or low * percent > n * 100:
            continue
        salt = np.array([c + 1], np.uint64) * _SALT
        spread = mix(tokens + salt)
        group = ((spread >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        order = np.argsort(group, kind="stable")
        found, at = np.unique(group[order], return_index=True)
        content = np.add.reduceat(mix(spread + _SALT)[order], at)
        keys.append(mix(content + (found + np.uint64(1)) * _STEP + salt))
        if k - len(found) > spare:
            prefix = np.sort(spread)[: n + (-percent * n // 100) + 1]
            keys.append(mix(prefix + _STEP + salt))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def node_of(tokens: bytes) -> int:
    """64-bit digest of a whole token set: its node (two different sets of a billion share one with chance 3 %)."""
    return int.from_bytes(hashlib.blake2b(tokens, digest_size=8).digest(), "little", signed=True)


def detail(spread: np.ndarray) -> bytes | None:
    """Counts of about half as many groups as tokens (a power of two), each group a part of one of the point's; none if
    a count is too large for a byte."""
    bits = min(max(len(spread) // 2, 1).bit_length(), FINEST.bit_length() - 1)
    count = np.bincount((spread >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return count.astype(np.uint8).tobytes() if count.max() < 256 else None


def fine_bounds(a: list[bytes | None], b: list[bytes | None], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed minima of the finer count vectors a[x[k]] and b[y[k]], at the groups of the coarsest of them; where one is
    missing, more than any overlap."""
    left, at_x = np.unique(x, return_inverse=True)
    right, at_y = np.unique(y, return_inverse=True)
    held = [a[i] for i in left.tolist()], [b[i] for i in right.tolist()]
    n = min((len(v) for side in held for v in side if v is not None), default=1)
    none = np.zeros(n, np.uint16)
    p, q = (np.stack([none if v is None else np.frombuffer(v, np.uint8).reshape(n, -1).sum(axis=1, dtype=np.uint16)
                      for v in side]) for side in held)
    out = np.minimum(p[at_x], q[at_y]).sum(axis=1, dtype=np.int64)
    missing = [np.array([v is None for v in side]) for side in held]
    out[missing[0][at_x] | missing[1][at_y]] = np.iinfo(np.int64).max
    return out


def _features(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """doc_id, n, node (digest of the token set), point, detail, and the routing keys of the first row with an id that a
    task has of a set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        classes = size_classes(percent, 1)
        for batch in batches:
            named = batch.column(0).is_valid().to_pylist()
            for start, texts in slices(batch.column(1), 1 << 22):
                size, node, point, fine, keys = [], [], [], [], []
                for t, has_id in zip(texts, named[start:], strict=False):
                    tokens = shingles(t, width)
                    if classes[-1][0] * percent < len(tokens) * 100:
                        classes = size_classes(percent, len(tokens) * 100 // percent + 1)
                    digest = node_of(tokens.tobytes())
                    size.append(len(tokens))
                    node.append(digest)
                    if not has_id or digest in sent:        # a row without an id links with nothing
                        point.append(None)
                        fine.append(None)
                        keys.append(None)
                        continue
                    if len(sent) < 1_000_000:       # only spares shuffled rows
                        sent.add(digest)
                    spread = mix(tokens)
                    point.append(np.bincount((spread >> np.uint64(56)).astype(np.int64),
                                             minlength=GROUPS).astype(np.int32))
                    fine.append(detail(spread))
                    keys.append(routing_keys(tokens, percent, classes).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).cast(pa.int64()), pa.array(size, pa.int64()),
                     pa.array(node, pa.int64()), pa.array(point, pa.list_(pa.int32())),
                     pa.array(fine, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n", "node", "point", "detail", "keys"])

    return id_text(docs).mapInArrow(
        run, "doc_id long, n long, node long, point array<int>, detail binary, keys array<long>")


def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima: at least the overlap of the two sets."""
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64)


class Tree:
    """R-tree over points sorted by size: every node keeps its coordinates' maxima and its least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, label: np.ndarray):
        order = np.lexsort((*points.T[:4], sizes))
        self.order, self.points, self.sizes, self.label = order, points[order], sizes[order], label[order]
        starts = np.arange(0, len(order), LEAF)
        level = [(np.maximum.reduceat(self.points, starts, axis=0), np.minimum.reduceat(self.sizes, starts))]
        while len(level[-1][1]) > 1:
            top, least = level[-1]
            starts = np.arange(0, len(least), FANOUT)
            level.append((np.maximum.reduceat(top, starts, axis=0), np.minimum.reduceat(least, starts)))
        self.level = level

    def join(self, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in the input order) of pairs of different labels whose bound reaches the needed overlap."""
        same = other is self
        if len(self.level) == len(other.level) == 1:
            yield from self._leaves(other, slice(None), slice(None), percent)
            return
        stack = [(len(self.level) - 1, 0, len(other.level) - 1, 0)]
        while stack:
            la, ia, lb, ib = stack.pop()
            if same and (la, ia) < (lb, ib) and la == lb:
                continue
            ta, na = self.level[la][0][ia], self.level[la][1][ia]
            tb, nb = other.level[lb][0][ib], other.level[lb][1][ib]
            if bound(ta, tb) < needed(na + nb, percent):
                continue
            if la == 0 and lb == 0:
                yield from self._leaves(other, slice(ia * LEAF, (ia + 1) * LEAF), slice(ib * LEAF, (ib + 1) * LEAF),
                                        percent)
            elif la >= lb:
                stack += [(la - 1, k, lb, ib) for k in self._children(la, ia)]
            else:
                stack += [(la, ia, lb - 1, k) for k in other._children(lb, ib)]

    def _leaves(self, other: Tree, a: slice, b: slice, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fits = (bound(self.points[a][:, None], other.points[b][None])
                >= needed(self.sizes[a][:, None] + other.sizes[b][None], percent))
        fits &= self.label[a][:, None] != other.label[b][None]
        x, y = np.nonzero(fits)
        if len(x):
            yield self.order[a][x], other.order[b][y]

    def _children(self, level: int, i: int) -> range:
        return range(i * FANOUT, min((i + 1) * FANOUT, len(self.level[level - 1][1])))


def _verified(docs: DataFrame, first: DataFrame, pairs: DataFrame, percent: int, width: int, name: str) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""
    pairs = saved(pairs, f"{name}-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    involved = saved(first.join(nodes, "node", "left_semi").select("doc_id").distinct(), f"{name}-involved")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column(1)):
                tokens = [shingles(t, width).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(t) for t in tokens], pa.int64()), pa.array(tokens, pa.binary())], ["node", "tokens"])

    texts = id_text(docs).join(broadcast_if_small(involved), "doc_id", "left_semi").select("doc_id", "text")
    # one text a node, but for ids that several rows have; their other sets find no pair here
    found = saved(texts.mapInArrow(sets, "node long, tokens binary"), f"{name}-sets")
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(found.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
                 .join(found.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b")
                 .select("a", "b", "x", "y"))
    return saved(both.mapInArrow(check, "a long, b long").distinct(), f"{name}-links")


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points' summed minima reach the needed overlap."""
    side = lambda k: points.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"),
                                   F.col("point").alias(f"p{k}"))
    most = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    total = F.col("na") + F.col("nb")
    return (pairs.join(side("a"), "a").join(side("b"), "b")
                 .where(most * (100 + percent) >= total * percent).select("a", "b"))


def _tree_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs across components proposed by the R-trees of every routing key, in blocks of bounded size."""
    blocks = F.ceil(F.col("cnt") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "n", "point", "detail", "root"))

    def pairs_of(rows: pa.Table) -> set[tuple[int, int]]:
        """Proposals of the rows of one (key, i, j)."""
        label = pd.factorize(rows["root"].to_pandas())[0]
        points = rows["point"].combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)
        sizes, node, fine = rows["n"].to_numpy(), rows["node"].to_pylist(), rows["detail"].to_pylist()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        left = right = np.arange(len(node))
        if i != j:
            own = rows["own"].to_numpy() == i
            left, right = np.flatnonzero(own), np.flatnonzero(~own)
        found = []
        if len(left) and len(right):
            a = Tree(points[left], sizes[left], label[left])
            found = a.join(a if i == j else Tree(points[right], sizes[right], label[right]), percent)
        out, step = set(), 4096
        for x, y in found:
            x, y = left[x], right[y]
            for k in range(0, len(x), step):
                u, v = x[k:k + step], y[k:k + step]
                fits = fine_bounds(fine, fine, u, v) >= needed(sizes[u] + sizes[v], percent)
                out.update((min(node[i], node[j]), max(node[i], node[j]))
                           for i, j in zip(u[fits].tolist(), v[fits].tolist(), strict=True))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by (key, i, j); the last, perhaps unfinished, one waits for the next batch
        held = None
        for batch in chain(batches, [None]):
            rows = held if batch is None else pa.Table.from_batches([batch])
            if rows is None:
                continue
            if batch is not None and held is not None:
                rows = pa.concat_tables([held, rows])
            at = [rows[k].to_numpy() for k in ("key", "i", "j")]
            cut = np.flatnonzero(np.any([a[1:] != a[:-1] for a in at], axis=0)) + 1
            edges = [0, *cut.tolist(), *([rows.num_rows] if batch is None else [])]
            got: set[tuple[int, int]] = set()
            for a, b in pairwise(edges):
                got |= pairs_of(rows.slice(a, b - a))
            held = rows.slice(edges[-1]) if batch is not None else None
            if got:
                x, y = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                 .mapInArrow(run, "a long, b long").distinct())


def link(docs: DataFrame, percent: int = 85, width: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``; see the module's text."""
    rows = saved(_features(docs, percent, width), "ngram-features")
    named = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    first = saved(named.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "ngram-nodes")
    members = _shared_keys(named)
    # a task sends each set once; equal sets from other tasks fall together here
    points = named.where(F.col("point").isNotNull()).join(
        members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min("n").alias("n"), F.min("point").alias("point"), F.min("detail").alias("detail"))
    points = saved(points, "ngram-points")

    busy = members.groupBy("node").agg(F.sum("cnt").alias("busy"))
    ranked = members.join(busy, "node")
    leader = ranked.groupBy("key").agg(F.max(F.struct("busy", "node")).alias("lead"))
    stars = (ranked.join(leader, "key").where(F.col("node") != F.col("lead.node"))
                   .select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))
                   .distinct())
    links = _verified(docs, first, _bounded(stars, points, percent), percent, width, "ngram-star")
    links = links.unionAll(_same_id(named))
    roots = saved(connected(links), "ngram-roots")

    rooted = (members.join(roots, "node", "left")
                     .withColumn("root", F.coalesce("root", "node")))
    several = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    crossing = rooted.join(several.select("key"), "key", "left_semi").join(points, "node")
    more = _verified(docs, first, _tree_pairs(crossing, percent).join(stars, ["a", "b"], "left_anti"),
                     percent, width, "ngram-tree")
    roots = saved(connected(links.unionAll(more)), "ngram-components")

    owners = first.join(roots, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    owners = roots.join(owners, "root").select("node", "component_id")
    alone = first.withColumnRenamed("doc_id", "first_id")
    return (rows.select("doc_id", "n", "node").join(alone, "node", "left").join(owners, "node", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(),
                               F.coalesce("component_id", "first_id", "doc_id")).alias("component_id")))


def _shared_keys(named: DataFrame) -> DataFrame:
    """(key, node, cnt): the members of the routing keys that two or more sets hold.

    Sets that are alike share many keys, so keys with the same few members are taken as one, named by its members."""
    n = named.select(F.explode("keys").alias("key"), "node")
    per_key = Window.partitionBy("key")
    held = saved(n.withColumn("lo", F.min("node").over(per_key)).withColumn("hi", F.max("node").over(per_key))
                  .where("lo != hi").select("key", "node").distinct()
                  .withColumn("cnt", F.count(F.lit(1)).over(per_key)), "ngram-held")
    few = (held.where(F.col("cnt") <= FEW).groupBy("key").agg(F.array_sort(F.collect_list("node")).alias("nodes"))
               .select("nodes").distinct()
               .select(F.xxhash64("nodes").alias("key"), F.explode("nodes").alias("node"),
                       F.size("nodes").cast("long").alias("cnt")))
    return saved(few.unionAll(held.where(F.col("cnt") > FEW)), "ngram-members")


def _same_id(named: DataFrame) -> DataFrame:
    """Edges between the sets of rows that repeat an id."""
    least = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("hi")).where("a != hi")
    return named.join(least, "doc_id").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b")).distinct()


def drop_copies(docs: DataFrame, percent: int = 85, width: int = 4) -> DataFrame:
    """One row of each component stays: the one with its smallest doc_id (every row without an id stays).

    Rows that repeat the kept id are one document, of which the row with the first text in order stays."""
    linked = saved(link(docs, percent, width).select("doc_id", "component_id"), "ngram-linked")
    gone = saved(linked.where("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct(),
                 "ngram-gone")
    kept = docs.join(broadcast_if_small(gone), docs["doc_id"] == gone["gone_id"], "left_anti")
    twice = saved(linked.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("twice_id"))
                        .agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("twice_id"), "ngram-twice")
    if twice.isEmpty():
        return kept
    repeated = docs["doc_id"] == twice["twice_id"]
    return (kept.join(twice, repeated, "left_anti")
                .unionByName(kept.join(twice, repeated, "left_semi").groupBy("doc_id")
                                 .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]),
                                               F.coalesce("text", F.lit(""))).alias("kept_row")).select("kept_row.*")))
