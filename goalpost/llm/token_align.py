"""Cross-tokenizer alignment: where two tokenizers cut the same bytes, and which of their tokens overlap.

Both token sequences of a text spell the same bytes, so each is an array of byte ends.  Places where both end cut the
text into groups.  The two arrays are walked along a diagonal: while token i of the one and token i + shift of the other
end together, the run is skipped by exponential probing (1, 2, 4, ... ends compared at once at the same shift); where
they part, the irregular group is resolved locally, token by token, until both end together, and the shift is updated.
Tokens of a group overlap in a staircase, so a group of x and y tokens has x + y - 1 links.

How often an id pair is linked is counted over all documents.  Each document keeps its distinct pairs with their times;
pairs with at least 1 / ``HEAD`` of all links (at most ``HEAD`` of them, by count) are looked up in a broadcast table,
the rest, of which none is frequent, by a shuffle join.

Defined results: null and empty texts, and texts whose tokens of either side do not spell the text (with its leading
space), have no tokens: zeros and an empty digest; repeated rows count each; an empty table gives an empty result; extra
columns are ignored; a text of any length is encoded match by match and aligned as a whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, islice, pairwise, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalpost.llm.byte_bpe import WORD_PATTERN, byte_characters, code_point_kinds, split_words
from goalpost.llm.common import id_text, saved, slices

#: Most pairs of the broadcast table (24 bytes each), and the distinct matches a worker remembers.
HEAD, REMEMBERED, LONGEST = 1 << 20, 300_000, 24


class ByteLevel:
    """Ids and byte lengths of a byte-level BPE file of the tokenizers library, one split match at a time."""

    def __init__(self, path: str, pattern: str = WORD_PATTERN):
        self.path, self.pattern, self._known = path, pattern, {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        table = {c: b for b, c in enumerate(byte_characters())}
        self.tokens = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        for t in spec["added_tokens"]:
            self.tokens[t["id"]] = t["content"].encode()
        for t, i in spec["model"]["vocab"].items():
            self.tokens[i] = bytes(table[c] for c in t)
        # merges made in the order of their ids: the rank library, given the ids as ranks, encodes alike and faster
        made = [spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        self.ranked = made == sorted(made) and not spec["model"].get("dropout")
        # every byte has a token and nothing changes the text before: tokens spell any text
        self.exact = spec.get("normalizer") is None and len({t for t in self.tokens if len(t) == 1}) == 256

    def __getstate__(self):
        return {"path": self.path, "pattern": self.pattern, "tokens": self.tokens, "exact": self.exact, "ranked": self.ranked, "_known": {}}

    def ready(self) -> ByteLevel:
        if not hasattr(self, "_model"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one core for each Spark task
            from tokenizers import Tokenizer, pre_tokenizers
            self._model = Tokenizer.from_file(self.path)
            self._model.encode_special_tokens = True
            self._model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            if self.ranked and self.exact:
                import tiktoken
                special = self._model.get_added_tokens_decoder()
                ranks = {t: i for i, t in enumerate(self.tokens) if i not in special}
                self._rank = tiktoken.Encoding("match", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
            kinds = code_point_kinds()
            self._split = ((lambda t: split_words(t, kinds)) if self.pattern == WORD_PATTERN
                           else regex.compile(self.pattern).findall)
        return self

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of every text; None where they do not spell it."""
        return _by_match([self._split(t) for t in texts], self._known, self._library)

    def _library(self, matches: list[str]) -> list[bytes]:
        if self.ranked and self.exact:
            return _packed([self._rank.encode_ordinary(m) for m in matches])
        out = [e.ids for e in self._model.encode_batch_fast(matches, add_special_tokens=False)]
        return _packed(out if self.exact else [ids if _spells(ids, self.tokens, m) else [] for ids, m in zip(out, matches, strict=True)])


def _spells(ids: list[int], tokens: list[bytes], text: str) -> bool:
    return b"".join(map(tokens.__getitem__, ids)) == text.encode("utf-8", "surrogatepass")


def _packed(ids: list[list[int]]) -> list[bytes]:
    """Each list as the bytes of its int32 numbers."""
    raw = np.fromiter(chain.from_iterable(ids), np.int32).tobytes()
    end = 4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
    return [raw[a:b] for a, b in pairwise([0, *end.tolist()])]


class Pieces:
    """Ids and byte strings of a sentencepiece model.  Where no piece holds a space after another character, the text is
    encoded by runs of spaces and what follows them, which the model never joins."""

    def __init__(self, path: str):
        self.path, self._known = path, {}
        model = self._load()
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.tokens = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]
        self._length = np.array([len(t) for t in self.tokens], np.int64)
        self.space = model.piece_to_id("▁")
        self.by_run = (not any(re.search("[^▁]▁", p) for p in pieces)
                       and "".join(model.encode(" a  b ", out_type=str)) == "▁▁a▁▁b▁")

    def _load(self):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def __getstate__(self):
        return {**{k: v for k, v in self.__dict__.items() if k != "_model"}, "_known": {}}

    def ready(self) -> Pieces:
        if not hasattr(self, "_model"):
            self._model = self._load()
        return self

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of every text, before which the model puts a space; None where they do not spell the space and the text."""
        if self.by_run:
            return _by_match([_runs(t) for t in texts], self._known, self._library)
        return [np.array(ids, np.int32) if _spells(ids, self.tokens, " " + t) else None
                for ids, t in zip(self._model.encode(texts, num_threads=1), texts, strict=True)]

    def _library(self, runs: list[str]) -> list[bytes]:
        # the model puts a run's first space back; a lone space would be no text
        out = [ids or [self.space] for ids in self._model.encode(runs, num_threads=1)]
        packed = _packed(out)
        flat = np.frombuffer(b"".join(packed), np.int32)
        start = np.cumsum([0, *map(len, out[:-1])])
        text = " ".join(["", *runs]).encode("utf-8", "surrogatepass")
        size = [1 + len(r.encode("utf-8", "surrogatepass")) for r in runs]
        # pieces as long as their runs that spell all runs together spell each
        if (np.array_equal(np.add.reduceat(self._length[flat], start), size)
                and b"".join(map(self.tokens.__getitem__, flat.tolist())) == text):
            return packed
        return [p if _spells(ids, self.tokens, " " + r) else b"" for p, ids, r in zip(packed, out, runs, strict=True)]


_RUN, _LOOSE = re.compile(" *[^ ]+| +"), re.compile(r" \s")


def _runs(text: str) -> list[str]:
    """Runs of spaces and what follows them of a space and the text, each without its first space."""
    if "  " in text or text.startswith(" ") or text.endswith(" "):
        return [r[1:] for r in _RUN.findall(" " + text)]
    return text.split(" ")


def _by_match(split: list[list[str]], known: dict[str, bytes], library, most: int = REMEMBERED) -> list[np.ndarray | None]:
    """Ids of the matches of each text, None if the ids of one of them do not spell it (so each is compared once, when the
    library encodes it); ``known`` remembers about ``most`` short ones, and forgets the older half when it is full."""
    if len(known) > most:
        for m in list(islice(known, len(known) // 2)):
            del known[m]
    got = [list(map(known.get, matches)) for matches in split]
    gaps = [(i, list(compress(range(len(g)), map(is_, g, repeat(None))))) for i, g in enumerate(got) if None in g]
    new = list({split[i][k] for i, places in gaps for k in places})
    unspelled = []
    for at in range(0, len(new), 512):        # few lists at once: each thousand costs a garbage collection
        part = new[at:at + 512]
        # b"" stands for a match that is not spelled: every other match has a token
        ids = library(part)
        known.update(zip(part, ids, strict=True))
        if not all(ids):
            unspelled += [m for m, i in zip(part, ids, strict=True) if not i]
    for i, places in gaps:
        matches, found = split[i], got[i]
        for k in places:
            found[k] = known[matches[k]]
    # a match that is not spelled is not remembered: only texts with new matches can hold one
    bad = {i for i, places in gaps if not all(got[i][k] for k in places)} if unspelled else ()
    for m in {*unspelled, *(m for m in new if len(m) > LONGEST)}:
        del known[m]
    return [None if i in bad else np.frombuffer(b"".join(g), np.int32) for i, g in enumerate(got)]


def diagonal_runs(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """One-to-one stretches (i, j, length) and irregular groups (i, j, tokens of a, tokens of b) of two end arrays with
    the same last end."""
    a, b, n = [*ends_a.tolist(), -1], [*ends_b.tolist(), -2], len(ends_a)     # no run goes past these
    runs, groups = [], []
    skipped, resolved = runs.append, groups.append
    i = j = 0
    while i < n:
        first, at, p, q = i, j, a[i], b[j]
        if p == q:
            i += 1
            j += 1
            step = 1
            while a[i] == b[j] and a[i:i + step] == b[j:j + step]:      # further at the same shift, twice as far each time
                i += step
                j += step
                step *= 2
            while step > 1:                                             # the parting lies in the last probe
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i += step
                    j += step
            skipped((first, at, i - first))
            continue
        while p != q:
            if p < q:
                i += 1
                p = a[i]
            else:
                j += 1
                q = b[j]
        i += 1
        j += 1
        resolved((first, at, i - first, j - at))
    return runs, groups


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of ``count`` numbers each, one after the other."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


class Aligner:
    """Encodes a text by both tokenizers and aligns the tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)

    def ready(self) -> Aligner:
        self.a.ready()
        self.b.ready()
        if not hasattr(self, "_length_a"):
            self._length_a, self._length_b = (np.array([len(t) for t in s.tokens], np.int64) for s in (self.a, self.b))
            self._words = [b"%d%s" % (i, end) for side, ends in ((self.a, (b",", b"|")), (self.b, (b",", b";")))
                           for i in range(len(side.tokens)) for end in ends]
            self._b_words, self._known = 2 * len(self.a.tokens), {}
        return self

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both id arrays of every text; empty if either side's bytes are not those of the space and the text."""
        out = [(np.empty(0, np.int32),) * 2] * len(texts)
        # where no white space follows a space, no match of the pattern reaches over a run's first space
        by_run = self.b.by_run and self.a.exact and self.a.pattern == WORD_PATTERN
        tight = [i for i, t in enumerate(texts) if t and by_run and not _LOOSE.search(f" {t} ")]
        # one table instead of two, so it may hold as much as both
        found = _by_match([texts[i].split(" ") for i in tight], self._known, self._library, 2 * REMEMBERED)
        for i, ids in zip(tight, found, strict=True):
            if ids is not None:
                out[i] = ids[ids >= 0], ~ids[ids < 0]
        there = set(tight)
        loose = [i for i, t in enumerate(texts) if t and i not in there]
        for i, a, b in zip(loose, self.a.encode([" " + texts[i] for i in loose]), self.b.encode([texts[i] for i in loose]),
                           strict=True):
            if a is not None and b is not None:
                out[i] = a, b
        return out

    def _library(self, runs: list[str]) -> list[bytes]:
        """The ids of a and the complements of those of b of every run (without its first space), b"" if it is not spelled."""
        of_a = b"".join(self.a._library(self.a._split(" ".join(["", *runs]))))
        end = np.cumsum([1 + len(r.encode("utf-8", "surrogatepass")) for r in runs])
        cut_a = 4 * (np.searchsorted(np.cumsum(self._length_a[np.frombuffer(of_a, np.int32)]), end) + 1)
        of_b = self.b._library(runs)
        cut_b = np.cumsum(np.fromiter(map(len, of_b), np.int64, len(of_b)))
        other = (~np.frombuffer(b"".join(of_b), np.int32)).tobytes()
        return [of_a[a:b] + other[c:d] if d > c else b""
                for (a, b), (c, d) in zip(pairwise([0, *cut_a.tolist()]), pairwise([0, *cut_b.tolist()]), strict=True)]

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first token of each group in a, and in b; token of a and token of b of each link)."""
        if not len(a):
            return (np.empty(0, np.int64),) * 4
        ends_a, ends_b = np.cumsum(self._length_a[a]), np.cumsum(self._length_b[b])
        runs, groups = diagonal_runs(ends_a, ends_b)
        i, j, n = np.fromiter(chain.from_iterable(runs), np.int64).reshape(-1, 3).T
        gi, gj, x, y = np.fromiter(chain.from_iterable(groups), np.int64).reshape(-1, 4).T
        run_a, run_b = _ranges(i, n), _ranges(j, n)
        start_a, start_b = np.sort(np.concatenate([run_a, gi])), np.sort(np.concatenate([run_b, gj]))
        # links of an irregular group: both first tokens, then the next token of the side whose end comes first
        inner_a, inner_b = _ranges(gi, x - 1), _ranges(gj, y - 1)
        of_b = np.sort(np.concatenate([ends_a[inner_a] * 2, ends_b[inner_b] * 2 + 1])) & 1
        count = x + y - 2
        base = np.cumsum(count) - count
        total = np.concatenate([[0], np.cumsum(of_b)])
        steps_b = total[1:] - np.repeat(total[base], count)
        steps_a = np.arange(1, len(of_b) + 1) - np.repeat(base, count) - steps_b
        return (start_a, start_b, np.concatenate([run_a, gi, np.repeat(gi, count) + steps_a]),
                np.concatenate([run_b, gj, np.repeat(gj, count) + steps_b]))

    def groups_text(self, a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3`` of the groups."""
        if not len(a):
            return b""
        mark = lambda start, n: np.bincount(start[1:] - 1, minlength=n) + (np.arange(n) == n - 1)
        last_a, last_b = mark(start_a, len(a)), mark(start_b, len(b))
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        after_a = np.append(start_a[1:], len(a))
        words = np.empty(len(a) + len(b), np.int64)
        words[np.arange(len(a)) + start_b[group_a]] = 2 * a.astype(np.int64) + last_a
        words[np.arange(len(b)) + after_a[group_b]] = self._b_words + 2 * b.astype(np.int64) + last_b
        return b"".join(map(self._words.__getitem__, words.tolist()))[:-1]


def _shared(docs: DataFrame, path_a: str, path_b: str):
    aligner = Aligner(path_a, path_b)       # two vocabularies: a few MB
    return docs.sparkSession.sparkContext.broadcast(aligner), len(aligner.b.tokens)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, both id lists, and the groups as the places of their first tokens on both sides."""
    shared, _ = _shared(docs, path_a, path_b)
    names = ["doc_id", "ids_a", "ids_b", "first_a", "first_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, kind = shared.value.ready(), pa.list_(pa.int32())
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                rows = [(a, b, *aligner.align(a, b)[:2]) for a, b in aligner.tokens(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                     *[pa.array([r[k].astype(np.int32) for r in rows], kind) for k in range(4)]], names)

    return id_text(docs).mapInArrow(run, "doc_id long, ids_a array<int>, ids_b array<int>, first_a array<int>, "
                                         "first_b array<int>")


def _documents(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, int]:
    """Written: counts and digest of every row, and its distinct linked id pairs (a * size of b + b) with their times."""
    shared, size_b = _shared(docs, path_a, path_b)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value.ready()
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                rows = []
                for a, b in aligner.tokens(texts):
                    start_a, start_b, link_a, link_b = aligner.align(a, b)
                    pairs, times = np.unique(a[link_a].astype(np.int64) * size_b + b[link_b], return_counts=True)
                    digest = hashlib.sha256(aligner.groups_text(a, b, start_a, start_b)).hexdigest() if len(a) else ""
                    rows.append((len(a), len(b), len(start_a), len(link_a), digest, pairs, times.astype(np.int32)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                     *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                     pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int32()))], names)

    out = id_text(docs).mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                        "groups_sha256 string, pairs array<long>, times array<int>")
    return saved(out.withColumn("row", F.monotonically_increasing_id()), "align-documents"), size_b


def _pair_counts(documents: DataFrame, size_b: int) -> DataFrame:
    """pair, n (links over all documents), best (n is the highest of its b id); one row for each pair that occurs."""
    each = documents.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counted = saved(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "align-counted")
    b = F.pmod("pair", F.lit(size_b))
    most = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))      # at most one row for each id of b
    return saved(counted.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
                 "align-pairs")


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a, b, n, best: how often each pair of ids is linked over all documents."""
    documents, size_b = _documents(docs, path_a, path_b)
    pairs = _pair_counts(documents, size_b)
    return pairs.select(F.expr(f"pair div {size_b}").alias("a"), F.pmod("pair", F.lit(size_b)).alias("b"), "n", "best")


def link_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    documents, size_b = _documents(docs, path_a, path_b)
    pairs = _pair_counts(documents, size_b)
    links = documents.agg(F.sum("n_links")).first()[0] or 0
    frequent = F.col("n") * HEAD >= links           # so at most HEAD pairs
    table = pairs.where(frequent).toArrow()
    key, n, best = (table[c].to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(key)
    head = documents.sparkSession.sparkContext.broadcast((key[order], n[order], best[order].astype(bool)))
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "rest", "times"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = head.value
        for batch in batches:
            pair, times = batch.column(7), batch.column(8)
            ends = pair.offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            pair, times = pair.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(key, pair)
            hit = np.zeros(len(pair), bool)
            if len(key):
                at = np.minimum(at, len(key) - 1)
                hit = key[at] == pair
            weigh = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[ends])
            of_best = np.where(hit & best[at], times, 0) if len(key) else np.zeros(len(pair), np.int64)
            summed = np.where(hit, times * n[at], 0) if len(key) else np.zeros(len(pair), np.int64)
            rest = pa.array(np.concatenate([[0], np.cumsum(~hit)])[ends].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(weigh(of_best)), pa.array(weigh(summed)),
                 pa.ListArray.from_arrays(rest, pa.array(pair[~hit])),
                 pa.ListArray.from_arrays(rest, pa.array(times[~hit]))], names)

    known = documents.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")
    part = saved(known.mapInArrow(look_up, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                           "groups_sha256 string, n_best long, count_sum long, rest array<long>, "
                                           "times array<long>"), "align-part")
    rest = part.select("row", F.explode(F.arrays_zip("rest", "times")).alias("p")).select(
        "row", F.col("p.rest").alias("pair"), "p.times")
    rare = (rest.join(pairs.where(~frequent), "pair").groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                     F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return part.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
