"""Secret scans: base patterns, then a character convolutional network over every other candidate in its context.

A candidate is a maximal run of 16 or more key characters.  Candidates that a base pattern covers are the labelled
findings (class 1), all others class 0; all different windows of both, with random re-spellings of the findings so that
the network does not learn their alphabet alone, train the network: they are dealt to buckets of bounded size by digest,
in each round every bucket goes once over its windows from the shared parameters, and the mean of the buckets'
parameters starts the next round.  A held-back quarter of all windows gives the Platt calibration and the threshold: the
middle between the highest probability that still finds ``recall`` of the held-back findings and the next held-back other
candidate below it.  Scoring runs in
Arrow batches over whole texts; each candidate not covered by a base span whose probability reaches the threshold adds
a span of kind ``network``.

Defined results: a null or empty text has no span; repeated rows give one row each; overlapping spans of different
kinds are all listed; with fewer than five different findings in all texts the network adds nothing; extra columns are
kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goalpost.llm import common, linear

# fixed values of the base patterns and their least lengths
KINDS = ("assign", "access", "hex", "network")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS = 8

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_LEFT, _HEAD, _TAIL, _RIGHT = 16, 24, 16, 8
_STRIDE = 8             # characters between the pieces of a long run
_WIDTH = _LEFT + _HEAD + _TAIL + _RIGHT
_ALPHABET = "\x00abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-\"': \n"
_CODE = np.full(256, len(_ALPHABET), np.uint8)
for _i, _c in enumerate(_ALPHABET):
    _CODE[ord(_c)] = _i
_INSIDE = np.zeros(_WIDTH, np.float32)
_INSIDE[_LEFT:_LEFT + _HEAD + _TAIL] = 1
# parameters are averaged as multiples of its inverse
_UNIT = float(1 << 40)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, code points, end exclusive, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, covered by a base span) of every candidate."""
    joined, at, out = merged([(a, b) for _, a, b in spans]), 0, []
    for m in _CANDIDATE.finditer(text):
        while at < len(joined) and joined[at][1] <= m.start():
            at += 1
        out.append((m.start(), m.end(), at < len(joined) and joined[at][0] < m.end()))
    return out


def window(text: str, start: int, end: int) -> bytes:
    """Codes of the context before, the run's head and tail, and the context after; absent places are 0."""
    left = text[max(0, start - _LEFT):start].rjust(_LEFT, "\x00")
    head = text[start:min(end, start + _HEAD)].ljust(_HEAD, "\x00")
    tail = text[max(start + _HEAD, end - _TAIL):end].ljust(_TAIL, "\x00")
    right = text[end:end + _RIGHT].ljust(_RIGHT, "\x00")
    raw = (left + head + tail + right).encode("latin-1", "replace")
    return _CODE[np.frombuffer(raw, np.uint8)].tobytes()


def windows_of(text: str, start: int, end: int) -> list[bytes]:
    """The window of a run; for a run longer than a window holds, also those of overlapping pieces of all of it."""
    size = _HEAD + _TAIL
    pieces = [*range(start, end - size, _STRIDE), end - size] if end - start > size else []
    return [window(text, start, end), *(window(text, s, s + size) for s in pieces)]


@dataclass(frozen=True)
class Network:
    embed: np.ndarray       # (symbols, e)
    filters: np.ndarray     # (width * (e + 1), f)
    bias: np.ndarray
    out: np.ndarray         # (2 f,)
    shift: float

    def forward(self, codes: np.ndarray):
        x = np.concatenate([self.embed[codes], np.broadcast_to(_INSIDE[None, :, None], (*codes.shape, 1))], axis=2)
        width = len(self.filters) // x.shape[2]
        views = np.lib.stride_tricks.sliding_window_view(x, width, axis=1).transpose(0, 1, 3, 2)
        views = views.reshape(len(codes), views.shape[1], -1)
        act = np.maximum(views @ self.filters + self.bias, 0)
        top = act.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(act, top[:, None, :], 1)[:, 0], act.mean(axis=1)], axis=1)
        return views, act, top, pooled, pooled @ self.out + self.shift


@dataclass(frozen=True)
class Model:
    network: Network | None
    scale: float
    shift: float
    threshold: float
    recall: float = 1.0             # of the held-back findings and their re-spellings, at the threshold
    false_positives: float = 0.0    # share of the held-back other candidates that reach it

    def probability(self, windows: list[bytes]) -> np.ndarray:
        if self.network is None or not windows:
            return np.zeros(len(windows))
        return linear.sigmoid(self.scale * self.margin(_codes(windows)) + self.shift)

    def margin(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.network.forward(codes[i:i + 1024])[4] for i in range(0, len(codes), 1024)]
        return np.concatenate(parts).astype(np.float64)

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """All spans of each text, one network call for the whole list."""
        base = [base_spans(t) for t in texts]
        open_, first, windows = [], [], []
        for i, t in enumerate(texts):
            for a, b, covered in candidates(t, base[i]):
                if not covered:
                    open_.append((i, a, b))
                    first.append(len(windows))
                    windows += windows_of(t, a, b)
        added: list[list[Span]] = [[] for _ in texts]
        best = np.maximum.reduceat(self.probability(windows), first) if first else []
        for (i, a, b), p in zip(open_, best, strict=True):
            if self.network is not None and p >= self.threshold:
                added[i].append((KINDS[3], a, b))
        return [sorted(x + y, key=lambda s: (s[1], KINDS.index(s[0]))) if y else x
                for x, y in zip(base, added, strict=True)]


@dataclass
class State:
    """Parameters of a network in training and Adam's moments."""
    p: dict[str, np.ndarray]
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    steps: int = 0

    @staticmethod
    def new(embed: int = 8, width: int = 5, filters: int = 24, seed: int = 7) -> State:
        rng = np.random.default_rng(seed)
        n_sym = len(_ALPHABET) + 1
        p = {"embed": rng.normal(0, 0.3, (n_sym, embed)), "filters": rng.normal(0, 0.2, (width * (embed + 1), filters)),
             "bias": np.zeros(filters), "out": rng.normal(0, 0.2, 2 * filters), "shift": np.zeros(1)}
        p = {k: v.astype(np.float32) for k, v in p.items()}
        return State(p, *({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2)))

    def network(self) -> Network:
        p = self.p
        return Network(p["embed"], p["filters"], p["bias"], p["out"], float(p["shift"][0]))

    def flat(self) -> np.ndarray:
        return np.concatenate([d[k].ravel() for d in (self.p, self.first, self.second) for k in sorted(d)])

    def of(self, flat: np.ndarray, steps: int) -> State:
        """A state of this one's shapes from its numbers."""
        at, out = 0, []
        for d in (self.p, self.first, self.second):
            new = {}
            for k in sorted(d):
                new[k] = flat[at:at + d[k].size].reshape(d[k].shape).astype(np.float32)
                at += d[k].size
            out.append(new)
        return State(*out, steps)


def train_epoch(state: State, codes: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of mini-batch Adam on the class-balanced logistic loss, gradients written out."""
    p, first, second = state.p, state.first, state.second
    embed, filters = p["embed"].shape[1], p["filters"].shape[1]
    width = len(p["filters"]) // (embed + 1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    order = rng.permutation(len(y))
    for i in range(0, len(y), 64):
        at = order[i:i + 64]
        net = state.network()
        views, act, top, pooled, margin = net.forward(codes[at])
        err = ((linear.sigmoid(margin) - y[at]) * weight[at] / len(at)).astype(np.float32)
        back = err[:, None] * p["out"]
        g_act = np.repeat(back[:, None, filters:] / act.shape[1], act.shape[1], axis=1)
        peak = np.take_along_axis(g_act, top[:, None, :], 1) + back[:, None, :filters]
        np.put_along_axis(g_act, top[:, None, :], peak, 1)
        g_act = g_act * (act > 0)
        g_views = (g_act @ p["filters"].T).reshape(len(at), act.shape[1], width, embed + 1)[..., :embed]
        g_embed = np.zeros_like(p["embed"])
        for k in range(width):
            np.add.at(g_embed, codes[at][:, k:k + act.shape[1]], g_views[:, :, k])
        grads = {"embed": g_embed, "out": pooled.T @ err, "shift": np.array([err.sum()]),
                 "filters": np.einsum("nlv,nlf->vf", views, g_act, optimize=True), "bias": g_act.sum(axis=(0, 1))}
        state.steps += 1
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            step = first[k] / (1 - 0.9 ** state.steps) / (np.sqrt(second[k] / (1 - 0.999 ** state.steps)) + 1e-8)
            p[k] = (p[k] - 0.01 * step - 1e-5 * p[k]).astype(np.float32)


def _respelled(codes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Findings with their run spelled anew from one of three key alphabets, shortened to a random length of 20 or more
    characters, and half the time without their context."""
    out = codes.copy()
    pools = [_CODE[np.frombuffer(s.encode(), np.uint8)] for s in (
        "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
        "abcdefghijklmnopqrstuvwxyz0123456789")]
    words = _CODE[np.frombuffer(b"the of and er in on re at es or th an ing ", np.uint8)]
    for row in out:
        run = np.flatnonzero((_INSIDE > 0) & (row > 0))
        row[run] = rng.choice(pools[rng.integers(len(pools))], len(run))
        row[run[rng.integers(min(20, len(run)), len(run) + 1):]] = 0
        if rng.random() < 0.5:
            row[:_LEFT] = rng.choice(words, _LEFT)
            row[_LEFT - 1] = _CODE[ord(" ")]
    return out


def _order(window: bytes) -> bytes:
    return hashlib.blake2b(window, digest_size=8).digest()


def _held(window: bytes, few: frozenset[bytes] | None) -> bool:
    """Whether a window calibrates and is not learnt from: a quarter by digest; of ``few`` findings only the first ones."""
    if few is not None and window in few:
        return True
    return few is None and _order(window + b"held")[0] % 4 == 0


def _seeded(windows: list[bytes], *seed: int) -> np.random.Generator:
    """The same for the same windows, whatever partition holds them."""
    return np.random.default_rng([*seed, len(windows), int.from_bytes(_order(windows[0]), "big")])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """bucket, windows and labels of every bucket; rows (bucket, window, label) of a partition come by bucket."""
    bucket, held = None, []
    for batch in batches:
        for b, w, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket and held:
                held.sort()
                yield bucket, [w for w, _ in held], np.array([k for _, k in held], np.int64)
                held = []
            bucket = b
            held.append((bytes(w), k))
    if held:
        held.sort()
        yield bucket, [w for w, _ in held], np.array([k for _, k in held], np.int64)


def _codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, _WIDTH)


def windows_found(docs: DataFrame) -> DataFrame:
    """All different (window, label) of all texts, with the digest ``place``."""
    def findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[bytes, int]] = set()

        def out() -> pa.RecordBatch:
            rows = sorted(held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.binary()),
                 pa.array([int.from_bytes(_order(w), "big", signed=True) for w, _ in rows], pa.int64()),
                 pa.array([k for _, k in rows], pa.int32())], ["window", "place", "label"])

        for batch in batches:
            for _, texts in common.slices(batch.column(1)):
                for t in texts:
                    for a, b, covered in candidates(t, base_spans(t)):
                        held.update((w, int(covered)) for w in ([window(t, a, b)] if covered else windows_of(t, a, b)))
                        if len(held) >= 1 << 15:
                            yield out()
            if held:
                yield out()

    return common.id_text(docs).mapInArrow(findings, "window binary, place long, label int").distinct()


def fit(docs: DataFrame, bucket_rows: int = 4_000, recall: float = 0.99, epochs: int = 8, seed: int = 7) -> Model:
    """Every text is searched and every different window of both classes is learnt from or calibrates.

    Buckets hold ``bucket_rows`` to twice as many windows; a finding is in as many buckets as it takes for each to hold
    ``bucket_rows`` / 8 of them (all, if need be)."""
    found = common.saved(windows_found(docs), "secret-findings")
    sizes = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sizes.get(1, 0) < 5 or not sizes.get(0, 0):
        return Model(None, 1.0, 0.0, 1.0)
    buckets = max(1, sum(sizes.values()) // bucket_rows)
    copies = min(buckets, max(1, -(-buckets * (bucket_rows // 8) // sizes[1])))
    dealt = found.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies - 1).otherwise(0))))
    place = F.pmod(F.col("place"), F.lit(buckets)) + F.floor(F.col("__copy") * F.lit(buckets) / F.lit(copies))
    dealt = dealt.select(F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"), "window", "label")
    dealt = dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    few = None
    if sizes[1] < 64:       # so few that chance could hold back none or all of them
        rows = found.where("label = 1").orderBy("place", "window").select("window").collect()
        few = frozenset(bytes(r["window"]) for r in rows[:max(1, len(rows) // 4)])

    def calibrates(window: bytes, label: int) -> bool:
        return _held(window, few if label else None)

    def learn(state: State, turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, windows, y in _by_bucket(batches):
                free = ~np.array([calibrates(w, k) for w, k in zip(windows, y, strict=True)])
                if len(set(y[free].tolist())) < 2:
                    continue
                codes, rng = _codes(windows), _seeded(windows, seed, turn)      # new spellings each round
                true = codes[free & (y == 1)]
                spelled = np.concatenate([_respelled(true, rng) for _ in range(max(1, min(150, 1500 // len(true))))])
                own = state.of(state.flat(), state.steps)
                train_epoch(own, np.concatenate([codes[free], spelled]),
                            np.concatenate([y[free], np.ones(len(spelled), np.int64)]),
                            np.random.default_rng([seed, turn, bucket]))
                # whole numbers: their sum does not depend on the order of the buckets
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own.steps], pa.int64()),
                     pa.array([np.rint(own.flat() * _UNIT).astype(np.int64).tolist()], pa.list_(pa.int64()))],
                    ["steps", "state"])
        return run

    state = State.new(seed=seed)
    for turn in range(epochs):
        ended = dealt.mapInArrow(learn(state, turn), "steps long, state array<long>")
        rows = (ended.select("steps", F.posexplode("state").alias("at", "v")).groupBy("at")
                     .agg(F.sum("v").alias("v"), F.sum("steps").alias("steps"), F.count(F.lit(1)).alias("n"))
                     .orderBy("at").collect())
        if not rows:
            return Model(None, 1.0, 0.0, 1.0)
        n = rows[0]["n"]
        state = state.of(np.array([r["v"] for r in rows], np.float64) / n / _UNIT, round(rows[0]["steps"] / n))
    net = state.network()
    spellings = max(3, min(200, 2000 // sizes[1]))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(bytes(w), k) for w, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            rows = [r for r in rows if calibrates(*r)]
            codes, y = [], []
            for w, k in rows:
                one = _codes([w])
                codes.append(one)
                if k:       # recall holds for new spellings too
                    codes.append(_respelled(np.repeat(one, spellings, axis=0), _seeded([w], seed + 1)))
                y += [k] * (1 + spellings if k else 1)
            got = Model(net, 1.0, 0.0, 1.0).margin(np.concatenate(codes)) if codes else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.float64()), pa.array(y, pa.int32())], ["margin", "y"])

    held = common.saved(found.select("window", "label").mapInArrow(margins, "margin double, y int"), "secret-margins")
    margin, y, weight = linear.margin_counts(held, (1, 1))
    a, b = linear.fit_platt(margin, y, weight, 200, float(weight.sum())) if len(set(y.tolist())) == 2 else (1.0, 0.0)
    n = {k: int(weight[y == k].sum()) for k in (0, 1)}
    # the margin that still finds ``recall`` of all held-back findings, moved to the middle of the gap below it
    least = linear.value_at(held.where("y = 1"), "margin", int((n[1] - 1) * (1 - recall)))
    below = held.where((F.col("y") == 0) & (F.col("margin") < least)).agg(F.max("margin")).first()[0]
    least = least if below is None else (least + below) / 2
    hit = {r["y"]: r["n"] for r in held.where(F.col("margin") >= least).groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Model(net, float(a), float(b), float(linear.sigmoid(a * least + b)), hit[1] / n[1],
                 hit.get(0, 0) / n[0] if n[0] else 0.0)


_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()),
                        T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
                        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                        T.StructField("n_network", T.LongType())])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, texts in common.slices(batch.column(1)):
                for spans in model.spans(texts):
                    base = [s for s in spans if s[0] != KINDS[3]]
                    n = [sum(s[0] == k for s in spans) for k in KINDS]
                    rows.append((*n[:3], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), n[3]))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                _SCHEMA.names)

    return common.id_text(docs).mapInArrow(run, _SCHEMA)


def redacted(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for a, b in merged([(a, b) for _, a, b in spans]):
        out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def redact(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """Every row of ``docs`` with each found span replaced by ``mark``; ``n_chars``, if present, counts the new text."""
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            changed = {}
            for start, part in common.slices(batch.column(at)):
                for i, spans in enumerate(model.spans(part)):
                    if spans:
                        changed[start + i] = redacted(part[i], spans, mark)
            cols = list(batch.columns)
            if changed:
                cols[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], cols[at].type)
                if count is not None:
                    n = cols[count].to_pylist()
                    cols[count] = pa.array([len(changed[i]) if i in changed else v for i, v in enumerate(n)],
                                           cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
