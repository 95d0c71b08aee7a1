"""Cross-tokenizer alignment against the libraries on whole texts and a plain walk over all token pairs."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from goalpost.llm import queries, token_align
from tests.conftest import SF_SMALL

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = ["a  b", "a ", " ", "   ", "x▁y", "x<|endoftext|>y", "\x00a!\x00\x00!", "b!\x00x", "Ａﬁ ①", "日本語 テスト",
       "'s 'll I'm  \n\n x\t\t y", "<s> </s> <unk>", "<0x41>", " lead  ", "é́ combining", " x  y", "🙂🙂 z"]
SCHEMA = "doc_id long, text string, row string, pair int, times int"


def brute(rows):
    """Every document by the libraries on its whole text and a comparison of all byte ranges."""
    byte_level, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    byte_level.encode_special_tokens = True
    stand = token_align.ByteLevel(A).tokens
    piece = [bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in enumerate(pieces.id_to_piece(i) for i in range(pieces.get_piece_size()))]
    done, counts = [], Counter()
    for i, text in rows:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        spelled = (" " + (text or "")).encode()
        if b"".join(stand[x] for x in a) != spelled or b"".join(piece[x] for x in b) != spelled:
            a, b = [], []
        ea, eb = (np.cumsum([0] + [len(t[x]) for x in ids]) for t, ids in ((stand, a), (piece, b)))
        over = np.argwhere((ea[:-1, None] < eb[None, 1:]) & (eb[None, :-1] < ea[1:, None])) if a else []
        links = [(a[x], b[y]) for x, y in over]
        counts.update(links)
        cuts = sorted(set(ea[1:].tolist()) & set(eb[1:].tolist()))
        at, groups = (0, 0), []
        for c in cuts:
            to = int(np.searchsorted(ea, c)), int(np.searchsorted(eb, c))
            groups.append("|".join(",".join(map(str, ids[s:e])) for ids, s, e in zip((a, b), at, to, strict=True)))
            at = to
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        done.append((i, len(a), len(b), len(cuts), links, digest))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return Counter((i, na, nb, ng, len(ln), sum(counts[p] == most[p[1]] for p in ln), sum(counts[p] for p in ln), d)
                   for i, na, nb, ng, ln, d in done)


def rows_of(df):
    return Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in df.collect())


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 3000]
    return [*short, *((10 ** 6 + i, t) for i, t in enumerate(ODD)), (1, None), (1, ""), (None, "no id"), (7, "same"),
            (7, "same"), (7, "same")]


@pytest.mark.parametrize("head", [1 << 20, 300, 0])
def test_link_counts_match_brute_force(spark, texts, head, monkeypatch):
    """``head`` 0 sends every pair through the shuffle join, 300 some."""
    monkeypatch.setattr(token_align, "HEAD", head)
    df = spark.createDataFrame([(*t, "x", 1, 2) for t in texts], SCHEMA)
    assert rows_of(token_align.link_counts(df, A, B)) == brute(texts)


def test_pair_table_counts_all_links(spark, texts):
    df = spark.createDataFrame([(*t, "x", 1, 2) for t in texts], SCHEMA)
    table = token_align.pair_table(df, A, B).collect()
    assert len({(r.a, r.b) for r in table}) == len(table)
    assert sum(r.n for r in table) == sum(r[4] * n for r, n in brute(texts).items())
    best = {}
    for r in table:
        best[r.b] = max(best.get(r.b, 0), r.n)
    assert all(r.best == (r.n == best[r.b]) for r in table)


def test_groups_are_spans_of_equal_bytes(spark):
    df = spark.createDataFrame([(1, "The quick brown fox"), (2, None)], "doc_id long, text string")
    r = {x.doc_id: x for x in token_align.align(df, A, B).collect()}
    aligner = token_align.Aligner(A, B)
    spell = lambda ids, side: b"".join(side.tokens[i] for i in ids)
    one = r[1]
    for a, a2, b, b2 in zip(one.first_a, [*one.first_a[1:], None], one.first_b, [*one.first_b[1:], None], strict=True):
        assert spell(one.ids_a[a:a2], aligner.a) == spell(one.ids_b[b:b2], aligner.b)
    assert r[2].ids_a == [] and r[2].first_b == []


def test_random_ends_match_a_plain_walk():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        keep = rng.random() ** 2
        ea = np.append(np.flatnonzero(rng.random(n) < 0.2 + keep * 0.8), n)
        eb = np.where(rng.random(len(ea)) < 0.05 + 0.2 * keep, ea + 1, ea)[:-1] if rng.random() < 0.8 else np.flatnonzero(
            rng.random(n) < 0.4)
        eb = np.append(np.unique(eb[eb < n]), n)
        runs, groups = token_align.diagonal_runs(ea, eb)
        starts = sorted([(i + k, j + k) for i, j, c in runs for k in range(c)] + [(i, j) for i, j, _, _ in groups])
        cuts = sorted(set(ea.tolist()) & set(eb.tolist()))
        assert starts == [(0, 0)] + [(int(np.searchsorted(ea, c)) + 1, int(np.searchsorted(eb, c)) + 1) for c in cuts[:-1]]
        assert all(x > 1 or y > 1 for _, _, x, y in groups)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i * 7919 % 10007}" for i in range(60000)) + "x" * 50000
    df = spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string")
    got = token_align.link_counts(df, A, B).collect()
    assert got[0][1:] == got[1][1:] and got[0].n_links == got[0].n_a + got[0].n_b - got[0].n_groups
    assert got[0].n_a == len(Tokenizer.from_file(A).encode(" " + long).ids)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.link_counts(none, A, B).collect() == []
    assert token_align.pair_table(none, A, B).collect() == []


def test_registered_query(spark):
    df = queries.QUERIES["op11_token_align"](spark, SF_SMALL)
    assert df.columns == ["doc_id", *NAMES]


def test_runs_are_looked_up_once_for_both_sides_and_spell_as_the_libraries_do():
    byte_level, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    byte_level.encode_special_tokens = True
    aligner, rng = token_align.Aligner(A, B).ready(), np.random.default_rng(9)
    letters = [*"ab'12 \n\t.é漢", "'s", " ", " ", " ", "\xa0", "\x85", "ﬁ"]
    texts = [*ODD, *("".join(rng.choice(letters, int(n))) for n in rng.integers(1, 30, 3000))]
    stand, piece = aligner.a.tokens, aligner.b.tokens
    for _ in range(2):          # the second time from the table
        for t, (a, b) in zip(texts, aligner.tokens(texts), strict=True):
            want = byte_level.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)
            spelled = all(b"".join(s[x] for x in ids) == (" " + t).encode() for s, ids in zip((stand, piece), want, strict=True))
            assert (a.tolist(), b.tolist()) == (want if spelled else ([], [])), repr(t)
    assert {"a", "1"} & set(aligner._known) and not any(" " in r or r == "" for r in aligner._known)


def test_a_full_table_forgets_its_older_half():
    known = {str(i): b"0000" for i in range(10)}
    got = token_align._by_match([["9", "0", "new"]], known, lambda ms: [b"%04d" % len(m) for m in ms], 9)
    assert got[0].tobytes() == b"0000" + b"0001" + b"0003"
    assert list(known)[:5] == [*"56789"] and set(known) == {*"56789", "0", "new"}
