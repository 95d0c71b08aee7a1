"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file alone defines the vocabulary: each token's last merge is found by running the merges of lower rank on its
bytes, and a ``tokenizers`` BPE model is built from ranks and merges.  Each match of the split pattern is encoded
separately (runs found in numpy for ``WORD_PATTERN``, else by ``regex``); matches seen before come from a bounded table in the worker.  Token byte lengths give byte offsets, and the
byte-to-character mapping of the text turns them into character offsets (a token inside a character spans all of it).
Decoding looks bytes up per id and joins them; the text decoder keeps characters split across tokens whole.

Defined results: a null or empty text has no token; ids outside the vocabulary raise; repeated rows give one row each;
an empty table gives an empty result; extra columns are ignored.  A text that is not valid Unicode cannot occur in a
Parquet string column.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goalpost.llm import common

#: Matches a worker remembers, the longest match it remembers, and the characters encoded together.
REMEMBERED, LONGEST, TOGETHER = 600_000, 40, 1 << 22


def load_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_characters() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else the next code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


def merges(tokens: list[bytes]) -> list[tuple[bytes, bytes]]:
    """The two parts whose merge makes each token of two or more bytes, in rank order."""
    rank = {t: i for i, t in enumerate(tokens)}
    found = []
    for i, token in enumerate(tokens):
        if len(token) < 2:
            continue
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: rank.get(parts[k] + parts[k + 1], sys.maxsize))
            if rank.get(parts[best] + parts[best + 1], sys.maxsize) >= i:
                raise ValueError(f"token {i} is no merge of tokens of lower rank")
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        found.append((parts[0], parts[1]))
    return found


# fixed values: the split pattern that ``split_words`` follows, its white space and its contractions
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_CONTRACTED = ("re", "ve", "ll", "s", "t", "m", "d")


def code_point_kinds() -> np.ndarray:
    """1 letter, 2 number, 3 white space, 0 any other, by code point."""
    first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(sys.maxunicode + 1)], np.uint8)
    kind = np.where(first == ord("L"), 1, np.where(first == ord("N"), 2, 0)).astype(np.uint8)
    kind[_SPACE] = 3
    return kind


def split_words(text: str, kinds: np.ndarray) -> list[str]:
    """The matches of ``WORD_PATTERN``, found as runs of one kind of character.

    A blank that ends a run of white space before another character joins the run that follows; another white space
    character there stands alone; an apostrophe alone before a contraction's letters takes them."""
    if not text:
        return []
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds[points]
    new = np.empty(len(kind), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    last = np.flatnonzero((kind[:-1] == 3) & (kind[1:] != 3))        # the white space before a run
    new[last] = True
    new[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points[:-1] == 0x27) & new[:-1] & (kind[1:] == 1))
    for i in quote.tolist():
        tail = next((t for t in _CONTRACTED if text.startswith(t, i + 1)), None)
        if tail:
            new[i + 1] = False
            if i + 1 + len(tail) < len(kind) and kind[i + 1 + len(tail)] == 1:
                new[i + 1 + len(tail)] = True
    at = np.flatnonzero(new).tolist()
    at.append(len(text))
    return [text[a:b] for a, b in pairwise(at)]


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces ``flat[start:start + length]``, one after the other."""
    end = np.cumsum(length)
    at = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(start - (end - length), length)
    return flat[at]


class Codec:
    """Encoder and decoder of one vocabulary; built in the driver, cheap to ship, the library model made on first use."""

    def __init__(self, path: str, pattern: str):
        self.pattern = pattern
        self.tokens = load_ranks(path)
        self.merges = merges(self.tokens)
        self._model = None

    def __getstate__(self):
        return {"pattern": self.pattern, "tokens": self.tokens, "merges": self.merges, "_model": None}

    def _ready(self):
        if self._model is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"       # one core for each Spark task
            from tokenizers import Tokenizer, models, pre_tokenizers
            stand = byte_characters()
            table = str.maketrans({b: stand[b] for b in range(256)})
            spell = lambda t: t.decode("latin-1").translate(table)
            self._model = Tokenizer(models.BPE(vocab={spell(t): i for i, t in enumerate(self.tokens)},
                                               merges=[(spell(a), spell(b)) for a, b in self.merges]))
            # the library maps bytes to stand-ins; the split is ours, one match at a time
            self._model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            if self.pattern == WORD_PATTERN:
                kinds = code_point_kinds()
                self._split = lambda text: split_words(text, kinds)
            else:
                self._split = regex.compile(self.pattern).findall
            self._known: dict[str, bytes] = {}
            self._length = np.array([len(t) for t in self.tokens], np.int64)
            self._begin = np.cumsum(self._length) - self._length
            self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        return self._model

    def _remembered(self, matches: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of each distinct match; new ones go to the library and, if short, into the bounded table."""
        model, known = self._ready(), self._known
        got = list(map(known.get, matches))
        new = [i for i, v in enumerate(got) if v is None]
        for k in range(0, len(new), 4096):
            part = new[k:k + 4096]
            done = model.encode_batch_fast([matches[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, done, strict=True):
                got[i] = array("i", e.ids).tobytes()
        if len(known) + len(new) > REMEMBERED:
            known.clear()
        known.update((matches[i], got[i]) for i in new if len(matches[i]) <= LONGEST)
        return got

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text as an int32 array."""
        self._ready()
        split = [self._split(t) for t in texts]
        count = np.array([len(s) for s in split], np.int64)
        if not count.sum():
            return [np.empty(0, np.int32) for _ in texts]
        number: dict[str, int] = {}         # numbered by a dict: arrays of strings take U+0000 for their end
        code = np.fromiter((number.setdefault(m, len(number)) for m in chain.from_iterable(split)), np.int64,
                           int(count.sum()))
        del split
        ids = self._remembered(list(number))
        lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        out = ragged(flat, (np.cumsum(lens) - lens)[code], lens[code])
        per_match = np.concatenate([[0], np.cumsum(lens[code])])
        return np.split(out, per_match[np.cumsum(count)][:-1])

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Character start and end of every token of ``text``."""
        self._ready()
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        char = np.concatenate([np.cumsum((raw & 0xC0) != 0x80) - 1, [len(text)]]).astype(np.int64)
        length = self._length[np.asarray(ids, np.int64)]
        end = np.cumsum(length)
        return char[end - length], char[end - 1] + 1

    def decode_bytes(self, ids) -> bytes:
        self._ready()
        ids = np.asarray(ids, np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.tokens):
            raise ValueError("id outside the vocabulary")
        return ragged(self._bytes, self._begin[ids], self._length[ids]).tobytes()

    def decode_pieces(self, ids: list[int]) -> list[str]:
        """Text of each token; a character split across tokens appears at the token that completes it."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        pieces = [decoder.decode(self.tokens[i]) for i in ids]
        if pieces:
            pieces[-1] += decoder.decode(b"", True)
        return pieces


def _codec(df: DataFrame, path: str, pattern: str):
    return df.sparkSession.sparkContext.broadcast(Codec(path, pattern))       # the vocabulary file's size: a few MB


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """doc_id, ids, and with ``offsets`` the character starts and ends of the tokens, for every row of ``docs``."""
    shared = _codec(docs, path, pattern)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", ints)] + (
        [T.StructField("starts", ints), T.StructField("ends", ints)] if offsets else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, kind = shared.value, pa.list_(pa.int32())
        for batch in batches:
            for start, texts in common.slices(batch.column(1), TOGETHER):
                ids = codec.encode_batch(texts)
                cols = [batch.column(0).slice(start, len(texts)).cast(pa.int64()), pa.array(ids, kind)]
                if offsets:
                    spans = [codec.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                    cols += [pa.array([s[k] for s in spans], kind) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    return common.id_text(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of every row of ids; bytes that form no character become U+FFFD."""
    shared = _codec(encoded, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.decode_bytes(ids or []).decode("utf-8", "replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(encoded["doc_id"].alias("doc_id"), encoded["ids"].alias("ids"))
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", rows.schema[0].dataType),
                                              T.StructField("text", T.StringType())]))


_DIGESTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and the digests of the ids and of the bytes they decode to, for every row of ``docs``."""
    shared = _codec(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value
        spelled = [str(i) for i in range(len(codec.tokens))]
        hexed = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for start, texts in common.slices(batch.column(1), TOGETHER):
                rows = codec.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, len(texts)).cast(pa.int64()),
                    pa.array([len(ids) for ids in rows], pa.int64()),
                    pa.array([hexed(" ".join(map(spelled.__getitem__, ids.tolist())).encode()) for ids in rows], pa.string()),
                    pa.array([hexed(codec.decode_bytes(ids)) for ids in rows], pa.string())], _DIGESTS.names)

    return common.id_text(docs).mapInArrow(run, _DIGESTS)
