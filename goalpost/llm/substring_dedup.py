"""Substring dedup: content-defined chunks cut by a gear rolling hash, deduplicated by digest.

A cut follows every byte whose rolling hash of the last 16 bytes is under a bound, never closer than ``least`` bytes and
never farther than ``most``; an insertion therefore moves only the cuts near it.  Chunks are compared by 128-bit digest
and every later occurrence points at the first; neighbouring chunks whose first occurrences are neighbours too form a
run.  Each run is then extended character by character against the text of its origin, so ``min_chars`` is held against
the whole passage, not against its whole chunks.

``repeats`` returns one row per passage of at least ``min_chars`` characters, later occurrence and origin, and one row
per place of an origin that they point at.  The occurrence with the smallest (doc_id, place) is the first and is kept;
``remove`` cuts the others out of the texts.  A run is extended by at most ``BEFORE`` characters to the left and
``AFTER`` to the right (``min_chars`` if that is more); runs of one origin that meet on the way are one passage.

Defined results: null and empty texts have no chunk; equal rows repeat each other wholly; a null id sorts first and is
never the kept one of a passage that a row with an id holds too; passages only repeated inside one row are reported
with ``within`` (the query and ``remove`` ask for them); an empty table gives an empty result; extra columns are kept by
``remove`` and ignored by ``repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalpost.llm.common import broadcast_if_small, id_text, saved, slices

LEAST, MOST, SPACING, MIN_CHARS = 20, 160, 32, 128
# after a shared chunk both texts are cut alike up to their first difference; before it their cuts may be out of step
BEFORE, AFTER = 512, MOST
# bits of the map of repeated digests: 16 MB
BITS = 27
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gear_table() -> np.ndarray:
    """One mixed 32-bit number for every byte value."""
    x = np.arange(1, 257, dtype=np.uint64) * _STEP
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = gear_table()


def rolling(raw: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: the table's numbers of the last 16 bytes, each shifted two bits a step, summed by doubling."""
    h = _GEAR[raw]
    for k in (1, 2, 4, 8):
        if len(h) > k:
            earlier = h[:-k] << np.uint32(2 * k)
            h = h.copy()
            h[k:] += earlier
    return h


def cuts(raw: np.ndarray, least: int = LEAST, most: int = MOST, spacing: int = SPACING) -> list[int]:
    """Ends of the chunks of a text's bytes."""
    n, out, last = len(raw), [], 0
    for end in (np.flatnonzero(rolling(raw) < np.uint32((1 << 32) // spacing)) + 1).tolist():
        while end - last > most:
            last += most
            out.append(last)
        if end - last >= least:
            out.append(end)
            last = end
    while n - last > most:
        last += most
        out.append(last)
    if last < n:
        out.append(n)
    return out


def repeated_bits(digests: DataFrame) -> np.ndarray:
    """A bit map (2^``BITS`` bits, so bounded) with the bit of every d1 that occurs twice or more set."""
    twice = digests.groupBy("d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    at = F.col("d1").bitwiseAND(F.lit((1 << BITS) - 1))
    part = F.shiftright(at, 15).cast("int").alias("part")
    rows = (twice.select(part, at.bitwiseAND(F.lit(32767)).alias("bit")).groupBy("part")
                 .agg(F.bitmap_construct_agg("bit").alias("bits")).collect())       # at most 2^(BITS - 15) rows of 4 KB
    out = np.zeros((1 << (BITS - 15), 4096), np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.ravel()


def chunks(docs: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """doc_id, row, character start and end, and digest (d1, d2) of every chunk of ``docs`` (doc_id, text, row).

    With ``bits`` (``repeated_bits``) only chunks whose bit is set: all repeated ones, and few others."""
    marked = None if bits is None else docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).cast(pa.int64()).to_pylist(), batch.column(2).to_pylist()
            for start, texts in slices(batch.column(1), 1 << 21):
                owner, lo, hi, digests = [], [], [], []
                for i, t in enumerate(texts):
                    data = t.encode("utf-8", "surrogatepass")
                    raw = np.frombuffer(data, np.uint8)
                    ends = cuts(raw)
                    if not ends:
                        continue
                    char = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    at = np.array([0, *ends])
                    digests += [hashlib.blake2b(data[a:b], digest_size=16).digest()
                                for a, b in zip(at[:-1].tolist(), ends, strict=True)]
                    owner.append(np.full(len(ends), start + i))
                    lo.append(char[at[:-1]])
                    hi.append(char[at[1:]])
                if not owner:
                    continue
                owner, lo, hi = np.concatenate(owner), np.concatenate(lo), np.concatenate(hi)
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                if marked is not None:
                    at = d[:, 0] & ((1 << BITS) - 1)
                    keep = (marked.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    owner, lo, hi, d = owner[keep], lo[keep], hi[keep], d[keep]
                owner = owner.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in owner], pa.int64()), pa.array([rows[i] for i in owner], pa.int64()),
                     pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
                     pa.array(d[:, 0]), pa.array(d[:, 1])], ["doc_id", "row", "start", "end", "d1", "d2"])

    return docs.mapInArrow(run, "doc_id long, row long, start int, end int, d1 long, d2 long")


def contexts(texts: DataFrame, runs: DataFrame, before: int, after: int) -> DataFrame:
    """Written: row, start, end, o_row, shift of every run, and row, start, end of every place of an origin once (the others
    null), with doc_id and the text before and after it."""
    origins = runs.select(F.col("o_row").alias("row"), (F.col("start") - F.col("shift")).alias("start"),
                          (F.col("end") - F.col("shift")).alias("end")).distinct()
    places = runs.select("row", "start", "end", "o_row", "shift").unionByName(origins, allowMissingColumns=True)
    spans = saved(places.groupBy("row").agg(F.collect_list(F.struct("start", "end", "o_row", "shift")).alias("spans")),
                  "spans")
    texts = texts.join(broadcast_if_small(spans.select("row")), "row", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "end", "o_row", "shift", "doc_id", "left", "right"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            out = []
            for row, doc_id, text, found in zip(*batch.columns, strict=True):
                row, doc_id, t = row.as_py(), doc_id.as_py(), text.as_py()
                for span in found.as_py():
                    a, b = span["start"], span["end"]
                    out.append((row, a, b, span["o_row"], span["shift"], doc_id, t[max(0, a - before):a], t[b:b + after]))
                    if len(out) == 4096:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return saved(texts.join(spans, "row").select("row", "doc_id", "text", "spans").mapInArrow(
        run, "row long, start int, end int, o_row long, shift int, doc_id long, left string, right string"),
        "contexts", "zstd")


def common(a: str, b: str) -> int:
    """Characters that two texts have in common at their starts."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _extended(runs: DataFrame) -> DataFrame:
    """The runs with their start and end moved to where their text and the origin's differ."""
    names = ["doc_id", "row", "start", "end", "o_doc_id", "o_row", "shift"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, o_left, o_right = (c.to_pylist() for c in batch.columns[7:11])
            start = np.array([common(a[::-1], b[::-1]) for a, b in zip(left, o_left, strict=True)], np.int32)
            end = np.array([common(a, b) for a, b in zip(right, o_right, strict=True)], np.int32)
            cols = list(batch.columns[:7])
            cols[2] = pa.array(cols[2].to_numpy() - start)
            cols[3] = pa.array(cols[3].to_numpy() + end)
            yield pa.RecordBatch.from_arrays([*cols, *batch.columns[2:4]], [*names, "lo", "hi"])

    return runs.select(*names, "left", "right", "o_left", "o_right").mapInArrow(
        run, "doc_id long, row long, start int, end int, o_doc_id long, o_row long, shift int, lo int, hi int")


def _unexplained(found: DataFrame) -> DataFrame:
    """The passages without those that a passage of the same row with an earlier origin explains: it holds all their
    whole chunks (lo to hi) and all but fewer than LEAST characters.  Copies cut out of step with the first one would
    otherwise name each other as origins."""
    names = ["doc_id", "start", "end", "o_doc_id", "o_row", "shift"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans.sort(key=lambda s: (s["o_doc_id"] is None, s["o_doc_id"] or 0, s["o_row"], s["start"] - s["shift"]))
                kept, n = np.empty((2, len(spans)), np.int64), 0
                for s in spans:
                    a, b = kept[:, :n]
                    rest = np.maximum(a - s["start"], 0) + np.maximum(s["end"] - b, 0)
                    if not ((a <= s["lo"]) & (b >= s["hi"]) & (rest < LEAST)).any():
                        kept[:, n] = s["start"], s["end"]
                        n += 1
                        out.append({"row": row, **{k: s[k] for k in names}})
            yield pa.RecordBatch.from_pylist(out, kinds)

    kinds = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                       ("o_doc_id", pa.int64()), ("o_row", pa.int64()), ("shift", pa.int32())])
    return (found.groupBy("row").agg(F.collect_list(F.struct(*names, "lo", "hi")).alias("spans")).mapInArrow(
        run, "row long, doc_id long, start int, end int, o_doc_id long, o_row long, shift int"))


def _joined(spans: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """The spans of each group of ``by``, those that meet or overlap as one."""
    ordered = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    return (spans.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
                 .withColumn("span", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
                 .groupBy(*by, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), *more).drop("span"))


def _later(texts: DataFrame, min_chars: int, within: bool) -> DataFrame:
    """Written: row, doc_id, start, end, o_doc_id, o_row, shift of every later occurrence of a repeated passage in a
    written (doc_id, text, row) table."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start")
    # the first pass exchanges half a digest a chunk; the second only the chunks that may be repeated
    seen = saved(chunks(texts, repeated_bits(chunks(texts).select("d1"))), "chunks")
    shared = (seen.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("lo"),
                                           F.max("row").alias("hi"), F.min(place).alias("at"))
                  .where("n > 1" if within else "lo != hi")
                  .select("d1", "d2", F.col("at.row").alias("o_row"), F.col("at.start").alias("o_start")))
    later = (seen.select("row", "start", "end", "d1", "d2").join(shared, ["d1", "d2"])
                 .where("row != o_row or start != o_start")
                 .select("row", "o_row", (F.col("start") - F.col("o_start")).alias("shift"), "start", "end"))
    # adjacent chunks whose first occurrences are adjacent too lie on one line (row, origin row, shift)
    line = ["row", "o_row", "shift"]
    runs = saved(_joined(later, line), "runs")
    # one exchange of the runs with their texts, to those of their origins, of which each place is there once
    around = contexts(texts, runs, max(BEFORE, min_chars), max(AFTER, min_chars))
    own = around.where("shift is not null").select(
        "*", (F.col("start") - F.col("shift")).alias("o_start"), (F.col("end") - F.col("shift")).alias("o_end"))
    theirs = around.where("shift is null").select(
        F.col("row").alias("o_row"), *(F.col(c).alias(f"o_{c}") for c in ("start", "end", "doc_id", "left", "right")))
    both = own.join(theirs, ["o_row", "o_start", "o_end"])
    found = _joined(_extended(both), ["doc_id", "o_doc_id", *line], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return saved(_unexplained(found.where(F.col("end") - F.col("start") >= min_chars)), "passages")


def repeats(docs: DataFrame, min_chars: int = MIN_CHARS, within: bool = False) -> DataFrame:
    """doc_id, start, end, n_chars, first_doc_id, first_start, first of every occurrence of a repeated passage.

    ``within`` also counts passages whose occurrences all lie in one row."""
    found = _later(saved(id_text(docs).withColumn("row", F.monotonically_increasing_id()), "texts", "zstd"), min_chars, within)
    origin = [(F.col("start") - F.col("shift")).alias("start"), (F.col("end") - F.col("shift")).alias("end")]
    first = _joined(found.select(F.col("o_doc_id").alias("doc_id"), F.col("o_row").alias("row"), *origin).distinct(),
                    ["doc_id", "row"])
    n_chars = (F.col("end") - F.col("start")).alias("n_chars")
    return found.select("doc_id", "start", "end", n_chars, F.col("o_doc_id").alias("first_doc_id"),
                        (F.col("start") - F.col("shift")).alias("first_start"), F.lit(False).alias("first")).unionAll(
        first.select("doc_id", "start", "end", n_chars, F.col("doc_id").alias("first_doc_id"),
                     F.col("start").alias("first_start"), F.lit(True).alias("first")))


def remove(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with every later occurrence of a repeated passage cut out, row by row: also among rows that repeat an id
    or have none, the first occurrence stays."""
    rows = saved(docs.select(F.struct(*docs.columns).alias("doc")).withColumn("row", F.monotonically_increasing_id()),
                 "rows", "zstd")
    later = _later(rows.select("doc.doc_id", "doc.text", "row"), min_chars, within=True)
    spans = (_joined(later.select("row", "start", "end"), ["row"]).groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cut_spans")))
    # pieces between the spans: from the end of one to the start of the next
    cut = rows.join(spans, "row", "left")
    ends = F.concat(F.array(F.lit(0)), F.col("cut_spans.end"))
    starts = F.concat(F.col("cut_spans.start"), F.array(F.length("doc.text")))
    pieces = F.zip_with(ends, starts, lambda a, b: F.substring(F.col("doc.text"), a + 1, b - a))
    text = F.when(F.col("cut_spans").isNull(), F.col("doc.text")).otherwise(F.array_join(pieces, ""))
    return cut.select(*[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
