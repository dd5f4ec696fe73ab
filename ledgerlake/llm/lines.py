"""Substring deduplication by line hashing: the earliest document keeps a line, later ones lose it.

A unit is a line.  Normalised (ASCII lower-cased, runs of blank space as one blank) it
has a 128-bit digest.  Units of fewer than ``min_words`` words are never removed: short
lines repeat by chance.  Documents rank by id (nulls last), lines by position.  A unit is
removed when a document of lower rank has its digest, or an earlier line of its own
document has.  Spans are code points of the original text and take the line's newline.

Hot lines: digests are counted with partial sums, and the join that finds the later
occurrences is an equi-join that adaptive execution can split.

Defined results: a null or empty text has no units and stays as it is; rows that agree
in id and text are one document and get the same result; rows without an id rank by a
hash of their text; rows that share only an id that is not null rank alike, so a line
they share stays in both; an empty table gives an empty result.

Passages: ``drop_repeats`` also finds every run of ``PASSAGE_WORDS`` words or more that a
document of lower rank has, wherever it begins or ends and however its lines break.  Words
are compared as in lines.  Winnowing picks grams of ``GRAM`` words so that each window of
``PASSAGE_WORDS`` words holds a picked one; documents share a window only if they share its
gram.  Only windows around shared grams are then hashed (128 bits), counted and joined like
lines, so the answer is that of all windows.  A window that only its own document repeats
stays: such repeats are the lines' matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, discard, pick, shuffles_freed, staged, table_of

MIN_WORDS = 8
PASSAGE_WORDS = 51         # passages of over 50 words
GRAM = 25                  # words of a winnowed gram

_UNITS = {"doc_id": pa.int64(), "row_key": pa.int64(), "start": pa.int64(), "end": pa.int64(),
          "d1": pa.int64(), "d2": pa.int64(), "again": pa.bool_()}
_UNITS_DDL = "doc_id long, row_key long, start long, end long, d1 long, d2 long, again boolean"


def line_units(text: str, min_words: int) -> list[tuple[int, int, bytes, bool]]:
    """(start, end, digest, whether the text has it before) of each line that counts."""
    out, at, seen = [], 0, set()
    for line in text.split("\n"):
        end = at + len(line)
        words = line.encode("utf-8", "surrogatepass").lower().split()
        if len(words) >= min_words:
            digest = xxhash.xxh3_128_digest(b" ".join(words))
            out.append((at, min(end + 1, len(text)), digest, digest in seen))
            seen.add(digest)
        at = end + 1
    return out


def _units(min_words: int):
    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_slices(batch):
                out: dict[str, list] = {k: [] for k in _UNITS}
                ids, keys = part.column("doc_id").to_pylist(), part.column("row_key").to_pylist()
                for doc_id, row_key, t in zip(ids, keys, texts, strict=True):
                    for start, end, digest, again in line_units(t.decode(), min_words):
                        for k, v in zip(_UNITS, (doc_id, row_key, start, end, int.from_bytes(digest[:8], "big", signed=True),
                                                 int.from_bytes(digest[8:], "big", signed=True), again), strict=True):
                            out[k].append(v)
                yield table_of(_UNITS, out)
    return units


_LATER = "case when first is null then row_key > first_key when doc_id is null then true else doc_id > first end"


def _firsts(units: DataFrame, *digest: str) -> DataFrame:
    """Digests that documents of different rank have, with the lowest rank (first, or first_key without ids)."""
    nameless = F.when(F.col("doc_id").isNull(), F.col("row_key"))
    return units.groupBy(*digest).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min(nameless).alias("first_key"), F.max(nameless).alias("last_key")) \
        .where("first < last or first_key < last_key or (first is not null and first_key is not null)").drop("last", "last_key")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_key (hash of the text) and the spans to remove, for documents that have any."""
    base = _rows(docs, id_col, text_col)
    units = staged(base.mapInArrow(_units(min_words), _UNITS_DDL), "line-units")
    firsts = staged(_firsts(units.where(~F.col("again")), "d1", "d2"), "line-firsts")     # written, so the join below can split a hot digest
    later = units.join(firsts, ["d1", "d2"]).where("not again").where(_LATER)
    span = F.struct("start", "end")
    gone = later.select("doc_id", "row_key", span.alias("span")) \
        .unionByName(units.where("again").select("doc_id", "row_key", span.alias("span")))
    return gone.distinct().groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_list("span")).alias("removed"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))


_CLEAN_DDL = ("doc_id long, text string, removed array<struct<start:long,end:long>>, "
              "kept array<struct<start:long,end:long>>, n_removed long, chars_removed long")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_CLEAN = {"doc_id": pa.int64(), "text": pa.string(), "removed": _SPAN, "kept": _SPAN, "n_removed": pa.int64(),
          "chars_removed": pa.int64()}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out: dict[str, list] = {k: [] for k in _CLEAN}
            for text, removed in zip(part.column("text").to_pylist(), part.column("removed").to_pylist(), strict=True):
                removed, kept, last = removed or [], [], 0
                for s in [*removed, {"start": len(text or ""), "end": None}]:
                    if s["start"] > last:
                        kept.append({"start": last, "end": s["start"]})
                    last = s["end"]
                out["text"].append("".join(text[k["start"]:k["end"]] for k in kept) if removed else text)
                out["removed"].append(removed)
                out["kept"].append(kept)
                out["n_removed"].append(len(removed))
                out["chars_removed"].append(sum(s["end"] - s["start"] for s in removed))
            out["doc_id"] = part.column("doc_id").to_pylist()
            yield table_of(_CLEAN, out)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, text without repeats, removed and kept spans of the original, n_removed, chars_removed."""
    rows, spans = _rows(docs, id_col, text_col), repeated_spans(docs, id_col, text_col, min_words)
    spans = spans.toDF("_id", "_key", "removed")
    joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans["_id"]) & (rows["row_key"] == spans["_key"]), "left")
    return joined.select("doc_id", "text", "removed").mapInArrow(_cut, _CLEAN_DDL)


# ---------------------------------------------------------------- passages
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")          # as bytes.split() cuts
_GRAMS_DDL = "doc_id long, row_key long, gram long, at long"
_GRAMS = {"doc_id": pa.int64(), "row_key": pa.int64(), "gram": pa.int64(), "at": pa.int64()}
_WINDOWS_DDL = "doc_id long, row_key long, at long, d1 long, d2 long"
_WINDOWS = {"doc_id": pa.int64(), "row_key": pa.int64(), "at": pa.int64(), "d1": pa.int64(), "d2": pa.int64()}


class _Words:
    """The normalised words of a text; ``runs(starts, n)`` are the bytes of n words from each start."""

    def __init__(self, text: bytes):
        words = text.lower().split()
        self.n, self.joined = len(words), b" ".join(words)
        self.ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)

    def runs(self, starts: np.ndarray, n: int) -> Iterator[bytes]:
        lo = np.where(starts > 0, self.ends[starts - 1], 0)
        return (self.joined[a:z] for a, z in zip(lo.tolist(), (self.ends[starts + n - 1] - 1).tolist(), strict=True))


def winnowed(words: _Words, passage: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of picked grams: the least of each ``passage`` words' grams, the first of equal ones."""
    if words.n < passage:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.arange(words.n - gram + 1)
    h = np.fromiter((xxhash.xxh3_64_intdigest(r) for r in words.runs(starts, gram)), np.uint64, len(starts)).view(np.int64)
    wide = passage - gram + 1
    picked = [np.lib.stride_tricks.sliding_window_view(h[i:i + (1 << 16) + wide - 1], wide).argmin(1) for i in range(0, len(h) - wide + 1, 1 << 16)]
    at = np.unique(np.concatenate(picked) + np.arange(len(h) - wide + 1))
    return h[at], at


def _grams(passage: int, gram: int):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_slices(batch):
                for i, t in enumerate(texts):
                    h, at = winnowed(_Words(t), passage, gram)
                    if len(h):
                        yield _of_row(part, i, _GRAMS, [h, at])
    return grams


def _of_row(part: pa.RecordBatch, i: int, kinds: dict[str, pa.DataType], values: list[np.ndarray]) -> pa.RecordBatch:
    keys = [pa.repeat(part.column(c)[i], len(values[0])) for c in ("doc_id", "row_key")]
    return pa.RecordBatch.from_arrays([*keys, *[pa.array(v, pa.int64()) for v in values]], names=list(kinds))


def _windows(passage: int, gram: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in byte_slices(batch):
                for i, t in enumerate(texts):
                    words, places = _Words(t), np.array(part.column("places")[i].as_py(), np.int64)
                    covers = np.zeros(words.n + 1, np.int64)                   # windows that hold a shared gram
                    np.add.at(covers, np.maximum(places + gram - passage, 0), 1)
                    np.add.at(covers, places + 1, -1)
                    at = np.flatnonzero(np.cumsum(covers)[:words.n - passage + 1] > 0)
                    for k in range(0, len(at), 1 << 16):
                        some = at[k:k + (1 << 16)]
                        d = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.runs(some, passage))), ">i8").astype(np.int64)
                        yield _of_row(part, i, _WINDOWS, [some, d[0::2], d[1::2]])
    return windows


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE_WORDS,
                     gram: int = GRAM) -> DataFrame:
    """doc_id, row_key and the words (``starts``) at which windows of ``passage`` words begin that a lower rank has."""
    if not 0 < gram <= passage:
        raise ValueError("gram must be from 1 to passage")
    rows, spark = _rows(docs, id_col, text_col), docs.sparkSession
    with shuffles_freed(spark):
        grams = staged(rows.mapInArrow(_grams(passage, gram), _GRAMS_DDL), "passage-grams")
        shared = staged(_firsts(grams, "gram").select("gram"), "passage-shared")
        places = grams.join(shared, "gram").distinct().groupBy("doc_id", "row_key").agg(F.collect_list("at").alias("places"))
        places = staged(places.toDF("_id", "_key", "places"), "passage-places")
        some = rows.join(places, _same_row(rows, places)).select("doc_id", "row_key", "text", "places")
        windows = staged(some.dropDuplicates(["doc_id", "row_key"]).mapInArrow(_windows(passage, gram), _WINDOWS_DDL), "passage-windows")
        firsts = staged(_firsts(windows, "d1", "d2"), "passage-firsts")
        later = windows.join(firsts, ["d1", "d2"]).where(_LATER)
        out = staged(later.groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_list("at")).alias("starts")), "passage-starts")
    discard(grams, shared, places, windows, firsts)
    return out


def _same_row(rows: DataFrame, found: DataFrame):
    return rows["doc_id"].eqNullSafe(found["_id"]) & (rows["row_key"] == found["_key"])


_REPEATS = _CLEAN | {"line_text": pa.string(), "line_removed": _SPAN, "line_kept": _SPAN, "n_lines_removed": pa.int64(),
                     "line_chars_removed": pa.int64()}
_REPEATS_DDL = _CLEAN_DDL + (", line_text string, line_removed array<struct<start:long,end:long>>, "
                             "line_kept array<struct<start:long,end:long>>, n_lines_removed long, line_chars_removed long")


def passage_spans(text: str, starts: list[int], passage: int) -> list[dict]:
    """Spans of code points of the windows that begin at these words, overlapping and touching ones united."""
    if not starts:
        return []
    s = np.array(starts)
    cuts = np.flatnonzero(np.diff(s) > passage) + 1
    runs = [(int(r[0]), int(r[-1]) + passage - 1) for r in np.split(s, cuts)]
    spans, at = [], 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i == runs[at][0]:
            begin = m.start()
        if i == runs[at][1]:
            spans.append({"start": begin, "end": m.end()})
            at += 1
            if at == len(runs):
                break
    return spans


def _cut_both(passage: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in byte_slices(batch):
                texts, starts = part.column("text").to_pylist(), part.column("starts").to_pylist()
                spans = pa.array([passage_spans(t or "", s, passage) for t, s in zip(texts, starts, strict=True)], _SPAN)
                names, done = ["doc_id", "text", "removed"], []
                for removed in (spans, part.column("removed")):
                    one = pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), removed], names=names)
                    done.append(pa.Table.from_batches(list(_cut([one]))).combine_chunks())
                columns = [*done[0].columns, *done[1].columns[1:]]
                yield from pa.Table.from_arrays(columns, names=list(_REPEATS)).to_batches()
    return cut


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                 passage: int = PASSAGE_WORDS, gram: int = GRAM) -> DataFrame:
    """One row per document: what ``drop_repeated_lines`` returns, for repeated passages, then for repeated lines (line_...)."""
    rows = _rows(docs, id_col, text_col)
    lines = repeated_spans(docs, id_col, text_col, min_words).withColumn("starts", F.lit(None).cast("array<long>"))
    starts = repeated_windows(docs, id_col, text_col, passage, gram)
    empty = F.lit(None).cast("array<struct<start:long,end:long>>")
    both = lines.unionByName(starts.withColumn("removed", empty)).groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).agg(
        F.first("removed", ignorenulls=True).alias("removed"), F.first("starts", ignorenulls=True).alias("starts"))
    return rows.join(both, _same_row(rows, both), "left").select("doc_id", "text", "removed", "starts").mapInArrow(_cut_both(passage), _REPEATS_DDL)
