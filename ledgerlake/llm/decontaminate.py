"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark, texts scanned once.

Normalising lower-cases A-Z and keeps words of ``[0-9a-z]`` and every character
from U+0080.  A window is ``window`` consecutive words of an item, or the whole
item if it has fewer words but not none.  All distinct windows are the patterns of
one automaton; word boundaries are blanks on both sides.  Normalising works on
UTF-8 bytes (every byte of a character from U+0080 is itself 0x80 or more), and
matches map back from word numbers to code-point offsets of the original text.

The benchmark is broadcast.  Its size is checked first: beyond ``MAX_CHARS``
characters the items are dealt into as many parts as needed, each part scans the
texts with an automaton of its own, and hits are united, so the result is the same.

Defined results: a null or empty text has no words and no hits; an item that is
null or without words has no window; repeated documents and items each count for
themselves (an item id once per document); empty tables give empty results or no hits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, pick, table_of, unused, worker_cache

WINDOW = 10
MAX_CHARS = 8_000_000        # characters of benchmark text in one automaton

# A-Z to a-z; ASCII letters, digits and all bytes from 0x80 stay; the rest separates words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows_of(text: bytes, window: int = WINDOW) -> set[bytes]:
    w = normal_words(text)
    return {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else set()


def _automaton(items: list[tuple[str, bytes]], window: int):
    """Automaton over the distinct windows, each with its number of words and the items that hold it."""
    owners: dict[bytes, list[str]] = {}
    for item_id, text in items:
        for w in windows_of(text, window):
            owners.setdefault(w, []).append(item_id)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, ids))
    if owners:
        a.make_automaton()
    return a, len(owners)


def _scan(text: bytes, automaton, n_patterns: int) -> tuple[int, np.ndarray | None, set[str]]:
    """Number of words, mask of hit words (None: no hit) and the items that occur."""
    words = normal_words(text)
    if not words or not n_patterns:
        return len(words), None, set()
    line = b" " + b" ".join(words) + b" "
    found = list(automaton.iter(line.decode("latin-1")))
    if not found:
        return len(words), None, set()
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(blanks, np.array([end for end, _ in found]))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, last - np.array([n for _, (n, _) in found]), 1)
    np.add.at(edges, last, -1)
    items: set[str] = set()
    for _, (_, ids) in found:
        items.update(ids)
    return len(words), np.cumsum(edges)[:-1] > 0, items


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Code-point spans of runs of hit words."""
    at = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_OUT = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()),
        "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
        "words_hit": pa.list_(pa.int64()), "text_key": pa.string()}
_DDL = ("doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, "
        "words_hit array<long>, text_key string")


def _parts(items: DataFrame, id_col: str, text_col: str, max_chars: int) -> list[DataFrame]:
    rows = pick(items, item=id_col, text=text_col).select(F.col("item").cast("string"), "text").where("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // max_chars))
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _collected(part: DataFrame) -> list[tuple[str, bytes]]:
    return [(r["item"] if r["item"] is not None else "", r["text"].encode()) for r in part.collect()]


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
              max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (hit words), items (sorted ids), spans (code points of hit runs)."""
    base = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = _parts(items, item_col, item_text_col, max_chars)
    several = len(parts) > 1
    if several:
        base = base.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = [base.mapInArrow(_scanner(base.sparkSession.sparkContext.broadcast(_collected(p)), window, several), _DDL)
             for p in parts]
    if not several:
        return found[0].drop("words_hit", "text_key")
    united = found[0].drop("doc_id").where("n_hit > 0")
    for f in found[1:]:
        united = united.unionByName(f.drop("doc_id").where("n_hit > 0"))
    merged = united.distinct().groupBy("text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("words_hit"))).alias("words_hit"))
    rows = base.join(merged, "text_key", "left")
    return rows.mapInArrow(_respan, _DDL).drop("words_hit", "text_key")


def _scanner(shared, window: int, several: bool):
    key = f"automaton:{uuid.uuid4().hex}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, n = worker_cache(key, lambda: _automaton(shared.value, window))
        for batch in batches:
            for part, texts in byte_slices(batch):
                out: dict[str, list] = {k: [] for k in _OUT}
                for t in texts:
                    n_words, hit, items = _scan(t, a, n)
                    out["n_words"].append(n_words)
                    out["n_hit"].append(0 if hit is None else int(hit.sum()))
                    out["items"].append(sorted(items))
                    out["spans"].append([] if hit is None else _spans(t.decode(), hit))
                    out["words_hit"].append([] if hit is None or not several else np.flatnonzero(hit).tolist())
                out["doc_id"] = part.column("doc_id").to_pylist()
                out["text_key"] = part.column("text_key").to_pylist() if several else [None] * len(texts)
                yield table_of(_OUT, out)
    return scan


def _respan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hit words united over the benchmark's parts, as counts and spans."""
    for batch in batches:
        for part, texts in byte_slices(batch):
            out: dict[str, list] = {k: [] for k in _OUT}
            hits, items = part.column("words_hit").to_pylist(), part.column("items").to_pylist()
            for t, at, ids in zip(texts, hits, items, strict=True):
                n = len(normal_words(t))
                hit = np.zeros(n, bool)
                hit[at or []] = True
                out["n_words"].append(n)
                out["n_hit"].append(int(hit.sum()))
                out["items"].append(ids or [])
                out["spans"].append(_spans(t.decode(), hit) if at else [])
                out["words_hit"].append(at or [])
            out["doc_id"] = part.column("doc_id").to_pylist()
            out["text_key"] = part.column("text_key").to_pylist()
            yield table_of(_OUT, out)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text",
                      item_col: str = "item_id", window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """The documents without any benchmark window, all their columns as they were."""
    flag = unused(docs, "_hit")
    out = docs
    at = docs.columns.index(text_col)
    names = docs.columns
    for p in _parts(items, item_col, item_text_col, max_chars):
        shared = docs.sparkSession.sparkContext.broadcast(_collected(p))
        hit = F.arrow_udf(_has_hit(shared, window), "boolean")
        flat = out.toDF(*[f"_c{i}" for i in range(len(names))])
        out = flat.withColumn(flag, hit(F.col(f"_c{at}"))).where(~F.col(flag)).drop(flag).toDF(*names)
    return out


def _has_hit(shared, window: int):
    key = f"automaton:{uuid.uuid4().hex}"

    def has_hit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a, n = worker_cache(key, lambda: _automaton(shared.value, window))
        for texts in batches:
            yield pa.array([_scan(t or b"", a, n)[1] is not None for t in texts.cast(pa.binary()).to_pylist()], pa.bool_())
    return has_hit
