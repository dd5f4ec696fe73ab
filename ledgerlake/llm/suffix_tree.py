"""Language-model scores from a probabilistic suffix tree over words.

A text is the sequence of its words (runs without blank space, A-Z lower-cased) and one
end token; the context before its first word is the end token.  The tree's root predicts
a token by its count in the training texts, plus 0.5, over N + 0.5 (V + 1).  A node is a
context of up to ``depth`` words, read backwards.  It may become a state if it occurs at
least ``CONTEXT_MIN`` times, whatever the corpus' size; it stays one if its distribution
diverges from its parent's (the context without its oldest word): at least
``divergence`` nats a token and ``gain`` nats in all, and its parent is a state too.
A state lists the symbols that follow it at least ``SYMBOL_MIN`` times; their counts are
smoothed with ``prior`` pseudo-counts of the parent's distribution, and all other symbols
share the rest in proportion to the parent, so every state's distribution adds up to one.
A token is predicted by the longest suffix of its past that is a state.

Counts cover all training texts, level by level.  A level's strings are counted by the
bucket of their key, meet the parent's probabilities by the key without the first word,
and make states by the key without the last word.  Between these steps they travel packed:
a row holds the strings of one task that go to one bucket.  A log score is a sum over a
document's strings of 1 to depth + 1 words: a word adds its root probability, a context
that is a state the factor of its unlisted symbols, a listed string what its own
probability differs from that.  So scoring meets the documents' strings with one table of
values, dealt into key buckets.  Broadcast, without a change to any result: the values of
the most frequent strings (a share of the tokens of at least ``word_share``), and bit
tables that tell most strings without a value and most that no level keeps, of at most
``FILTER_BITS`` bits.

Words and strings are keyed by a 64-bit hash.  Defined results: a null or empty text is
one end token; without training texts N and V are 0 and every token has probability 1;
repeated rows count and are scored each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, pick, shuffles_freed, staged, table_of
from ledgerlake.session import fresh_dir
from ledgerlake.sinks import fs

DEPTH = 2
WORD_SHARE = 5e-6          # strings whose values are broadcast
SYMBOL_MIN = 2             # occurrences of a listed string
CONTEXT_MIN = 2            # occurrences of a state
DIVERGENCE = 0.01
GAIN = 10.0
PRIOR = 50.0
FLUSH = 1_000_000          # tokens whose strings a task counts together
FILTER_BITS = 1 << 28
BUCKET_BYTES = 8 << 20     # text a key bucket stands for
SLICE_ROWS, SLICE_BYTES = 2048, 4 << 20      # documents scored together
HASHED = 64                # bytes of a word that are hashed eight at a time


# ---------------------------------------------------------------- keys
_FOLD = bytes(32 if c in b"\t\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, by in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(32))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of a string from the keys of the string without its last word and without its first word."""
    return _mixed(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)).view(np.int64)


def _word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of all texts in a row, and how many words each text has."""
    folded = (b" " + b" ".join(texts) + b" ").translate(_FOLD) + bytes(8)
    blank = np.frombuffer(folded, np.uint8)[:-8] == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, size = edges[0::2], edges[1::2] - edges[0::2]
    words = np.diff(np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]) + 1))
    eight, by = np.ndarray(len(folded) - 7, "<u8", folded, strides=(1,)), np.uint64(0x9E3779B97F4A7C15)
    key = _mixed((size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(0xE7037ED1A0B428DB)) * by
                 + (eight[start] & _FIRST_BYTES[np.minimum(size, 8)]))
    at, more = 8, np.flatnonzero(size > 8)
    while len(more) and at < HASHED:
        key[more] = _mixed(key[more] * by + (eight[start[more] + at] & _FIRST_BYTES[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    if len(more):
        ends = [xxhash.xxh3_64_intdigest(folded[s + at:s + n]) for s, n in zip(start[more].tolist(), size[more].tolist(), strict=True)]
        key[more] = _mixed(key[more] * by + np.array(ends, np.uint64))
    return key.view(np.int64), words


def key_of(word: bytes) -> int:
    return int(_word_keys([word])[0][0]) if word else END


END = int(_mixed(np.array([0xE7037ED1A0B428DB], np.uint64)).view(np.int64)[0])


def _row(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the tokens of all texts in a row, each text with the end token before and after it, and their text's index."""
    keys, words = _word_keys(texts)
    owner = np.repeat(np.arange(len(texts)), words + 2)
    ends = np.cumsum(words + 2)
    word = np.ones(len(owner), bool)
    word[ends - 1] = word[ends - words - 2] = False
    row = np.full(len(owner), END, np.int64)
    row[word] = keys
    return row, owner


def _string_keys(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of strings (an array for each place's word), of these without the last and without the first word."""
    while len(words) > 2:
        words = [joined(a, b) for a, b in zip(words, words[1:], strict=False)]
    return joined(*words), *words


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal values of sorted columns begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(starts, append=total)


# ---------------------------------------------------------------- key buckets
def _bucket(key, buckets: int):
    """Bucket of a key (numpy): equal ranges of the keys."""
    return (((key >> 32) + (1 << 31)) * buckets) >> 32


def _buckets(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(max(8, size // BUCKET_BYTES))


def _pack(values: np.ndarray) -> bytes:
    """Bytes of the values by their place in the value, so that equal leading bytes compress, behind their number."""
    data = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack(data: bytes, kind) -> np.ndarray:
    data = pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(data: bytes, kind) -> np.ndarray:
    return np.cumsum(_unpack(data, kind), dtype=kind)


# Packed rows: the entries of a task that go to one bucket of ``key``, sorted by it.
_COLUMNS = {"other": np.int64, "n": np.int64, "c": np.int64, "p": np.float64, "q": np.float64, "ok": np.uint8}
_PACKED = {"kind": pa.string(), "bucket": pa.int64(), "size": pa.int64(), "key": pa.binary()} | dict.fromkeys(_COLUMNS, pa.binary())
_PACKED_DDL = "kind string, bucket long, size long, key binary, " + ", ".join(f"{c} binary" for c in _COLUMNS)


def _dealt(kind: str, buckets: int, key: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(key)
    key, columns = key[order], {c: v[order].astype(_COLUMNS[c]) for c, v in columns.items()}
    ends = np.searchsorted(_bucket(key, buckets), np.arange(buckets + 1))
    found = np.flatnonzero(np.diff(ends)).tolist()
    spans = [slice(ends[b], ends[b + 1]) for b in found]
    out = {"kind": [kind] * len(found), "bucket": found, "size": [s.stop - s.start for s in spans], "key": [_pack_sorted(key[s]) for s in spans]}
    return table_of(_PACKED, out | {c: [_pack(columns[c][s]) for s in spans] if c in columns else [None] * len(spans) for c in _COLUMNS})


def _entries(packed: pa.Table | pa.RecordBatch, *columns: str) -> list[np.ndarray]:
    """The columns of all packed rows, ``key`` first."""
    if not packed.num_columns:                             # the missing side of a cogroup
        packed = pa.schema(_PACKED.items()).empty_table()
    out = [np.concatenate([np.zeros(0, np.int64), *(_unpack_sorted(x, np.int64) for x in packed.column("key").to_pylist())])]
    return out + [np.concatenate([np.zeros(0, _COLUMNS[c]), *(_unpack(x, _COLUMNS[c]) for x in packed.column(c).to_pylist())]) for c in columns]


def _by_key(packed: pa.Table, *columns: str) -> list[np.ndarray]:
    out = _entries(packed, *columns)
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _sorted_rows(entries: DataFrame, ddl: str, **columns: str) -> DataFrame:
    """Packed entries as rows, each column from the named one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = _entries(batch, *(c for c in columns.values() if c != "key"))
            named = dict(zip(["key", *(c for c in columns.values() if c != "key")], arrays, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(named[c]) for c in columns.values()], names=list(columns))
    return entries.mapInArrow(run, ddl)


class _Kinds:
    """Packed rows below ``spark.checkpoint.dir``, a folder for each kind."""

    def __init__(self, rows: DataFrame, tag: str):
        self.spark, self.path = rows.sparkSession, fresh_dir(rows.sparkSession, tag)
        rows.write.partitionBy("kind").parquet(self.path)

    def of(self, *kinds: str) -> DataFrame:
        """Read anew: a cogroup mixes up the columns of two frames of one read."""
        return self.spark.read.schema(_PACKED_DDL).parquet(self.path).select(*_PACKED).where(F.col("kind").isin(*kinds))

    def discard(self, *kinds: str) -> None:
        for kind in kinds:
            fs.delete(self.spark, f"{self.path}/kind={kind}")


# ---------------------------------------------------------------- bit table
def _bit_table(keys: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the key of every row of ``keys``: its leading bits choose a word, its last six a bit of it."""
    n = keys.count()
    lead = max(10, min(FILTER_BITS, 32 * max(1, n)).bit_length() - 7)
    words = keys.groupBy(F.shiftrightunsigned("key", 64 - lead).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("key").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(1 << lead, np.int64)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return table, lead


def _bits_of_packed(packed: DataFrame) -> tuple[np.ndarray, int]:
    """The same for the keys of packed rows, each bucket's words made by one task."""
    n = packed.agg(F.sum("size")).first()[0] or 0
    lead = max(10, min(FILTER_BITS, 32 * max(1, n)).bit_length() - 7)

    def bits(found: pa.Table) -> pa.Table:
        key = np.sort(_entries(found)[0])
        at = key >> (64 - lead)
        starts = _runs(at)
        words = np.zeros(at[-1] - at[0] + 1, np.int64)
        words[at[starts] - at[0]] = np.bitwise_or.reduceat(np.int64(1) << (key & 63), starts)
        return pa.table({"at": pa.array([at[0]], pa.int64()), "bits": pa.array([words.tobytes()], pa.binary())})

    table = np.zeros(1 << lead, np.int64)
    for part in packed.select("bucket", "key").groupBy("bucket").applyInArrow(bits, "at long, bits binary").toArrow().to_batches():
        for at, words in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            words = np.frombuffer(words.as_buffer(), np.int64)
            table[np.arange(at, at + len(words)) & ((1 << lead) - 1)] |= words
    return table, lead


def _may_have(table: tuple[np.ndarray, int], keys: np.ndarray) -> np.ndarray:
    words, lead = table
    return (words[(keys.view(np.uint64) >> np.uint64(64 - lead)).view(np.int64)] >> (keys & 63)) & 1 == 1


# ---------------------------------------------------------------- counting
# Partial counts of the strings of a key bucket: the sorted keys of their words, the strings as places in these by word
# (one column after the other, the first sorted), and their counts.
_PARTIAL = {"bucket": pa.int64(), "words": pa.binary(), "first": pa.binary(), "others": pa.binary(), "n": pa.binary()}
_PARTIAL_DDL = "bucket long, words binary, first binary, others binary, n binary"


def _in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_row`` of about ``FLUSH`` tokens at a time."""
    rows: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = texts_seen = 0
    for batch in batches:
        for _, texts in byte_slices(batch):
            row, owner = _row(texts)
            rows.append(row)
            owners.append((owner + texts_seen).astype(np.int32))
            size += len(row)
            texts_seen += len(texts)
            if size >= FLUSH:
                yield np.concatenate(rows), np.concatenate(owners)
                rows, owners, size, texts_seen = [], [], 0, 0
    if rows:
        yield np.concatenate(rows), np.concatenate(owners)


def _count_words(buckets: int):
    """Partial counts of the words, and of the end tokens behind the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, owner in _in_chunks(batches):
            key = np.sort(np.delete(row, _runs(owner)))
            starts = _runs(key)
            yield _dealt("words", buckets, key[starts], n=_lengths(starts, len(key)))
    return run


def _total_words(buckets: int):
    def total(found: pa.Table) -> pa.Table:
        key, n = _by_key(found, "n")
        starts = _runs(key)
        return pa.Table.from_batches([_dealt("words", buckets, key[starts], n=np.add.reduceat(n, starts))])
    return total


def _distinct(columns: list[np.ndarray], below: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers under ``below`` in ascending order, and how often each occurs."""
    bits = max(1, (below - 1).bit_length())
    if bits * len(columns) <= 63:
        code = np.sort(reduce(lambda x, y: x << bits | y, columns))
        starts = _runs(code)
        code, n = code[starts], _lengths(starts, len(code))
        return [code >> bits * k & (1 << bits) - 1 for k in reversed(range(len(columns)))], n
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    starts = _runs(*columns)
    return [c[starts] for c in columns], _lengths(starts, len(order))


def _count_strings(words: int, buckets: int, shared):
    """Partial counts of the strings of ``words`` words whose parts may be a context and a listed symbol's string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, symbols = shared.value
        for row, owner in _in_chunks(batches):
            part = row
            for _ in range(words - 2):
                part = joined(part[:-1], part[1:])
            at = np.flatnonzero((owner[:1 - words] == owner[words - 1:]) & _may_have(contexts, part[:-1]) & _may_have(symbols, part[1:]))
            if not len(at):
                continue
            del part, owner
            known, ids = np.unique(row, return_inverse=True)
            columns, n = _distinct([ids[at + k] for k in range(words)], len(known))
            del at, ids, row
            bucket = _bucket(_string_keys([known[c] for c in columns])[0], buckets)
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            bucket, n, columns = bucket[order], n[order].astype(np.int32), [c[order] for c in columns]
            # the words of each bucket's strings, and the strings as places in these
            used, place = np.unique(np.concatenate([bucket << 32 | c for c in columns]), return_inverse=True)
            first = np.searchsorted(used >> 32, np.arange(buckets + 1))
            place = (place.reshape(words, -1) - first[bucket]).astype(np.uint32)
            ends = np.searchsorted(bucket, np.arange(buckets + 1))
            out = {k: [] for k in _PARTIAL}
            for b in np.flatnonzero(np.diff(ends)).tolist():
                here = slice(ends[b], ends[b + 1])
                for k, v in zip(out, (b, _pack_sorted(known[used[first[b]:first[b + 1]] & 0xFFFFFFFF]), _pack_sorted(place[0, here]),
                                      _pack(np.ascontiguousarray(place[1:, here]).ravel()), _pack(n[here])), strict=True):
                    out[k].append(v)
            yield table_of(_PARTIAL, out)
    return run


def _total_counts(words: int, buckets: int, least: float):
    """The strings of a key bucket with at least ``least`` occurrences, dealt by the key without the first word."""
    def total(found: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = []
        for known, first, others, n in zip(*(found.column(c).to_pylist() for c in list(_PARTIAL)[1:]), strict=True):
            known = _unpack_sorted(known, np.int64)
            places = [_unpack_sorted(first, np.uint32), *_unpack(others, np.uint32).reshape(words - 1, -1)]
            parts.append([*_string_keys([known[p] for p in places]), _unpack(n, np.int32)])
        key, a, b, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(key)
        starts = _runs(key[order])
        n = np.add.reduceat(n[order], starts, dtype=np.int64)
        one = order[starts][n >= least]
        return pa.Table.from_batches([_dealt("counted", buckets, b[one], other=a[one], n=n[n >= least])])
    return total


def _with_parent(buckets: int):
    """``q``, the last word's probability by the parent, for the strings dealt by the key without the first word."""
    def run(strings: pa.Table, below: pa.Table) -> pa.Table:
        b, a, n = _entries(strings, "other", "n")
        keys, p = _by_key(below, "p")
        at = _place(keys, b)
        ok = at >= 0
        return pa.Table.from_batches([_dealt("parent", buckets, a[ok], other=b[ok], n=n[ok], q=p[at[ok]])])
    return run


def _with_context(buckets: int, tree: Tree, divergence: float, gain: float, prior: float, more: bool, keep: bool):
    """States, their values and those of their listed strings, from the strings dealt by their context.

    With ``more``, the strings and states as the next level needs them; with ``keep``, all their columns.
    """
    def run(strings: pa.Table, below: pa.Table) -> pa.Table:
        a, b, n, q = _entries(strings, "other", "n", "q")
        keys, counts, ok = _by_key(below, "n", "ok")
        fit = (ok == 1) & (counts >= tree.context_min)
        keys, counts = keys[fit], counts[fit]
        at = _place(keys, a)
        order = np.lexsort((b, a))
        order = order[at[order] >= 0]
        if not len(order):
            return pa.Table.from_batches([], pa.schema(_PACKED.items()))
        a, b, n, q, c = a[order], b[order], n[order], q[order], counts[at[order]]
        own = (n + prior * q) / (c + prior)
        starts = _runs(a)
        of = np.repeat(np.arange(len(starts)), _lengths(starts, len(a)))
        all_c = c[starts]
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.maximum(all_c - np.add.reduceat(n, starts), 0)
            mass = np.minimum(np.add.reduceat(q, starts), 1 - 1e-9)
            factor = (rest + prior * (1 - mass)) / ((all_c + prior) * (1 - mass))
            won = np.add.reduceat(n * np.log(own / q), starts) + rest * np.log(factor)
            state = (won >= gain) & (won >= divergence * all_c)
            logb = np.log10(factor)
        key, listed = joined(a, b), state[of]
        value = np.log10(own[listed]) - np.log10(q[listed]) - logb[of[listed]]
        out = _valued("value", buckets, tree, np.concatenate([a[starts][state], key[listed]]),
                      np.concatenate([all_c[state], n[listed]]), np.concatenate([logb[state], value]))
        if more or keep:
            out += [_dealt("string", buckets, b, other=a, n=n, p=own, **({"c": c, "q": q} if keep else {})),
                    _dealt("state", buckets, a[starts][state], n=all_c[state], p=logb[state])]
        return pa.Table.from_batches(out)
    return run


def _valued(kind: str, buckets: int, tree: Tree, key: np.ndarray, n: np.ndarray, value: np.ndarray) -> list[pa.RecordBatch]:
    """Values of strings; those of the most frequent ones are of a kind of their own."""
    hot = n >= tree.word_share * tree.total
    return [_dealt(k, buckets, key[x], n=n[x], p=value[x]) for k, x in ((kind, ~hot), (f"hot_{kind}", hot))]


def _next_level(buckets: int):
    """A level's strings as the next one's contexts: one may be a state if it is one without its first word."""
    def run(strings: pa.Table, states: pa.Table) -> pa.Table:
        b, a, n, own = _entries(strings, "other", "n", "p")
        return pa.Table.from_batches([_dealt("below", buckets, joined(a, b), n=n, p=own, ok=_place(*_by_key(states), b) >= 0)])
    return run


def _first_level(buckets: int, tree: Tree):
    """The words as contexts and parents of the first level, and what they add to a score."""
    least, denominator = min(tree.symbol_min, tree.context_min), tree.denominator()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, n = _entries(batch.slice(i, 1), "n")
                fit = n >= least
                yield _dealt("below", buckets, key[fit], n=n[fit], p=(n[fit] + 0.5) / denominator, ok=np.ones(fit.sum()))
                yield from _valued("word", buckets, tree, key, n, np.log10(2 * n + 1))
    return run


# ---------------------------------------------------------------- the tree
@dataclass
class Tree:
    """``levels`` (if kept): for d = 1 .. depth the strings of d + 1 words (key, a, b, n, c, q, own) and the states of d words (key, n, logb).

    ``a`` and ``b`` are the keys without the last and without the first word, ``c`` the count of the context,
    ``q`` and ``own`` the last word's probability by the parent and by the context itself.

    ``values``: what one occurrence of a string adds to a score (``p``), packed: of words, then of each level's states and
    listed strings.  A key has an entry for each thing that it is.  Words of no training text add log10(0.5 / denominator),
    which is counted for all words beforehand.
    """
    total: int
    distinct: int
    symbol_min: float
    context_min: float
    word_share: float
    buckets: int
    words: DataFrame
    levels: list[tuple[DataFrame, DataFrame]]
    values: list[DataFrame]

    def denominator(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @cached_property
    def _arrays(self) -> dict[str, list[np.ndarray]]:
        """The whole tree in the driver, to look into small ones; neither learning nor scoring uses it."""
        rows = sorted(map(tuple, self.words.where(F.col("n") >= min(self.symbol_min, self.context_min)).collect()))
        size, index = max(1, len(rows)), {key: i for i, (key, _) in enumerate(rows)}
        last = {key: i for key, i in index.items()}
        out = {"keys": [np.array([k for k, _ in rows], np.int64)], "counts": [np.array([n for _, n in rows], np.int64)],
               "logp": [np.log10((np.array([n for _, n in rows], float) + 0.5) / self.denominator())], "logb": [], "state": []}
        for strings, states in self.levels:
            found = [(index[r["a"]] * size + last[r["b"]], r) for r in strings.collect()]
            found.sort(key=lambda x: x[0])
            logb = {r["key"]: r["logb"] for r in states.collect()}
            out["state"].append(np.array([k in logb for k in index], bool))
            out["logb"].append(np.array([logb.get(k, 0.0) for k in index]))
            out["keys"].append(np.array([x for x, _ in found], np.int64))
            out["counts"].append(np.array([r["n"] for _, r in found], np.int64))
            out["logp"].append(np.log10(np.array([r["own"] for _, r in found], float)))
            last, index = {r["key"]: x % size for x, r in found}, {r["key"]: i for i, (_, r) in enumerate(found)}
        return out

    keys = property(lambda self: self._arrays["keys"], doc="keys[0]: sorted word keys; keys[d]: sorted (index of the first d words) * words + index of the last")
    counts = property(lambda self: self._arrays["counts"])
    logp = property(lambda self: self._arrays["logp"], doc="log10 probability of each string's last word")
    logb = property(lambda self: self._arrays["logb"], doc="log10 factor for unlisted symbols, by context")
    state = property(lambda self: self._arrays["state"])


def learn(texts: DataFrame, depth: int = DEPTH, word_share: float = WORD_SHARE, symbol_share: float = 0.0,
          context_share: float = 0.0, divergence: float = DIVERGENCE, gain: float = GAIN, prior: float = PRIOR,
          symbol_min: int = SYMBOL_MIN, context_min: int = CONTEXT_MIN, keep_levels: bool = True) -> tuple[Tree, DataFrame]:
    """The tree and the table (key, n) of all words' counts, from the column ``text`` of the training texts.

    ``symbol_share`` and ``context_share`` (shares of all tokens) may raise the minimum counts; by default they do not.
    Scoring needs the tree's ``values`` only: ``keep_levels=False`` removes each level's other tables once it is done.
    """
    with shuffles_freed(texts.sparkSession):
        return _learn(texts, depth, word_share, symbol_share, context_share, divergence, gain, prior, symbol_min, context_min, keep_levels)


def _learn(texts: DataFrame, depth: int, word_share: float, symbol_share: float, context_share: float, divergence: float, gain: float,
           prior: float, symbol_min: int, context_min: int, keep_levels: bool) -> tuple[Tree, DataFrame]:
    context, buckets = texts.sparkSession.sparkContext, _buckets(texts)
    words = staged(texts.mapInArrow(_count_words(buckets), _PACKED_DDL).groupBy("bucket").applyInArrow(_total_words(buckets), _PACKED_DDL), "suffix-words")
    counts = _sorted_rows(words, "key long, n long", key="key", n="n")
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = total or 0
    tree = Tree(total, distinct, max(symbol_min, symbol_share * total), max(context_min, context_share * total), word_share, buckets, counts, [], [])
    # plain numbers travel to the tasks, not the tree's tables
    facts = Tree(total, distinct, tree.symbol_min, tree.context_min, word_share, buckets, None, [], [])
    parted = _Kinds(words.mapInArrow(_first_level(buckets, facts), _PACKED_DDL), "suffix-level-0")
    tree.values.append(parted.of("word", "hot_word"))
    for d in range(1, depth + 1):
        below = parted.of("below")
        shared = context.broadcast((_bits_of_packed(_fit(below, facts, contexts=True)), _bits_of_packed(_fit(below, facts, contexts=False))))
        counted = texts.mapInArrow(_count_strings(d + 1, buckets, shared), _PARTIAL_DDL).groupBy("bucket") \
            .applyInArrow(_total_counts(d + 1, buckets, tree.symbol_min), _PACKED_DDL)
        parent = counted.groupBy("bucket").cogroup(below.groupBy("bucket")).applyInArrow(_with_parent(buckets), _PACKED_DDL)
        level = _Kinds(parent.groupBy("bucket").cogroup(below.groupBy("bucket")).applyInArrow(
            _with_context(buckets, facts, divergence, gain, prior, d < depth, keep_levels), _PACKED_DDL), f"suffix-level-{d}")
        shared.destroy()
        parted.discard("below")
        tree.values.append(level.of("value", "hot_value"))
        strings, states = level.of("string"), level.of("state")
        if d < depth:
            parted = _Kinds(strings.groupBy("bucket").cogroup(states.groupBy("bucket")).applyInArrow(_next_level(buckets), _PACKED_DDL), f"suffix-below-{d}")
        if keep_levels:
            rows = _sorted_rows(strings, "b long, a long, n long, c long, q double, own double", b="key", a="other", n="n", c="c", q="q", own="p")
            tree.levels.append((_keyed(rows), _sorted_rows(states, "key long, n long, logb double", key="key", n="n", logb="p")))
        else:
            level.discard("string", "state")
    return tree, counts


def _fit(below: DataFrame, tree: Tree, contexts: bool) -> DataFrame:
    """The packed rows of those that may be a context, or the string of a listed symbol."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, ok = _entries(batch, "n", "ok")
            fit = (ok == 1) & (n >= tree.context_min) if contexts else n >= tree.symbol_min
            yield _dealt("fit", tree.buckets, key[fit])
    return below.mapInArrow(run, _PACKED_DDL)


def _keyed(strings: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = joined(batch.column("a").to_numpy(), batch.column("b").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c) for c in ("a", "b", "n", "c", "q", "own"))],
                                             names=["key", "a", "b", "n", "c", "q", "own"])
    return strings.mapInArrow(run, "key long, a long, b long, n long, c long, q double, own double")


# ---------------------------------------------------------------- scoring
# A record holds, for a slice of documents, either their facts or the strings that fall into two neighbouring key buckets
# (fewer sums than by one); then either the facts or the sums over these strings.
_RECORD = {"bucket": pa.int64(), "first": pa.int64(), "ids": pa.list_(pa.int64()), "facts": pa.binary(), "keys": pa.binary(),
           "owners": pa.binary(), "m": pa.binary()}
_RECORD_DDL = "bucket long, first long, ids array<long>, facts binary, keys binary, owners binary, m binary"
_SUMS = {"first": pa.int64(), "ids": pa.list_(pa.int64()), "owners": pa.binary(), "facts": pa.binary()}
_SUMS_DDL = "first long, ids array<long>, owners binary, facts binary"
_FACTS = ("n_tokens", "known", "base", "value")
_SCORES_DDL = "doc_id long, n_tokens long, known long, base double, value double"


def _place(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def _worth(values: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct keys, and the sums of their entries' known, base and value."""
    key, p = _entries(values, "p")
    word = np.zeros(0, bool)
    if len(key):
        word = np.repeat([k.endswith("word") for k in values.column("kind").to_pylist()], values.column("size").to_numpy())
    keys, at = np.unique(key, return_inverse=True)
    return keys, [np.bincount(at, v, len(keys)) for v in (word.astype(float), np.where(word, p, 0.0), p)]


def _emitter(shared, levels: int, buckets: int, absent: float):
    pairs = (buckets + 1) // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, hot_worth, may = shared.value
        for batch in batches:
            for part, texts in byte_slices(batch, rows=SLICE_ROWS, size=SLICE_BYTES):
                row, owner = _row(texts)
                sizes = np.bincount(owner, minlength=len(texts)) - 1
                key, of = np.delete(row, _runs(owner)), np.repeat(np.arange(len(texts), dtype=np.uint16), sizes)
                found = [(x := _may_have(may, key), key[x], of[x])[1:]]
                part_key = row
                for words in range(2, levels + 1):
                    part_key = joined(part_key[:-1], part_key[1:])
                    at = np.flatnonzero((owner[:1 - words] == owner[words - 1:]) & _may_have(may, part_key))
                    found.append((part_key[at], owner[at].astype(np.uint16)))
                key, of = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(key, kind="stable")           # a key's texts stay in order
                key, of = key[order], of[order]
                starts = _runs(key, of)
                key, of, m = key[starts], of[starts], _lengths(starts, len(key))
                runs = _runs(key)
                at = np.repeat(_place(hot, key[runs]), _lengths(runs, len(key)))
                known = at >= 0
                facts = [sizes.astype(np.float64)]
                for name, worth in zip(_FACTS[1:], hot_worth, strict=True):
                    facts.append(np.bincount(of[known], m[known] * worth[at[known]] if len(hot) else np.zeros(0), len(texts))
                                 + (absent * sizes if name != "known" else 0))
                key, of, m = key[~known], of[~known], m[~known].astype(np.int32)
                first = part.column("row")[0].as_py()
                ends = np.searchsorted(_bucket(key, buckets) >> 1, np.arange(pairs + 1))
                found = np.flatnonzero(np.diff(ends)).tolist()
                spans = [slice(ends[b], ends[b + 1]) for b in found]
                none = [None] * len(spans)
                yield table_of(_RECORD, {
                    "bucket": [first % pairs, *found], "first": [first] * (1 + len(spans)), "ids": [part.column("doc_id").to_pylist(), *none],
                    "facts": [np.array(facts).tobytes(), *none], "keys": [None, *(_pack_sorted(key[s]) for s in spans)],
                    "owners": [None, *(_pack(of[s]) for s in spans)], "m": [None, *(_pack(m[s]) for s in spans)]})
    return emit


def _sums(records: pa.Table, values: pa.Table) -> pa.Table:
    """Facts of the documents, and sums over the strings of a key bucket by document."""
    if not records.num_columns:
        return pa.schema(_SUMS.items()).empty_table()
    keys, of = _worth(values)
    out = {k: [] for k in _SUMS}
    for first, ids, facts, k, owners, m in zip(*(records.column(c).to_pylist() for c in list(_RECORD)[1:]), strict=True):
        if facts is None:
            at = _place(keys, _unpack_sorted(k, np.int64))
            hit = at >= 0
            owner, times = _unpack(owners, np.uint16)[hit], _unpack(m, np.int32)[hit]
            rows, back = np.unique(owner, return_inverse=True)
            facts = _pack(np.concatenate([np.bincount(back, times * v[at[hit]], len(rows)) for v in of]))
            owners = _pack(rows)
        for name, v in zip(_SUMS, (first, ids, owners, facts), strict=True):
            out[name].append(v)
    return pa.Table.from_batches([table_of(_SUMS, out)])


def _by_document(sums: pa.Table) -> pa.Table:
    """The documents of a slice with all their sums."""
    rows = [x for x in zip(*(sums.column(c).to_pylist() for c in list(_SUMS)[1:]), strict=True)]
    (ids, _, facts), = (x for x in rows if x[0] is not None)
    total = np.frombuffer(facts).reshape(len(_FACTS), -1).copy()
    for _, owners, facts in (x for x in rows if x[0] is None):
        total[1:, _unpack(owners, np.uint16)] += _unpack(facts, np.float64).reshape(len(_FACTS) - 1, -1)
    return pa.table([pa.array(ids, pa.int64()), *(pa.array(v.astype(np.int64)) for v in total[:2]), *map(pa.array, total[2:])], names=["doc_id", *_FACTS])


def score_texts(docs: DataFrame, tree: Tree, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score (root only), score (longest states).

    ``counts`` is the table that ``learn`` returns beside the tree, whose values already hold the words.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")) \
        .withColumn("row", F.monotonically_increasing_id())
    values = reduce(DataFrame.unionByName, tree.values)
    with shuffles_freed(docs.sparkSession):
        hot = _worth(values.where(F.col("kind").startswith("hot_")).toArrow())
        shared = docs.sparkSession.sparkContext.broadcast((*hot, _bits_of_packed(values)))
    absent = float(np.log10(0.5 / tree.denominator()))
    values = values.where(~F.col("kind").startswith("hot_"))
    buckets = tree.buckets * -(-_buckets(rows) // (2 * tree.buckets))
    if buckets > tree.buckets:                             # far more text than was learned from: its buckets are parted
        values = values.mapInArrow(_dealt_anew(buckets), _PACKED_DDL)
    records = rows.mapInArrow(_emitter(shared, len(tree.values), buckets, absent), _RECORD_DDL)
    values = values.withColumn("bucket", F.shiftright("bucket", 1))
    sums = records.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(_sums, _SUMS_DDL)
    return sums.groupBy("first").applyInArrow(_by_document, _SCORES_DDL).select(
        "doc_id", "n_tokens", F.col("known").alias("n_known"), F.lit(tree.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), F.col("value").alias("score"))


def _dealt_anew(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                key, n, p = _entries(batch.slice(i, 1), "n", "p")
                yield _dealt(kind, buckets, key, n=n, p=p)
    return run
