"""Grouping of spelling variants: words that differ by one letter, found with a bidirectional FM-index.

One inserted, deleted or replaced letter leaves the left or the right half of a word as it
is.  So each word is dealt, as a query, under its left half and under its right half, and as
an index word under the halves that a near word could have; keys that only one word has are
left out.  Keys go by hash into blocks of about ``BLOCK_WORDS`` words.  A key with more than
``SLICE_WORDS`` words is cut into slices of index words and of queries, and each pair of slices
meets in one block: no task holds a whole hot group, and nothing is left out.

A block indexes its delimited vocabulary ``$w1$w2...$wn`` (sorted, read as a ring) and its
mirror image.  A state of a search is a pair of equally long suffix-rank intervals, one in each;
extending it by a letter on either side narrows both.  The search scheme has two searches:
from the left delimiter over the left half without an error, then rightwards over the rest with
one; and from the right delimiter over the right half, then leftwards.  The rank of ``$w$`` among
the delimiters' suffixes is the word.  Pairs that both searches reach count for the first.

What leaves a block is one row a word: the number of near words and the most frequent one.

Defined results: a null or empty text has no words, a null id counts as the empty text; repeated
rows count; an empty table gives an empty result; extra columns are dropped.  Words of any
length are handled; a block takes as many steps as its longest word has letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, staged

LETTERS = "A-Za-zÀ-ÿ"
BLOCK_WORDS = 20_000       # index words a block stands for
SLICE_WORDS = 20_000       # words of one key that stay together
QUERIES = 20_000           # queries a block follows at once
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, min_letters: int = 7, min_count: int = 2, error_every: int = 0,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of at least ``min_letters`` letters that occur at least ``min_count`` times.

    ``error_every`` deals errors out for tests of the grouping: where the crc32 of ``<id>:<word>``
    is divisible by it, the letter at crc32 modulo the length is deleted.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    runs = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_letters},}}"), 0)).alias("run"))
    word = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    words = runs.select("id", word.alias("word"))
    if error_every:
        h, size = F.col("h"), F.char_length("word")
        at = (h % size).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "id", "word").cast("binary"))) \
            .select(F.when(h % error_every == 0, cut).otherwise(F.col("word")).alias("word")).where(size >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- blocks
def _halves(letters: Column, side: int) -> Column:
    """Length of a word's left (side 0) or right (side 1) half."""
    left = F.floor(letters / 2).cast("int")
    return left if side == 0 else letters - left


def _keyed(words: DataFrame, least: int) -> DataFrame:
    """side, key, query (0 / 1), word, n: a row for each half that a word asks for or answers to."""
    m = F.char_length("word")
    key = lambda k, side: F.substring("word", F.lit(1), k) if side == 0 else F.substring("word", m - k + 1, k)
    near = F.filter(F.array(m - 1, m, m + 1), lambda x: x >= least)
    rows = []
    for side in (0, 1):
        asked = F.array(F.struct(F.lit(1).alias("query"), key(_halves(m, side), side).alias("key")))
        lengths = F.array_distinct(F.transform(near, lambda x: _halves(x, side)))  # noqa: B023
        answered = F.transform(lengths, lambda k: F.struct(F.lit(0).alias("query"), key(k, side).alias("key")))  # noqa: B023
        rows.append(F.transform(F.concat(asked, answered), lambda x: F.struct(F.lit(side).alias("side"), x["key"].alias("key"), x["query"].alias("query"))))  # noqa: B023
    return words.select(F.inline(F.concat(*rows)), "word", "n")


def _blocks(words: DataFrame, least: int, block_words: int, slice_words: int) -> DataFrame:
    """block, query, side, word, n, slices, slice, hash: the rows of every block."""
    keyed = _keyed(words, least)
    groups = keyed.groupBy("side", "key").agg(F.sum(1 - F.col("query")).alias("n_index"), F.sum("query").alias("n_query")) \
        .where((F.col("n_index") > 1) & (F.col("n_query") > 0)) \
        .select("side", "key", "n_index", F.ceil(F.col("n_index") / slice_words).cast("int").alias("slices"),
                F.ceil(F.col("n_query") / slice_words).cast("int").alias("chunks"))
    groups = staged(groups, "spelling-groups")
    total = groups.agg(F.sum(F.col("n_index") * F.col("chunks"))).first()[0] or 0
    blocks = max(8, -(-int(total) // block_words))
    h = F.xxhash64("word")
    part = lambda n: F.array(F.pmod(h, n).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    asks = F.col("query") == 1
    met = keyed.join(groups.drop("n_index"), ["side", "key"]) \
        .withColumn("slice", F.explode(F.when(asks, every(F.col("slices"))).otherwise(part(F.col("slices"))))) \
        .withColumn("chunk", F.explode(F.when(asks, part(F.col("chunks"))).otherwise(every(F.col("chunks")))))
    return met.select(F.pmod(F.xxhash64("side", "key", "slice", "chunk"), F.lit(blocks)).alias("block"),
                      "query", "side", "word", "n", "slices", "slice", h.alias("hash"))


# ---------------------------------------------------------------- the index
class _Ranks:
    """Rank queries over the symbols that stand before the sorted suffixes (a wavelet matrix): one direction of the index."""

    def __init__(self, text: np.ndarray, depth: int, bits: int):
        n = len(text)
        rank, reach = text.copy(), 1
        while reach < depth:                              # suffixes by their first ``depth`` symbols: longer patterns are never asked
            rank = np.unique(rank * n + np.roll(rank, -reach), return_inverse=True)[1]
            if rank.max() == n - 1:
                break
            reach *= 2
        row = text[np.argsort(rank, kind="stable") - 1]
        self.bits = bits
        self.zeros = np.zeros((bits, n + 1), np.int32)
        counts = np.bincount(text, minlength=1 << bits)
        before = np.cumsum(counts) - counts
        start = np.zeros(1 << bits, np.int64)
        symbols = np.arange(1 << bits)
        for level in range(bits):
            one = row >> (bits - 1 - level) & 1
            np.cumsum(one == 0, out=self.zeros[level, 1:])
            own = symbols >> (bits - 1 - level) & 1
            zero = self.zeros[level, start]
            start = np.where(own == 0, zero, self.zeros[level, n] + start - zero)
            row = np.concatenate([row[one == 0], row[one == 1]])
        self.shift = before - start

    def extend(self, lo: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after one more symbol, and how many smaller symbols each old interval has."""
        a, z, less = lo, lo + size, np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            zeros = self.zeros[level]
            one = symbol >> (self.bits - 1 - level) & 1 == 1
            a0, z0 = zeros[a], zeros[z]
            less += np.where(one, z0 - a0, 0)
            a, z = np.where(one, zeros[-1] + a - a0, a0), np.where(one, zeros[-1] + z - z0, z0)
        return a + self.shift[symbol], z - a, less

    def symbols(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """All symbols that an interval can be extended by: index of the interval, symbol, new start and size, smaller symbols."""
        of, a, z = np.arange(len(lo)), lo, lo + size
        symbol, less = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            zeros = self.zeros[level]
            a0, z0 = zeros[a].astype(np.int64), zeros[z].astype(np.int64)
            left, right = z0 > a0, z - a > z0 - a0
            of = np.concatenate([of[left], of[right]])
            symbol = np.concatenate([symbol[left] * 2, symbol[right] * 2 + 1])
            less = np.concatenate([less[left], (less + z0 - a0)[right]])
            a, z = np.concatenate([a0[left], (zeros[-1] + a - a0)[right]]), np.concatenate([z0[left], (zeros[-1] + z - z0)[right]])
        return of, symbol, a + self.shift[symbol], z - a, less


class FMIndex:
    """Bidirectional index of a sorted list of distinct words."""

    def __init__(self, words: list[str], longest: int, alphabet: np.ndarray):
        self.words, self.alphabet = words, alphabet
        text = self.coded("\0" + "\0".join(words))
        bits = max(1, int(len(alphabet) - 1).bit_length())
        self.before = _Ranks(text, longest + 3, bits)                   # extends to the left
        self.after = _Ranks(text[::-1].copy(), longest + 3, bits)       # extends to the right

    def coded(self, text: str) -> np.ndarray:
        return np.searchsorted(self.alphabet, np.frombuffer(text.encode("utf-32-le"), np.uint32)).astype(np.int64)

    def near(self, queries: list[str], side: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word index) with one error outside the left (side 0) or right (side 1) half."""
        own = self.after if side == 0 else self.before
        ends = np.cumsum([len(q) + 1 for q in queries])
        flat = self.coded("".join(q + "\0" if side == 0 else q[::-1] + "\0" for q in queries))
        start = ends - np.array([len(q) + 1 for q in queries])
        exact = start + np.array([len(q) // 2 if side == 0 else len(q) - len(q) // 2 for q in queries])
        # A state: query, place in ``flat``, interval in the direction searched, its start in the other one, errors.
        q, at = np.arange(len(queries)), start
        lo, other, size = (np.full(len(queries), x, np.int64) for x in (0, 0, len(self.words)))
        wrong = np.zeros(len(queries), bool)
        found_q, found_w = [], []
        while len(q):
            split = ~wrong & (at >= exact[q])
            new = []
            keep = ~split
            if keep.any():                                               # one more letter, as it is
                c = flat[at[keep]]
                lo1, size1, less = own.extend(lo[keep], size[keep], c)
                done = (c == 0) & (size1 > 0)
                found_q.append(q[keep][done])
                found_w.append((other[keep] + less if side == 0 else lo1)[done])
                new.append((q[keep], at[keep] + 1, lo1, other[keep] + less, size1, wrong[keep], (c != 0) & (size1 > 0)))
            if split.any():                                              # as it is, or replaced, inserted or deleted
                i, c, lo1, size1, less = own.symbols(lo[split], size[split])
                sq, sat, so = q[split], at[split], other[split]
                want = flat[sat]
                same, no = c == want[i], np.zeros(len(i), bool)
                new.append((sq[i], sat[i] + 1, lo1, so[i] + less, size1, no, same & (c != 0)))
                new.append((sq[i], sat[i] + 1, lo1, so[i] + less, size1, ~no, ~same & (c != 0) & (want[i] != 0)))
                new.append((sq[i], sat[i], lo1, so[i] + less, size1, ~no, ~same & (c != 0)))
                last = (want != 0) & (flat[np.minimum(sat + 1, len(flat) - 1)] != want)      # of a run of equal letters the last goes
                new.append((sq, sat + 1, lo[split], so, size[split], np.ones(len(sq), bool), last))
            q, at, lo, other, size, wrong = (np.concatenate([x[k][x[-1]] for x in new]) for k in range(6))
        return np.concatenate(found_q), np.concatenate(found_w)


# ---------------------------------------------------------------- operators
_BEST_DDL = "word string, n_near long, best struct<less: long, form: string>"


def _search(rows: pa.Table) -> pa.Table:
    """Near words of a block's queries: their number, and the most frequent one (``less`` is minus its count)."""
    kind = rows.column("query").to_numpy()
    words, n, hashes = rows.column("word").to_pylist(), rows.column("n").to_numpy(), rows.column("hash").to_numpy()
    own = {words[i]: i for i in np.flatnonzero(kind == 0).tolist()}
    index = sorted(own)
    at = np.array([own[w] for w in index], np.int64)
    n, hashes = n[at], hashes[at]
    sides, slices, part = (rows.column(c).to_numpy() for c in ("side", "slices", "slice"))
    asked = np.flatnonzero(kind == 1)
    out_word, out_near, out_less, out_form = [], [], [], []
    if len(index) and len(asked):
        alphabet = np.unique(np.frombuffer(("\0" + "".join(set("".join(words)))).encode("utf-32-le"), np.uint32))
        fm = FMIndex(index, max(map(len, words)), alphabet)
        for side in (0, 1):
            mine = asked[sides[asked] == side]
            for a in range(0, len(mine), QUERIES):
                rows_here = mine[a:a + QUERIES]
                texts = [words[i] for i in rows_here.tolist()]
                q, w = fm.near(texts, side)
                r = rows_here[q]
                ok = hashes[w] % slices[r] == part[r]
                if side == 1:
                    ok &= np.fromiter((not index[y].startswith(texts[x][:len(texts[x]) // 2]) for x, y in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q))
                q, w = q[ok], w[ok]
                order = np.lexsort((w, -n[w], q))          # of each query the most frequent word first, then the smallest
                q, w = q[order], w[order]
                first = np.flatnonzero(np.diff(q, prepend=-1))
                out_word += [texts[i] for i in q[first].tolist()]
                out_near += np.diff(np.append(first, len(q))).tolist()
                out_less += (-n[w[first]]).tolist()
                out_form += [index[i] for i in w[first].tolist()]
    best = pa.StructArray.from_arrays([pa.array(out_less, pa.int64()), pa.array(out_form, pa.string())], names=["less", "form"])
    return pa.table([pa.array(out_word, pa.string()), pa.array(out_near, pa.int64()), best], names=["word", "n_near", "best"])


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, n_near and best (minus the count, and the word) of every word of ``words`` (word, n) that has a near word."""
    least = words.agg(F.min(F.char_length("word"))).first()[0] or 0
    blocks = _blocks(words, max(2, least), block_words, slice_words)
    return blocks.groupBy("block").applyInArrow(_search, _BEST_DDL) \
        .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """word, root of every row of ``links`` (word, form): each round doubles the steps that a word has gone."""
    now = staged(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = staged(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(words: DataFrame, factor: int = 10, block_words: int = BLOCK_WORDS, slice_words: int = SLICE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; words distinct).

    ``form`` is the near word with the largest n (ties: the smallest word) if that is at least ``factor`` times the
    word's own; ``root`` is where the forms lead, the word itself if it has none.
    """
    words = staged(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    best = near_words(words, block_words, slice_words)
    often = -F.col("best.less") >= factor * F.col("n")
    formed = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
