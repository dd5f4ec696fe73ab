"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full shingle sets.

A text's words are its runs without blank space, A-Z lower-cased; its set holds the
hashes of its ``words``-word shingles (a shorter text: its whole word sequence as one).
Two collections of ``HALVES`` half-keys are computed, each half-key from ``ROWS``
minhash values.  A table key is a pair of one half-key from each collection, so
HALVES * HALVES tables cost 2 * HALVES * ROWS minhash values instead of
2 * HALVES * HALVES * ROWS.  Two sets of similarity s share a table unless one
collection agrees nowhere: with 10 halves of 2 rows that is missed with probability
2 * (1 - s^2)^10, 7e-5 at s = 0.8 and 1e-7 at 0.9.

Texts that are equal are one node.  Candidates are pairs that share a bucket, whose sizes
allow 0.8 and that agree in at least ``AGREE`` of all minhash values (a pair of similarity
0.8 has fewer with probability 6e-5).  They are compared on full sets in two rounds.
First each bucket's pivot, the node that shares most buckets with others and so is likely
the middle of its group, is compared with the other members: one comparison a member,
and groups of near copies become components.  Then candidates between different
components are joined into families, and inside a family every member outside its
largest component is compared with all members of other components.  Buckets and
families are dealt into blocks for this, so a task holds two blocks at a time; inside it
an inverted index counts common shingles, and only edges that connect leave it, at most
one a member: neither step emits pairs.  Members of one component are never compared.

Defined results: texts without words have an empty set and are linked with nothing;
rows that agree in text are linked; rows that share an id but not the text are judged
each for itself; a component's id is its least non-null doc_id (null if it has none);
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, pick, staged
from ledgerlake.llm.components import components

HALVES = 10
ROWS = 2
AGREE = 22               # of 2 * HALVES * ROWS minhash values
BLOCK = 512              # members of a bucket that one side of a task's work holds
BLOCK_SHINGLES = 200_000 # shingles of a family that one side of a task's work holds
TASK_ENTRIES = 500_000   # table entries that a task makes and counts
CACHED_WORDS = 100_000
CHUNK = 1_000_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _parameters(n: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    k = min(words, len(h))
    total = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        total = total * _ODD + h[i:len(h) - k + 1 + i]
    return np.unique(_mixed(total))


def half_keys(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[set, half-key] and [set, value]: for non-empty sets, minhash values combined in groups of ROWS, and a byte of each."""
    if len(sets) == 1 and len(sets[0]) > CHUNK:           # a very long text: minima of its chunks
        flat = sets[0]
        starts = np.arange(0, len(flat), CHUNK)
    else:
        flat = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out, sketch = np.zeros((len(sets), len(a) // ROWS), np.uint64), np.zeros((len(sets), len(a)), np.uint8)
    for f in range(len(a)):
        least = np.minimum.reduceat(flat * a[f] + b[f], starts)
        least = least.min(keepdims=True) if len(least) > len(sets) else least
        sketch[:, f] = _mixed(least) & np.uint64(255)
        out[:, f // ROWS] = _mixed(out[:, f // ROWS] * _ODD + least)
    return out, sketch


def _signer(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _parameters(2 * HALVES * ROWS)
        hashes = _Hashes()
        for batch in batches:
            for part, texts in byte_slices(batch, rows=128):
                if len(hashes) > CACHED_WORDS:
                    hashes.clear()
                sets = [shingle_set(t, words, hashes) for t in texts]
                keys, sketch = half_keys([s if len(s) else np.zeros(1, np.uint64) for s in sets], a, b)
                keys = keys.astype(np.int64)
                offsets = pa.array(np.arange(0, keys.size + 1, 2 * HALVES), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "t1", "t2")]
                    + [pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                       pa.array([row.tobytes() for row in sketch], pa.binary())],
                    names=["doc_id", "t1", "t2", "n", "halves", "sketch"])
    return sign


def _text_key(text: F.Column) -> list[F.Column]:
    """128 bits of the text's md5 as two numbers."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return [part(1).alias("t1"), part(17).alias("t2")]


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that agree in enough minhash values."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sk_a", "sk_b"))
        yield batch.filter(pa.array((x == y).sum(1) >= AGREE)).select(["a", "b"])


class _Forest:
    """Edges that connect the members of a piece; a member is known by its node, on whichever side it stands."""

    def __init__(self, node: np.ndarray):
        self.node, self.at = np.unique(node, return_inverse=True)
        self.label = np.arange(len(self.node))
        self.edges: list[tuple[int, int]] = []

    def join(self, row: int, others: np.ndarray) -> None:
        """Connect a row with those of the other rows that are not connected to it yet."""
        i, ks = self.at[row], self.at[others]
        labels, first = np.unique(self.label[ks], return_index=True)
        new = labels != self.label[i]
        if new.any():
            self.edges += [(int(self.node[i]), int(self.node[ks[f]])) for f in first[new]]
            self.label[np.isin(self.label, labels[new])] = self.label[i]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each piece of work (key, o, x), which come sorted by piece."""
    held: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        cols = [t.column(c).to_numpy() for c in ("key", "o", "x")]
        cut = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols], axis=0)) + 1
        for at, end in zip([0, *cut], [*cut, t.num_rows], strict=True):
            part = t.slice(at, end - at)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in ("key", "o", "x")):
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _edges_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(f[s]) for f in found], pa.int64()) for s in (0, 1)], names=["a", "b"])


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    left = np.array(t.column("left").to_pylist(), bool)
    return (np.flatnonzero(left), np.flatnonzero(~left), *(t.column(c).to_numpy() for c in ("node", "n", "root")))


def _candidate_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the candidates between the two sides of each piece of a bucket."""
    found: list[tuple[int, int]] = []
    for t in _pieces(batches):
        p, q, node, n, root = _sides(t)
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)

        forest = _Forest(node)
        for i in p:
            ok = q[(root[q] != root[i]) & (100 * np.minimum(n[q], n[i]) >= 80 * np.maximum(n[q], n[i]))]
            forest.join(i, ok[(sketch[ok] == sketch[i]).sum(1) >= AGREE])
        found += forest.edges
        if len(found) > 50_000:
            yield _edges_of(found)
            found = []
    yield _edges_of(found)


def _linker(words: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges that connect the linked members of different components in each piece of a family, on full sets."""
        hashes = _Hashes()
        found: list[tuple[int, int]] = []
        for t in _pieces(batches):
            if len(hashes) > CACHED_WORDS:
                hashes.clear()
            p, q, node, _, root = _sides(t)
            texts = t.column("text").cast(pa.binary())
            sets = {i: shingle_set(texts[int(i)].as_py() or b"", words, hashes) for i in np.concatenate([p, q])}
            size = np.array([len(sets[i]) for i in q])
            every = np.concatenate([sets[i] for i in q]) if len(q) else np.zeros(0, np.uint64)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], np.repeat(np.arange(len(q)), size)[order]

            forest = _Forest(node)
            for i in p if len(q) else ():
                own = sets[i]
                lo, hi = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                many = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                both = np.bincount(owner[at], minlength=len(q))
                forest.join(i, q[(100 * both >= 80 * (len(own) + size - both)) & (root[q] != root[i])])
            found += forest.edges
            if len(found) > 50_000:
                yield _edges_of(found)
                found = []
        yield _edges_of(found)
    return links


def _comparer(words: int):
    """Whether pairs are linked, on full sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in recent:
                recent[node] = shingle_set(text, words, hashes)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[node]

        for batch in batches:
            for part, first in byte_slices(batch, "text_a", rows=64):
                if len(hashes) > CACHED_WORDS:
                    hashes.clear()
                second = part.column("text_b").cast(pa.binary()).to_pylist()
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                linked = []
                for i in range(len(a)):
                    x, y = of(a[i], first[i]), of(b[i], second[i] or b"")
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - both
                    linked.append(100 * both >= 80 * union)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return compare


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) and whether they are linked."""
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    full = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return staged(full.mapInArrow(_comparer(words), "a long, b long, linked boolean"), "near-compared")


def _pivot_pairs(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Candidates (a, b) between each bucket's pivot and its other members."""
    shared = staged(members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("shared")), "near-shared")
    order = F.col("shared") * 1_000_003 + F.pmod("node", F.lit(1_000_003))
    pivots = staged(members.join(shared, "node").groupBy("key").agg(
        F.max_by("node", order).alias("pivot"), F.max_by("n", order).alias("pivot_n")), "near-pivots")
    fits = F.expr("node <> pivot AND 100 * least(n, pivot_n) >= 80 * greatest(n, pivot_n)")
    pairs = members.join(pivots, "key").where(fits).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    side = lambda x: sketches.select(F.col("node").alias(x), F.col("sketch").alias(f"sk_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sk_a", "sk_b").mapInArrow(_agreeing, "a long, b long")


def _dealt(rows: DataFrame, weight: F.Column, block: int, payload: str) -> DataFrame:
    """Pieces of work for ``rows`` (key, node, n, root, payload): members outside a key's main component against all others.

    The members of a key are dealt into blocks of about ``block`` weight.  A piece is (key, outer block ``o``,
    other block ``x``): x < 0 is block -x - 1 of the main component, else an outer block >= o.  ``left`` says
    which side of its piece a row is on.  Keys with one component have no pieces.
    """
    parts = rows.groupBy("key", "root").agg(F.sum(weight).alias("part"))
    keys = staged(parts.groupBy("key").agg(F.sum("part").alias("all"), F.max("part").alias("most"), F.max_by("root", "part").alias("main"),
                                           F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi"), "near-open")
    blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
    placed = rows.join(keys, "key").withColumn("outer", blocks(F.col("all") - F.col("most"))).withColumn("inner", blocks(F.col("most")))
    block_of = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    place = lambda o, x, left: F.struct(o.cast("int").alias("o"), x.cast("int").alias("x"), F.lit(left).alias("left"))
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    own = block_of(F.col("outer"))
    main_rows = F.transform(up_to(F.col("outer")), lambda o: place(o, -block_of(F.col("inner")) - 1, False))
    outer_rows = F.concat(F.transform(up_to(F.col("inner")), lambda i: place(own, -i - 1, True)),
                          F.transform(F.sequence(own, F.col("outer") - 1), lambda x: place(own, x, True)),
                          F.transform(F.sequence(F.lit(0), own), lambda o: place(o, own, False)))
    return placed.withColumn("at", F.explode(F.when(F.col("root") == F.col("main"), main_rows).otherwise(outer_rows))) \
        .select("key", "at.o", "at.x", "at.left", "node", "n", "root", payload)


def _in_pieces(dealt: DataFrame, work) -> DataFrame:
    return dealt.repartition("key", "o", "x").sortWithinPartitions("key", "o", "x").mapInArrow(work, "a long, b long")


def _linked_roots(members: DataFrame, sketches: DataFrame, texts: DataFrame, words: int, block: int = BLOCK,
                  block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(node, root) of the nodes that have links; ``members``: key, node, n, size of the bucket."""
    first = _compared(_pivot_pairs(members, sketches), texts, words).where("linked").select("a", "b")
    roots = staged(components(first), "near-roots")
    placed = staged(members.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root")), "near-placed")
    between = _in_pieces(_dealt(placed.join(sketches, "node"), F.lit(1), block, "sketch"), _candidate_edges)
    families = components(between).toDF("node", "key")
    # a family holds its members' whole components only as far as they are candidates themselves
    sized = texts.join(families, "node").join(placed.select("node", "n", "root").distinct(), "node")
    more = staged(_in_pieces(_dealt(sized, F.col("n"), block_shingles, "text"), _linker(words)), "near-more")
    return components(first.unionByName(more))


def _entries(nodes: DataFrame) -> DataFrame:
    """(key, node, n) of the tables' entries.  A task's entries are counted in memory, so tasks follow their number, not the nodes' bytes."""
    tables = F.expr(f"flatten(transform(slice(halves, 1, {HALVES}), (x, i) -> transform(slice(halves, {HALVES + 1}, {HALVES}), "
                    "(y, j) -> xxhash64(x, y, i, j))))")
    tasks = max(1, -(-nodes.count() * HALVES * HALVES // TASK_ENTRIES))
    return nodes.select("halves", "node", "n").repartition(tasks, "node").select(F.explode(tables).alias("key"), "node", "n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One row per document: doc_id, t1, t2 (key of its text), n_shingles, root (of its component; null for an empty set),
    component_id (least doc_id), kept."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_key(F.col("text")))
    signed = staged(rows.select("doc_id", "t1", "t2", "text").mapInArrow(
        _signer(words), "doc_id long, t1 long, t2 long, n long, halves array<long>, sketch binary"), "near-signed")
    nodes = staged(signed.where("n > 0").groupBy("t1", "t2").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.first("halves").alias("halves"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    entries = _entries(nodes)
    full = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = staged(entries.join(staged(full, "near-keys"), "key"), "near-members")
    wanted = members.select("node").distinct().join(nodes.select("node", "t1", "t2", "rep"), "node")
    keyed = rows.toDF("_id", "text", "_t1", "_t2")
    texts = staged(keyed.join(wanted, F.col("_id").eqNullSafe(F.col("rep")) & (F.col("_t1") == F.col("t1")) & (F.col("_t2") == F.col("t2")))
                   .select("node", "text").dropDuplicates(["node"]), "near-texts")
    roots = _linked_roots(members, nodes.select("node", "sketch"), texts, words)
    least = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = staged(least.groupBy("root").agg(F.min("rep").alias("component_id")), "near-ids")   # written, so the join can split a hot root
    of_text = staged(least.select("t1", "t2", "root").join(ids, "root").select("t1", "t2", "root", "component_id"), "near-classes")
    out = signed.select("doc_id", "t1", "t2", "n").join(of_text, ["t1", "t2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "t1", "t2", F.col("n").alias("n_shingles"), "root", component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5) -> DataFrame:
    """One row of each group of near-duplicates (of its least id) and every row without words, all columns as they were."""
    found = staged(near_duplicates(docs, id_col, text_col, words), "near-found")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t1", "t2")
    grouped = found.where("root is not null")
    first = grouped.groupBy("root").agg(F.min(rank).alias("r")).select("r.doc_id", "r.t1", "r.t2")
    keep = first.unionByName(found.where("root is null").select("doc_id", "t1", "t2").distinct()).toDF("_id", "_k1", "_k2")
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    key, text = F.col(f"_c{names.index(id_col)}").cast("long"), F.col(f"_c{names.index(text_col)}")
    rows = flat.withColumn("_a", key).select("*", *_text_key(text))
    kept = rows.join(keep, F.col("_a").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_k1")) & (F.col("t2") == F.col("_k2")), "left_semi")
    words_none = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) == 0
    once = F.when(words_none, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return kept.withColumn("_once", once).dropDuplicates(["_a", "t1", "t2", "_once"]).drop("_a", "t1", "t2", "_once").toDF(*names)
