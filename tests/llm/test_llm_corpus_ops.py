"""Toxicity, suffix tree, fingerprints and near-duplicates against brute force or held-out rows."""

import collections
import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import ODD_IDS, ODD_TEXTS, clashing, docs_frame, rows_of, words  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.llm import components as cc, imatch, minhash, suffix_tree, toxicity  # noqa: E402
from ledgerlake.llm.common import fold, pick, worker_cache  # noqa: E402
from ledgerlake.llm.components import components  # noqa: E402
from ledgerlake.llm.queries import QUERIES  # noqa: E402


# ---------------------------------------------------------------- toxicity
def toxic_corpus(n=900, seed=1):
    rng = random.Random(seed)
    texts, toxic, langs = [], [], []
    for _ in range(n):
        bad, lang = rng.random() < 0.4, rng.choice(["en", "de"])
        w = words(rng, rng.randrange(5, 40)).split()
        if bad:
            for _ in range(2):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["vile", "scum"]) if lang == "en" else "ekel" + rng.choice(["haft", "ig", "isch"]))
        texts.append(" ".join(w))
        toxic.append(int(bad))
        langs.append(lang)
    return texts, toxic, langs


def test_toxicity_on_held_out_rows(spark):
    texts, toxic, langs = toxic_corpus()
    docs = clashing(docs_frame(spark, texts, langs=langs))
    labels = spark.createDataFrame([(i, y, 9) for i, y in enumerate(toxic)] + [(None, 1, 0), (3, None, 0)], "doc_id long, toxic int, score int")
    allowed = lambda c: fold(c, 3) != 1
    model = toxicity.fit(docs, labels, allowed=allowed)
    assert set(model.thresholds) <= {"en", "de"} and model.thresholds
    got = {r["doc_id"]: r for r in toxicity.score_texts(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((got[i]["score"] >= 0.7) == bool(toxic[i]) for i in held)
    rejected = sum(got[i]["rejected"] == bool(toxic[i]) for i in held)
    assert right >= 0.95 * len(held) and rejected >= 0.95 * len(held)
    again = {r["doc_id"]: r["score"] for r in toxicity.score_texts(docs, toxicity.fit(docs, labels, allowed=allowed)).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in pick(kept, doc_id="doc_id").collect()} == {i for i, r in got.items() if not r["rejected"]}


@pytest.mark.parametrize(("scale", "least"), [("sf0.01", 0.85), ("sf0.1", 0.95)])
def test_toxicity_generalises(spark, scale, least):
    """Area under the curve of the labelled documents that were not learned from."""
    sf = f"/root/testdata/{scale}"
    marks = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held = QUERIES["op1_toxicity"](spark, sf).where("held_out").join(marks, "doc_id").select("score", "toxic", "predicted").collect()
    bad, good = ([r["score"] for r in held if r["toxic"] == c] for c in (1, 0))
    assert sum((b > g) + (b == g) / 2 for b in bad for g in good) >= least * len(bad) * len(good)
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) <= 0.02 * len(good)
    assert sum(r["predicted"] for r in held if r["toxic"] == 1) >= 0.6 * len(bad)


def test_toxicity_sample_is_bounded_in_rows(spark):
    texts, toxic, langs = toxic_corpus(200)
    docs = docs_frame(spark, texts, langs=langs)
    many = docs.unionByName(spark.range(20_000).selectExpr("7 AS doc_id", "concat('copy ', id) AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars"))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    args = ("doc_id", "text", "lang", "toxic", None, 30, toxicity.MAX_BYTES)
    rows = toxicity.sample_rows(many, labels, *args).collect()
    assert len(rows) == 60 and len({r["doc_id"] for r in rows}) == 60 and sum(r["toxic"] for r in rows) == 30
    assert len(toxicity.sample_rows(many, labels.where("doc_id = 7"), *args).collect()) == 1
    assert toxicity.fit_rows([r for r in rows if r["toxic"]][:1] + [r for r in rows if not r["toxic"]][:1]).constant is None


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Also over many shards and from texts of any length: a sign that only long texts hold is learned, all rows calibrate."""
    texts, toxic, langs = toxic_corpus(700)
    rng = random.Random(4)
    for i in range(120):
        w = words(rng, 5000).split()
        if i % 2:
            w.insert(rng.randrange(len(w)), "zzgift")
        texts.append(" ".join(w) + " w1" * 4000)
        toxic.append(i % 2)
        langs.append("en")
    assert all(len(t) > toxicity.MAX_BYTES for t in texts[700:])
    docs, labels = docs_frame(spark, texts, langs=langs), spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    docs = docs.unionByName(docs.where("doc_id < 50")).repartition(3)
    seen, calibrate = [], toxicity._calibrate
    monkeypatch.setattr(toxicity, "_calibrate", lambda m, z, y, g, n: seen.append((n.sum(), (n * y).sum())) or calibrate(m, z, y, g, n))
    short = docs_frame(spark, ["w1 w2 zzgift w3", "w1 w2 w3"] + texts)
    for rows in (toxicity.SHARD_ROWS, 150):
        monkeypatch.setattr(toxicity, "SHARD_ROWS", rows)
        found = [r["score"] for r in toxicity.score_texts(short, toxicity.fit(docs, labels)).orderBy("doc_id").collect()]
        assert seen.pop() == (len(texts), sum(toxic))
        assert found[0] > 0.7 > 0.3 > found[1]
        assert sum((f >= 0.7) == bool(y) for f, y in zip(found[2:], toxic, strict=True)) >= 0.95 * len(toxic)


@pytest.mark.parametrize("toxic", [[0] * 40, [1] * 40, [1] + [0] * 39, []])
def test_toxicity_shards_without_a_class(spark, monkeypatch, toxic):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 4)
    docs = docs_frame(spark, [f"w{i} w{i % 7}" for i in range(40)])
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    scores = [r["score"] for r in toxicity.score_texts(docs, toxicity.fit(docs, labels)).collect()]
    assert len(scores) == 40 and all(0 <= x <= 1 for x in scores)
    if len(set(toxic)) < 2:
        assert set(scores) == {float(sum(toxic) / 40)}


def test_best_positions_do_not_depend_on_slices(monkeypatch):
    rng = np.random.default_rng(3)
    embed = rng.normal(size=(toxicity.BUCKETS + 1, toxicity.DIM)).astype(np.float32)
    filters = [rng.normal(size=(k, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for k in toxicity.WIDTHS]
    sizes = [0, 50, 1, 0, 7, 300]
    texts = np.concatenate([np.full((1, 3), toxicity.BUCKETS), rng.integers(0, toxicity.BUCKETS, (sum(sizes), 3))])
    flat, starts, _ = toxicity._flat([np.arange(e - n, e) for e, n in zip(1 + np.cumsum(sizes), sizes, strict=True)], 0)
    whole = toxicity._best_positions(embed, filters, texts, flat, starts, sizes)
    monkeypatch.setattr(toxicity, "SLICE", 5)
    part = toxicity._best_positions(embed, filters, texts, flat, starts, sizes)
    assert (whole[0] == part[0]).all() and np.allclose(whole[1], part[1], atol=1e-4)


def test_table_scores_equal_direct_convolution(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS + 1, toxicity.DIM)).astype(np.float32),
                           [rng.normal(size=(k, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for k in toxicity.WIDTHS],
                           rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS), rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS), 0.3)
    texts = [b"one two three", b"", b"one", b"B\xc3\xa9 b c d e f g " * 5, b"a b c d e f g"]
    monkeypatch.setattr(toxicity, "CHUNK", 7)             # longer texts are scored in chunks
    got = toxicity.logits_of(model, toxicity._Words(model), texts)
    for t, g in zip(texts, got, strict=True):
        ids = [toxicity.word_buckets(w) for w in (t or b"").translate(toxicity._LETTERS).split()]
        x = np.array([model.embed[list(i)].sum(0) for i in ids] + [np.zeros(toxicity.DIM)] * 3)
        pooled = np.concatenate([np.max([sum(x[p + j] @ f[j] for j in range(len(f))) for p in range(len(ids) + 1)], axis=0) for f in model.filters])
        assert math.isclose(g, np.maximum(pooled + model.bias, 0) @ model.out + 0.3, rel_tol=1e-4, abs_tol=1e-4)


def test_toxicity_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS, [None, *["en"] * 9])
    labels = spark.createDataFrame([(1, 0), (3, 0), (4, 1), (5, 1), (6, 0)], "doc_id long, toxic int")
    for marks in (labels, labels.where("toxic = 1"), labels.limit(0)):
        scored = toxicity.score_texts(docs, toxicity.fit(docs, marks)).collect()
        assert len(scored) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
        assert len({r["score"] for r in scored if r["doc_id"] in (1, 2, 8, None)}) == 1        # texts without words
    assert toxicity.score_texts(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


# ---------------------------------------------------------------- suffix tree
def test_base_scores_and_normalised_states(spark):
    rng = random.Random(7)
    phrase = "alpha beta gamma delta"
    texts = [" ".join(rng.choice([phrase, words(rng, 4, 60)]) for _ in range(rng.randrange(1, 12))) for _ in range(300)] + ["", None, "unseen Words"]
    docs = clashing(docs_frame(spark, texts))
    train = docs.where(fold("doc_id", 5) != 1)
    tree, counts = suffix_tree.learn(pick(train, text="text"), word_share=2e-3, symbol_share=2e-3, context_share=5e-3, gain=3.0)
    got = {r["doc_id"]: r for r in suffix_tree.score_texts(docs, tree, counts).collect()}
    split = lambda t: (t or "").lower().split() + [""]
    c = collections.Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1 for w in split(t))
    n, v = sum(c.values()), len(c)
    assert (tree.total, tree.distinct) == (n, v) and tree.state[0].any() and tree.state[1].any()
    for i, t in enumerate(texts):
        w = split(t)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(got[i]["base_score"], sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 1]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)

    # every state's distribution adds up to one, unknown words included as one symbol
    vocabulary, spelled = len(tree.keys[0]), {suffix_tree.key_of(w.encode()): w for w in c}
    flat_base = {suffix_tree.key_of(w.encode()): (c[w] + 0.5) / (n + 0.5 * (v + 1)) for w in c}
    rest = 1 - sum(flat_base.values())

    def chance(context, d, key):                       # of a word after a string of length d, by the definition
        if d == 0:
            return flat_base.get(key, rest)
        tail = shorter(context, d)
        if not tree.state[d - 1][context]:
            return chance(tail, d - 1, key)
        at = int(np.searchsorted(tree.keys[0], key))
        if at < vocabulary and tree.keys[0][at] == key:
            e = int(np.searchsorted(tree.keys[d], context * vocabulary + at))
            if e < len(tree.keys[d]) and tree.keys[d][e] == context * vocabulary + at:
                return 10 ** tree.logp[d][e]
        return 10 ** tree.logb[d - 1][context] * chance(tail, d - 1, key)

    def shorter(s, d):
        if d == 1:
            return 0
        head, last = divmod(int(tree.keys[d - 1][s]), vocabulary)
        return last if d == 2 else int(np.searchsorted(tree.keys[d - 2], shorter(head, d - 1) * vocabulary + last))

    for d in (1, 2):
        for s in np.flatnonzero(tree.state[d - 1])[:5]:
            total = sum(chance(int(s), d, k) for k in flat_base) + chance(int(s), d, None or 12345)
            assert math.isclose(total, 1, rel_tol=1e-9), (d, s)

    # scores follow the longest suffix that is a state
    def find(d, head, key):
        at = int(np.searchsorted(tree.keys[0], key))
        if at >= vocabulary or tree.keys[0][at] != key:
            return None
        if d == 1:
            return at
        if head is None or tree.counts[d - 2][head] < tree.context_min:
            return None
        e = int(np.searchsorted(tree.keys[d - 1], head * vocabulary + at))
        return e if e < len(tree.keys[d - 1]) and tree.keys[d - 1][e] == head * vocabulary + at else None

    for i in range(0, 300, 23):
        total, one, two = 0.0, find(1, None, suffix_tree.END), None
        for w in split(texts[i]):
            key = suffix_tree.key_of(w.encode())
            total += math.log10(chance(two, 2, key) if two is not None and tree.state[1][two] else chance(one, 1, key) if one is not None else flat_base.get(key, rest))
            two, one = find(2, one, key), find(1, None, key)
        assert math.isclose(got[i]["score"], total, rel_tol=1e-9), i
    assert spelled


def test_suffix_tree_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    tree, counts = suffix_tree.learn(docs.select("text"))
    got = suffix_tree.score_texts(docs, tree, counts).collect()
    assert len(got) == len(ODD_TEXTS) and {(r["doc_id"], r["n_tokens"]) for r in got} >= {(None, 1), (1, 1), (4, 3), (7, 50_001)}
    tree, counts = suffix_tree.learn(docs.limit(0).select("text"))
    got = {r["doc_id"]: r for r in suffix_tree.score_texts(docs, tree, counts).collect()}
    assert (got[4]["n_tokens"], got[4]["n_known"], got[4]["train_tokens"], got[4]["base_score"]) == (3, 0, 0, 0.0)
    assert suffix_tree.score_texts(docs.limit(0), tree, counts).count() == 0


def test_suffix_tree_keeps_rare_strings_of_a_large_corpus(spark):
    rng = random.Random(5)
    for size in (400, 20):                             # what is listed does not depend on how much else there is
        texts = [words(rng, 500, 5000) for _ in range(size)] + ["zeta omega"] * 4
        tree, counts = suffix_tree.learn(docs_frame(spark, texts).select("text"))
        (got,) = suffix_tree.score_texts(docs_frame(spark, ["zeta omega"]), tree, counts).collect()
        assert got["score"] > got["base_score"] + 2, size
        once = suffix_tree.learn(docs_frame(spark, texts[:-3]).select("text"))
        (got,) = suffix_tree.score_texts(docs_frame(spark, ["zeta omega"]), *once).collect()
        assert math.isclose(got["score"], got["base_score"], abs_tol=1), size


def test_suffix_tree_tables_travel_packed(spark):
    rng = random.Random(11)
    texts = [words(rng, 300, 80) for _ in range(60)]
    tree, counts = suffix_tree.learn(docs_frame(spark, texts).select("text"), keep_levels=False)
    rows, entries = zip(*[v.selectExpr("count(*)", "sum(size)").first() for v in tree.values], strict=True)
    assert tree.buckets == 8 and entries[0] == counts.count() and entries[1] > 1000
    assert rows[0] <= 2 * 8 and max(rows) <= 2 * 8 * 8 and not tree.levels         # a row a task and bucket, not a string
    assert {r["n_known"] for r in suffix_tree.score_texts(docs_frame(spark, texts), tree, counts).collect()} == {301}
    # far more text than was learned from: the values' buckets are parted, with the same scores
    few = docs_frame(spark, [t for t in texts[:20]])
    want = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(few, tree, counts).collect()}
    old = suffix_tree._buckets
    try:
        suffix_tree._buckets = lambda texts: 8 * 6
        got = {r["doc_id"]: r["score"] for r in suffix_tree.score_texts(few, tree, counts).collect()}
    finally:
        suffix_tree._buckets = old
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_word_keys_of_odd_texts():
    rng = random.Random(13)
    made = [bytes(rng.choice(b"aB\x00\x1f\xc3\xa9.") for _ in range(n)) for n in (*range(1, 20), 63, 64, 65, 66, 200, 5000) for _ in range(3)]
    texts = [b"", b" \t\n\x0b\x0c\r ", b" ".join(made), b"\n".join(made[::-1]) + b"\n", made[-1], b"A", b"a"]
    keys, per_text = suffix_tree._word_keys(texts)
    spelled = [w for t in texts for w in t.lower().split()]
    assert per_text.tolist() == [len(t.split()) for t in texts] and len(keys) == len(spelled)
    assert len(set(zip(keys.tolist(), spelled, strict=True))) == len(set(keys.tolist())) == len(set(spelled))
    assert suffix_tree.END not in keys and all(suffix_tree.key_of(w) == k for w, k in zip(spelled, keys.tolist(), strict=True))


# ---------------------------------------------------------------- fingerprints
def test_next_document_across_ranges(spark):
    rng = random.Random(3)
    ids = rng.sample(range(-500, 500), 60)
    docs = docs_frame(spark, [f"text {i} " + words(rng, i % 7 + 1) for i in ids], ids)
    for per_range in (1, 7, 1000):
        got = imatch.with_next(docs, rows_per_range=per_range).where("not copy").collect()
        by_id, order = {r["doc_id"]: r for r in got}, sorted(ids)
        assert len(got) == len(ids)
        for i, after in zip(order, order[1:] + order[:1], strict=True):
            assert by_id[i]["next_text"].startswith(f"text {after} "), (per_range, i)


def test_range_of_agrees_with_counting(spark):
    cuts = sorted(random.Random(1).sample(range(1000), 50))
    got = spark.range(1000).select("id", imatch._range_of(F.col("id"), cuts).alias("r")).collect()
    assert all(r["r"] == sum(c <= r["id"] for c in cuts) for r in got)


def test_fingerprints_edits_and_odd_rows(spark):
    rng = random.Random(12)
    texts = [words(rng, 120, 5000) for _ in range(150)]
    texts[40] = texts[7]
    docs = clashing(docs_frame(spark, texts))
    got = {r["doc_id"]: r for r in imatch.fingerprints(docs, low=0.005, high=0.2).collect()}
    assert got[7]["fingerprint"] == got[40]["fingerprint"] and len(got) == len(texts)
    edited, after = [r["near_edited"] for r in got.values()], [r["near_next"] for r in got.values()]
    assert sum(edited) / len(edited) > 0.2 and sum(after) / len(after) < 0.05
    k = len(texts[3]) // 4
    import hashlib
    assert got[3]["edited_sha256"] == hashlib.sha256((texts[3][:-k] + texts[4][:k]).encode()).hexdigest()
    odd = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    rows = imatch.fingerprints(odd).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 8, None)}) == 1
    assert imatch.fingerprints(odd.limit(0)).count() == 0
    (only,) = imatch.fingerprints(odd.where("doc_id = 4")).collect()
    assert only["near_next"] == 1.0


# ---------------------------------------------------------------- near-duplicates
def brute_components(texts, k):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_agree_with_brute_force(spark, k):
    rng = random.Random(k)
    texts = []
    for _ in range(12):
        base = words(rng, rng.randrange(30, 120), 3000).split()
        for _ in range(rng.randrange(1, 14)):            # chains of edits around the threshold
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 8))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
            texts.append(" ".join(w))
            if rng.random() < 0.3:
                base = w
    texts += ["", None, " ", "one", "ONE", "one two", "one two", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    sizes, roots = brute_components(texts, k)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(clashing(docs_frame(spark, texts)), words=k).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == list(zip(sizes, roots, strict=True))
    left = pick(minhash.keep_one_of_each(clashing(docs_frame(spark, texts)), words=k), doc_id="doc_id").collect()
    assert {r["doc_id"] for r in left} == set(roots)


def test_outliers_in_a_bucket_are_all_compared(spark):
    """A bucket whose members are not all linked to its pivot: nothing linked may be lost."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for g in range(6):                                    # groups far from each other but sharing most of a text
        own = base[:70] + [f"g{g}_{i}" for i in range(30)]
        for _ in range(5):
            w = list(own)
            for _ in range(4):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
            texts.append(" ".join(w))
    _, roots = brute_components(texts, 2)
    hashes = minhash._Hashes()
    sets = [minhash.shingle_set(t.encode(), 2, hashes) for t in texts]
    _, sketch = minhash.half_keys(sets, *minhash._parameters(2 * minhash.HALVES * minhash.ROWS))
    members = spark.createDataFrame([(k, i, len(s), len(texts)) for k in range(3) for i, s in enumerate(sets)], "key long, node long, n long, size long")
    sketches = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sketch)], "node long, sketch binary")
    frame = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    for block in (minhash.BLOCK, 4):                      # one piece of work, and many blocks
        found = {r["node"]: r["root"] for r in minhash._linked_roots(members, sketches, frame, 2, block, 100 * block).collect()}
        assert [found.get(i, i) for i in range(len(texts))] == roots


def test_near_duplicates_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    got = rows_of(minhash.near_duplicates(docs, words=2).select("doc_id", "n_shingles", "component_id", "kept"))
    assert len(got) == len(ODD_TEXTS) and got.count((3, 1, 3, True)) == 2 and (None, 0, None, True) in got and (7, 1, 7, True) in got
    kept = minhash.keep_one_of_each(docs, words=2)
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 1 and kept.count() == len(ODD_TEXTS) - 1
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_bucket_entries_follow_their_number(spark, monkeypatch):
    """Few bytes of nodes make many entries: a task makes a bounded number of them."""
    monkeypatch.setattr(minhash, "TASK_ENTRIES", 1000)
    tables = minhash.HALVES ** 2
    nodes = spark.createDataFrame([([i * 100 + h for h in range(2 * minhash.HALVES)], i, 5) for i in range(200)],
                                  "halves array<long>, node long, n long").coalesce(1)
    entries = minhash._entries(nodes)
    sizes = [r["n"] for r in entries.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 200 * tables and len(sizes) > 10 and max(sizes) <= 3000 and entries.select("key").distinct().count() == 200 * tables


def test_worker_keeps_one_operators_value():
    built = []
    for key in ("toxicity:1", "toxicity:1", "automaton:1", "toxicity:1"):
        worker_cache(f"test-{key}", lambda key=key: built.append(key))
    assert built == ["toxicity:1", "automaton:1", "toxicity:1"]


def test_components_of_long_paths(spark):
    rng = random.Random(2)
    nodes = rng.sample(range(10_000), 300)
    edges = list(zip(nodes[:199], nodes[1:200], strict=True)) + [(nodes[200], n) for n in nodes[201:]]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges + [(5, 5)], "a long, b long")).collect()}
    assert all(got[n] == min(nodes[:200]) for n in nodes[:200]) and all(got[n] == min(nodes[200:]) for n in nodes[200:])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_edges_take_few_tasks(spark, monkeypatch):
    """Tables between the steps have a file a task: their number follows the edges, not the session's shuffle partitions."""
    files = collections.Counter()

    def counted(df, tag):
        out = real(df, tag)
        files[tag] = max(files[tag], len(out.inputFiles()))
        return out
    real = cc.staged
    monkeypatch.setattr(cc, "staged", counted)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (2000, 2001), (2001, 2000)]
    try:
        for k, v in zip(old, ("40", "false"), strict=True):
            spark.conf.set(k, v)
        got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1200)} | {2000: 2000, 2001: 2000}
    cores = spark.sparkContext.defaultParallelism
    assert all(files[t] <= cores for t in ("cc-least", "cc-large", "cc-small")), files
