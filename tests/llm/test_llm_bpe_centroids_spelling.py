"""BPE, centroid clustering and spelling variants against the tokenizers library, plain numpy and brute force."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import ODD_IDS, ODD_TEXTS, clashing, docs_frame, rows_of  # noqa: E402

from ledgerlake.llm import bpe, centroids, spelling  # noqa: E402
from ledgerlake.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(FILE)


def _digest(data) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def test_op11_equals_the_library(spark, tokenizer):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), _digest(",".join(map(str, ids))), _digest(tokenizer.decode(ids, skip_special_tokens=False))))
    assert rows_of(QUERIES["op11_bpe"](spark, SF)) == sorted(want, key=repr)


def test_odd_texts(spark, tokenizer, vocabulary):
    rng = random.Random(5)
    texts = ODD_TEXTS + ["a<|endoftext|>b<|endoftext|>", "<|endoftext", "՘x \U00010940y", "a　  b  c\r\n\t d", "\0\x7f�‍",
                         "😀👩‍👩‍👧" * 9, "日本語のテキスト" * 30, "-" * 999, "0" * 333 + "½²", "I'LL we've don't 's's", " " * 700 + "x"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x600), rng.randrange(0x4E00, 0x4F00), 0x20])) for _ in range(300)) for _ in range(40)]
    ids = ODD_IDS + list(range(100, 100 + len(texts) - len(ODD_IDS)))
    out = bpe.decode(bpe.encode(clashing(docs_frame(spark, texts, ids)), vocabulary), vocabulary)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert rows_of(out) == sorted(((i, w, tokenizer.decode(w, skip_special_tokens=False)) for i, w in zip(ids, want, strict=True)), key=repr)
    assert rows_of(bpe.encode(docs_frame(spark, []), vocabulary)) == []


def test_any_ids_decode(spark, tokenizer, vocabulary):
    rng = random.Random(7)
    rows = [(i, [rng.randrange(50257) for _ in range(50)]) for i in range(30)] + [(31, None), (32, []), (33, [-1, 99999, 50256])]
    got = {r["doc_id"]: r["text"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary).collect()}
    assert got == {i: tokenizer.decode([x for x in ids or [] if 0 <= x < 50257], skip_special_tokens=False) for i, ids in rows}


def test_every_character_is_cut_as_the_library_cuts_it(tokenizer, vocabulary):
    tables = bpe._Tables(vocabulary)
    for base in range(0, 0x110000, 256):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in range(base, base + 256) if not 0xD800 <= c < 0xE000)
        assert tables._pieces(text) == [text[a:z] for _, (a, z) in tokenizer.pre_tokenizer.pre_tokenize_str(text)], hex(base)


def test_shared_prefixes_and_full_caches(tokenizer, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 10)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 10)
    tables = bpe._Tables(vocabulary)
    words = ["un", "unable", "unabated", "unb", "u", "ununun", "nation", "national", "nationalisation", "n" * 70]
    for _ in range(3):
        for text in (" ".join(words), " ".join(words[::-1]), "other words come between"):
            assert np.frombuffer(tables.encode([text])[0], np.int32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))


# ---------------------------------------------------------------- centroid clustering
def brute_clusters(rows, k=16, rounds=3, dim=64):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [v for _, v in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(rounds + 1):
        near = [min((far(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
        if step < rounds:
            for j in range(len(cents)):
                mine = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == j]
                if mine:
                    cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    sums = Counter()
    for d, c in near if kept else []:
        sums[c] += d
    return sorted(((i, c, d, sums[c], sum(sums.values()), _digest(",".join(map(str, cents[c])))) for (i, _), (d, c) in zip(kept, near if kept else [], strict=True)), key=repr)


def test_op12_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows_of(QUERIES["op12_centroids"](spark, SF)) == brute_clusters(rows)


@pytest.mark.parametrize("size", [0.3, 50.0, 30000.0])
def test_odd_vectors(spark, size):
    rng = random.Random(int(size))
    rows = [(i, [rng.gauss(0, size) for _ in range(4)]) for i in range(300)] + [(5, [0.0] * 4)] * 3
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (400, None), (401, []), (402, [1.0] * 3), (403, [1.0] * 5), (404, [1.0, None, 1.0, 1.0]),
             (405, [math.nan, 0.0, 0.0, 0.0]), (406, [math.inf, 0.0, 0.0, 0.0]), (407, [1e30, 0.0, 0.0, 0.0])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = brute_clusters([r for r in rows if r[0] != 407], k=7, dim=4)
    assert rows_of(centroids.report(centroids.cluster(df, k=7, dim=4, leading=2))) == want


def test_few_and_no_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert rows_of(centroids.report(centroids.cluster(df, k=2, dim=2))) == brute_clusters(rows, k=2, dim=2)


def test_the_filter_leaves_out_and_loses_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (16, 64))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-9, 9, (3000, 64))
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    lead, rest = centroids._rotated(x, axes, 12)
    got, distance, measured = centroids.Model(centres, axes, 12).nearest(x, lead.astype(np.float32), rest.astype(np.float32))
    full = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (got == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert measured < 1.5 * len(x)                        # of 16 distances a vector


# ---------------------------------------------------------------- spelling variants
def brute_words(rows, least=7):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def brute_variants(n, factor=10):
    by_gap = {}
    for w in n:                                           # words with one letter left out, and which
        for i in range(len(w)):
            by_gap.setdefault(w[:i] + w[i + 1:], set()).add((w, i))
    near = {w: set() for w in n}
    for gap, of in by_gap.items():
        for a, i in of:
            near[a] |= {b for b, j in of if j == i and b != a}
            if gap in n:
                near[a].add(gap)
                near[gap].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def test_op13_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_spelling"](spark, SF)) == brute_variants(brute_words(rows))


@pytest.mark.parametrize(("block", "piece"), [(20_000, 20_000), (40, 7), (5, 1)])
def test_slices_of_hot_halves_lose_nothing(spark, block, piece):
    rng = random.Random(block)
    words = {"aaaaaaa" + "".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(200)}
    words |= {"".join(rng.choice("abà") for _ in range(rng.randrange(7, 12))) for _ in range(400)}
    words |= {w[:i] + w[i + 1:] for w in list(words)[:100] for i in (0, 3, len(w) - 1) if len(w) > 7}
    n = {w: rng.choice([2, 3, 30, 400]) for w in sorted(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows_of(spelling.group_variants(df, 10, block, piece)) == brute_variants(n)


def test_odd_documents(spark):
    texts = ODD_TEXTS + ["Straßenbahn STRASSENBAHN straßenbahn Àrbolito àrbolito", "a" * 50 + " " + "a" * 50, "abcdefg abcdefg abcdefh xabcdefg x123abcdefh"] * 2
    ids = ODD_IDS + [20, 21, 22, 20, 21, None]
    got = spelling.group_variants(spelling.count_words(clashing(docs_frame(spark, texts, ids)), error_every=31))
    assert rows_of(got) == brute_variants(brute_words(zip(ids, texts, strict=True)))
    assert rows_of(spelling.group_variants(spelling.count_words(docs_frame(spark, [])))) == []


def test_roots_follow_long_chains(spark):
    n = {"a" * (7 + i): 2 * 10 ** i for i in range(9)}
    got = spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert rows_of(got) == brute_variants(n)
    assert {r["root"] for r in got.collect()} == {"a" * 15}
