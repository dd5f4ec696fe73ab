"""The registered opN queries and the pipeline on the smallest test tables: DuckDB SQL or brute force."""

import hashlib
import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from test_llm_corpus_ops import brute_components  # noqa: E402
from test_llm_text_ops import _key, brute_hits, brute_spans  # noqa: E402

import corpus_pipeline  # noqa: E402
from ledgerlake.llm.common import staged  # noqa: E402
from ledgerlake.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    at = [[d[0] for d in want.description].index(c) for c in df.columns]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_op1_columns(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    assert set(rows) == {i for i, _ in documents}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_op2_and_op3_cover_every_document(spark, documents):
    ids = {i for i, _ in documents}
    assert {r["doc_id"] for r in QUERIES["op2_repeated_lines"](spark, SF).collect()} == ids
    tokens = {r["doc_id"]: r["n"] for r in QUERIES["op3_packing"](spark, SF).groupBy("doc_id").agg({"n_tokens": "sum"})
              .withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert tokens == {i: len((t or "").encode().split()) for i, t in documents}


def test_op5_columns(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op5_suffix_tree"](spark, SF).collect()}
    train = sum(len((t or "").encode().split()) + 1 for i, t in documents if zlib.crc32(str(i).encode()) % 5 != 1)
    assert {r["train_tokens"] for r in rows.values()} == {train}
    assert all(rows[i]["n_tokens"] == len((t or "").encode().split()) + 1 for i, t in documents)


def test_op6_base_spans(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op6_personal_data"](spark, SF).collect()}
    for i, t in documents:
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_spans(t or ""))
        assert rows[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and rows[i]["spans"].startswith(want)
        assert [rows[i][f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(s[0] == k for s in brute_spans(t or "")) for k in ("email", "ip", "card", "phone")]


def test_op9_exact_cut(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op9_shards"](spark, SF).collect()}
    size = lambda t: len((t or "").encode()) + 16
    total, before, slots = sum(size(t) for _, t in documents), 0, {}
    for _, i, t in sorted((_key(i, t), i, t) for i, t in documents):
        shard = min(39, (2 * before + size(t)) * 40 // (2 * total))
        assert (rows[i]["size"], rows[i]["shard"], rows[i]["slot"], rows[i]["law"]) == (size(t), shard, slots.get(shard, 0), "bytes")
        slots[shard] = slots.get(shard, 0) + 1
        before += size(t)


def test_pipeline_stages_against_brute_force(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test")
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    before = sorted(kept["toxicity"].items())
    _, roots = brute_components([t for _, t in before], 5)
    assert set(kept["near_duplicates"]) == {before[r][0] for r in roots}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for i, t in kept["near_duplicates"].items() if brute_hits(t, items)[1]}
    assert set(kept["decontamination"]) == set(kept["near_duplicates"]) - hit
    for i, t in kept["personal_data"].items():
        assert not brute_spans(t) and (brute_spans(kept["decontamination"][i]) or "[TERM]" in t or t == kept["decontamination"][i]
                                       or len(t) < len(kept["decontamination"][i]))
    packed = {}
    for r in docs.collect():
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_tokens"]
    assert packed == {i: len(t.encode().split()) for i, t in kept["personal_data"].items()}


def test_pipeline_run_returns_the_last_stage(spark):
    out = corpus_pipeline.QUERIES["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "piece", "start_token", "n_tokens", "bucket_len", "batch", "row", "padding"] and out.count() > 0
