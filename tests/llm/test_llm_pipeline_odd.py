"""Every stage of the corpus pipeline on null, empty, very long, repeated and clashing rows, and on an empty table."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import ODD_IDS, ODD_TEXTS, clashing, docs_frame  # noqa: E402

import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", [n for n in STAGES if n != "toxicity"])
def test_stages_take_odd_rows(spark, name):
    docs = clashing(docs_frame(spark, ODD_TEXTS, ODD_IDS))
    out = STAGES[name](spark, docs, SF)
    rows = out.collect()
    if name != "packing":
        assert out.columns == docs.columns
        at = out.columns.index("text")
        assert sum(not (r[at] or "") for r in rows) == sum(not t for t in ODD_TEXTS)
    if name in ("decontamination", "personal_data"):
        assert len(rows) == len(ODD_TEXTS)
    if name == "personal_data":
        n, at = out.columns.index("n_chars"), out.columns.index("text")
        assert all(r[n] == (None if r[at] is None else len(r[at])) for r in rows)


@pytest.mark.parametrize("name", [n for n in STAGES if n != "toxicity"])
def test_stages_take_an_empty_table(spark, name):
    assert STAGES[name](spark, docs_frame(spark, []), SF).collect() == []


def test_toxicity_keeps_odd_rows(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs_frame(spark, ODD_TEXTS, [None] + [10_000_000 + i for i in range(len(ODD_TEXTS) - 1)])
    out = STAGES["toxicity"](spark, clashing(real.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd)), SF)
    at = out.columns.index("text")
    assert sum(not (r[at] or "") for r in out.collect()) >= sum(not t for t in ODD_TEXTS)
