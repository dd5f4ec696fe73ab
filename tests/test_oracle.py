"""Every registered query against its DuckDB oracle on the smallest test tables."""

import collections
import contextlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlake.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _bag(rows):
    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return collections.Counter(tuple(norm(v) for v in r) for r in rows)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert len(got) == len(want)
    assert _bag(got) == _bag(want)


def test_every_query_has_docs_and_runs_without_oracle_only_when_listed(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and set(QUERIES) <= set(qs)
    assert set(QUERIES) == set(ORACLE)
    assert all(q.__doc__ for q in QUERIES.values())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]
