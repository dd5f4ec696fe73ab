"""The plans a 100 TB run takes: nothing is broadcast, joins shuffle.

Spark's own broadcast thresholds are off and the hints of bounded dimensions
are taken away; the core queries must still equal their oracles, and their
plans must contain no broadcast join.
"""

import pytest
import __spark_entry__ as E
from ledgerlake.plans import f101, min_max, turnover
from ledgerlake import queries
from test_oracle import SF, TABLES, _bag, plan_text

KEYS = ["turnover_month", "turnover_legs", "asof_rate_left", "f101_faithful", "f101_corrected", "min_max_posting",
        "mirror_faithful", "upsert_last_wins", "ledger_expr_join", "replace_day_range", "mirror_idempotent",
        "run_all", "min_max_asof", "f101_mid_month"]


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    for mod in (turnover, f101, min_max, queries):
        monkeypatch.setattr(mod, "bounded_broadcast", lambda df: df)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_shuffle_join_path_matches_oracle(spark, duck, no_broadcast, key):
    df = E.queries()[key](spark, SF)
    plan = plan_text(df)
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    idx = [ocols.index(c) for c in cols]
    assert _bag(got) == _bag([tuple(r[i] for i in idx) for r in cur.fetchall()])
