"""Mirror files, late and split sessions, replays, parts tables and load constraints."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.latest import latest_per_key
from ledgerlake.plans import mirror
from ledgerlake.plans.loader import ConstraintError, detail_table, load_table
from ledgerlake.schemas import TABLES
from ledgerlake.sinks.parts import PartsTable, key_bucket
from ledgerlake.sinks.store import PartitionedTable
from ledgerlake.streaming import delta_stream
from test_oracle import plan_text

D8 = dt.date


def _local(path):
    return path.replace("file:", "", 1)


def _put(base, session, header, *lines):
    os.makedirs(f"{base}/{session}", exist_ok=True)
    name = "t.csv" if session == 1000 else f"t_{session - 1000}.csv"
    with open(f"{base}/{session}/{name}", "w") as fh:
        fh.write("\n".join([header, *lines]) + "\n")


def _load(spark, base, where, seed=None, **kw):
    return mirror.delta_loading(spark, "t", ["k"], base, f"{where}/log", f"{where}/mirror", seed=seed, **kw)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_files_with_different_headers_together_and_one_at_a_time(spark, workdir):
    seed = spark.createDataFrame([(1, "v", "w")], "k int, v string, w string")
    sessions = [(1000, "k;v;w", "1;vv;ww", "2;a;b"), (1001, "k;w;v", "1;w1;v1", "3;w3;v3"), (1002, "K;V;W;extra", "2;x;y;new")]
    together, apart = f"{_local(workdir)}/d1", f"{_local(workdir)}/d2"
    for s in sessions:
        _put(together, *s)
    a = _load(spark, together, f"{workdir}/a", seed).mirror
    for s in sessions:
        _put(apart, *s)
        b = _load(spark, apart, f"{workdir}/b", seed).mirror
    want = [(1, "v1", "w1", None), (2, "x", "y", "new"), (3, "v3", "w3", None)]
    assert a.columns == b.columns == ["k", "v", "w", "extra"] and _rows(a) == _rows(b) == want


def test_declared_types_win_over_how_a_delta_looks(spark, workdir):
    base = f"{_local(workdir)}/d"
    seed = spark.createDataFrame([(1, "008"), (2, "A08")], "k int, code string")
    _put(base, 1000, "k;code", "3;036")
    assert _rows(_load(spark, base, workdir, seed).mirror) == [(1, "008"), (2, "A08"), (3, "036")]
    _put(base, 1001, "k;code", "x;1")                                  # not a key of the declared type
    with pytest.raises(Exception):
        _load(spark, base, workdir)
    assert _load(spark, f"{_local(workdir)}/none", workdir).mirror.count() == 3


def test_headers_that_cannot_be_matched_are_refused(spark, workdir):
    seed = spark.createDataFrame([(1, "a")], "k int, v string")
    for n, header in enumerate(("v;w", "k;v;V")):
        base = f"{_local(workdir)}/bad{n}"
        _put(base, 1000, header, "1;2;3")
        with pytest.raises(ValueError):
            _load(spark, base, f"{workdir}/bad{n}", seed)
    base = f"{_local(workdir)}/pos"
    _put(base, 1000, "any;name", "1;b")
    assert _rows(_load(spark, base, f"{workdir}/pos", seed, positional=True).mirror) == [(1, "b")]


def test_late_older_session_never_wins_in_the_batch_job(spark, workdir):
    base = f"{_local(workdir)}/d"
    _put(base, 1001, "k;v", "1;new")
    _load(spark, base, workdir, spark.createDataFrame([(1, "s")], "k int, v string"))
    _put(base, 1000, "k;v", "1;old", "2;only")
    assert _rows(_load(spark, base, workdir).mirror) == [(1, "new"), (2, "only")]


def test_a_crash_between_the_switch_and_the_log_applies_nothing_twice(spark, workdir, monkeypatch):
    base = f"{_local(workdir)}/d"
    _put(base, 1000, "k;v", "1;a", "1;b")
    seed = spark.createDataFrame([(1, "s"), (2, "t")], "k int, v string")

    def dies(self, df):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(mirror.AppendLog, "append", dies)
        with pytest.raises(RuntimeError):
            _load(spark, base, workdir, seed)
    _put(base, 1001, "k;v", "3;c")
    again = _load(spark, base, workdir)
    assert again.applied == [1000, 1001] and _rows(again.mirror) == [(1, "a"), (1, "b"), (2, "t"), (3, "c")]


def test_only_touched_buckets_are_rewritten(spark, workdir):
    base = f"{_local(workdir)}/d"
    _put(base, 1000, "k;v", "1;a")
    seed = spark.createDataFrame([(i, "s") for i in range(200)], "k int, v string")
    _load(spark, f"{_local(workdir)}/none", workdir, seed)
    table = PartsTable(spark, f"{workdir}/mirror")
    before = table.parts()
    _load(spark, base, workdir)
    after = table.parts()
    assert set(before) == set(after) and sum(before[p] != after[p] for p in before) == 1


def test_split_session_adds_up_and_a_replayed_epoch_changes_nothing(spark, workdir):
    mpath = f"{workdir}/mirror"
    delta_stream.seed_mirror(spark, spark.createDataFrame([(1, "s"), (2, "t")], "k int, v string"), mpath, ["k"])
    step = delta_stream.batch_writer(spark, mpath, ["k"], "ckpt", keep_versions=2)
    part = lambda *rows: spark.createDataFrame(list(rows), "k int, v string, delta_id int")
    step(part((1, "a", 1000)), 0)
    step(part((2, "b", 1000), (1, "a2", 1000)), 1)                     # the rest of the same session
    want = [(1, "a"), (1, "a2"), (2, "b")]
    assert _rows(delta_stream.read_mirror(spark, mpath)) == want
    step(part((2, "b", 1000), (1, "a2", 1000)), 1)                     # replayed after a restart
    assert _rows(delta_stream.read_mirror(spark, mpath)) == want
    step(part((1, "late", 999)), 2)
    assert _rows(delta_stream.read_mirror(spark, mpath)) == want
    assert len(PartsTable(spark, mpath).numbers()) == 2                # pruned


def test_latest_mode_reduces_once_then_only_touched_keys(spark, workdir):
    base = f"{_local(workdir)}/d"
    seed = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    _put(base, 1000, "k;v", "2;y", "2;z")
    out = _load(spark, base, workdir, seed, mode="latest", order=["v"])
    assert _rows(out.mirror) == [(1, "b"), (2, "z")]
    small = spark.createDataFrame([(2, "q", 1001)], "k int, v string, delta_id int")
    tagged = PartsTable(spark, f"{workdir}/mirror").read()
    plan = plan_text(mirror.apply_deltas(tagged, small, ["k"], "latest", ["v"], reduced=True))
    assert "LeftAnti" in plan                                          # untouched rows bypass the reduction
    assert _rows(mirror.apply_deltas(tagged, small, ["k"], "latest", ["v"], reduced=True)) == _rows(
        latest_per_key(tagged.unionByName(small), ["k"], ["delta_id", "v"]).drop("delta_id"))


def test_replacing_a_range_is_one_switch_and_refuses_stray_rows(spark, workdir):
    schema = "on_date date, v int"
    t = PartitionedTable(spark, f"{workdir}/t", "on_date")
    t.replace_range(spark.createDataFrame([(D8(2018, 1, d), d) for d in (1, 2, 3)], schema), D8(2018, 1, 1), D8(2018, 1, 31))
    before = t.table.parts()
    with pytest.raises(ValueError):
        t.replace_range(spark.createDataFrame([(D8(2018, 1, 2), 9), (D8(2018, 2, 1), 9)], schema), D8(2018, 1, 2), D8(2018, 1, 3))
    assert t.table.parts() == before and _rows(t.read()) == [(D8(2018, 1, d), d) for d in (1, 2, 3)]
    assert t.replace_range(spark.createDataFrame([(D8(2018, 1, 2), 20)], schema), D8(2018, 1, 2), D8(2018, 1, 3)) == 1
    assert t.table.parts()["2018-01-01"] == before["2018-01-01"]
    assert _rows(t.read()) == [(D8(2018, 1, 1), 1), (D8(2018, 1, 2), 20)]
    assert _rows(t.read(D8(2018, 1, 2), D8(2018, 1, 2))) == [(D8(2018, 1, 2), 20)]


def test_parts_table_prunes_and_keeps_what_the_newest_manifest_names(spark, workdir):
    t = PartsTable(spark, f"{workdir}/p")
    part = key_bucket(["k"], 4)
    t.replace(spark.createDataFrame([(k, 0) for k in range(40)], "k int, v int"), part)
    for v in (1, 2, 3):
        rows = t.read(["1"]).withColumn("v", F.lit(v))
        t.replace(rows, part, ["1"])
    assert t.prune(1) == [1, 2, 3] and t.numbers() == [4]
    assert t.read().count() == 40 and t.read(["1"]).select("v").distinct().collect()[0][0] == 3


def test_constraints_fail_the_load_or_send_rows_to_rejects(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    f = f"{_local(workdir)}/md_currency_d.csv"
    with open(f, "w", encoding="cp866") as fh:
        fh.write("\t;CURRENCY_RK;DATA_ACTUAL_DATE;CURRENCY_CODE\n1;34;2018-01-01;643\n2;;2018-01-01;840\n3;35;2018-01-01;1234567\n")
    spec, store = TABLES["md_currency_d"], f"{workdir}/ds"
    with pytest.raises(ConstraintError, match="currency_code, currency_rk"):
        load_table(spark, spec, f, store)
    assert not detail_table(spark, spec, store).exists()
    out = load_table(spark, spec, f, store, bad_values="reject")
    assert (out.rows_in_file, out.rows_rejected) == (3, 2)
    assert [r.currency_rk for r in detail_table(spark, spec, store).read().collect()] == [34]
    assert sorted(r.bad_columns for r in spark.read.parquet(f"{store}_rejects").collect()) == [["currency_code"], ["currency_rk"]]


def test_rows_in_file_counts_the_whole_file(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    f = f"{_local(workdir)}/ft_balance_f.csv"
    with open(f, "w", encoding="cp866") as fh:
        fh.write("\t;ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n")
        fh.writelines(f"{i};31.12.2017;{i % 700};35;{i}.5\n" for i in range(1000))
    out = load_table(spark, TABLES["ft_balance_f"], f, f"{workdir}/ds")
    table = detail_table(spark, TABLES["ft_balance_f"], f"{workdir}/ds")
    assert out.rows_in_file == 1000 and table.read().count() == 700
    assert table.read().where("account_rk = 5").first().balance_out == 705.5           # the last row of the key won
