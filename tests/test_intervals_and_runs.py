"""As-of joins without a window, interval conflicts, steps side by side, resumed runs and incremental marts."""

import datetime as dt
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F
from test_oracle import plan_text

from ledgerlake.operators import joins
from ledgerlake.operators.joins import asof_join, blocks, bounded_broadcast, interval_conflicts
from ledgerlake.plans import daily_run, exchange
from ledgerlake.plans.loader import detail_table, load_table
from ledgerlake.queries import QUERIES
from ledgerlake.queries_more import _detail_files
from ledgerlake.schemas import LOG_INFO, TABLES
from ledgerlake.sinks.store import AppendLog, PartitionedTable, VersionedTable
from ledgerlake.sources.bank_views import BankTables

SF = "/root/testdata/sf0.001"
DAY0 = dt.date(1900, 1, 1)


def _day(n):
    return DAY0 + dt.timedelta(days=n)


def _intervals(rng, n, keys):
    out = []
    for i in range(n):
        s = rng.randrange(60000)
        out.append((rng.randrange(keys), i, _day(s), _day(s + rng.choice([0, 1, 15, 16, 17, 300, 5000, 90000, -3]))))
    return out + [(0, n, None, _day(5)), (0, n + 1, _day(5), None), (1, n + 2, DAY0, dt.date(9999, 12, 31))]


def test_blocks_are_disjoint_and_cover_the_interval(spark):
    rows = _intervals(random.Random(3), 60, 3)
    df = spark.createDataFrame(rows, "k int, i int, s date, e date")
    for i, got in {r.i: r.b for r in blocks(df, "s", "e").groupBy("i").agg(F.collect_list(F.struct("_grain", "_block")).alias("b")).collect()}.items():
        s, e = next((r[2], r[3]) for r in rows if r[1] == i)
        runs = sorted((g * b, g * b + g) for g, b in got)
        epoch = dt.date(1970, 1, 1)
        assert runs[0][0] == (s - epoch).days and runs[-1][1] == (e - epoch).days + 1
        assert all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False)) and len(runs) < 150


@pytest.mark.parametrize(("how", "salts"), [("left", 1), ("inner", 1), ("left", 5)])
def test_asof_join_without_a_window_equals_the_range_join(spark, how, salts):
    rng = random.Random(7)
    right = spark.createDataFrame(_intervals(rng, 200, 4), "k int, i int, s date, e date")
    left = spark.createDataFrame([(0 if n % 3 == 0 else rng.randrange(5), n, _day(rng.randrange(61000))) for n in range(600)] + [(None, 900, _day(1)), (1, 901, None)],
                                 "k int, n int, d date")
    out = asof_join(left, right, "k", "d", "s", "e", how, salts=salts)
    r = right.select(F.col("k").alias("k2"), "i", "s", "e")
    want = left.join(r, (F.col("k") == F.col("k2")) & F.col("d").between(F.col("s"), F.col("e")), how).select("k", "d", "n", "i")
    assert sorted(map(repr, out.select("k", "d", "n", "i").collect())) == sorted(map(repr, want.collect()))
    plan = plan_text(out)
    residuals = [line for line in plan.splitlines() if line.startswith("Join condition")]
    assert "BroadcastNestedLoopJoin" not in plan and residuals and all(line.endswith(": None") for line in residuals)


def test_asof_join_deals_a_multiplied_result_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 200)
    right = spark.createDataFrame([(0, i, _day(0), _day(9)) for i in range(30)], "k int, i int, s date, e date")
    left = spark.createDataFrame([(0, n, _day(0 if n < 100 else n % 10)) for n in range(200)] + [(None, 200, None)], "k int, n int, d date")
    out = asof_join(left, right, "k", "d", "s", "e", salts=2).persist()
    rows = [tuple(r) for r in out.select("n", "i").collect()]
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    out.unpersist()
    assert sorted(rows, key=repr) == sorted([(n, i) for n in range(200) for i in range(30)] + [(200, None)], key=repr)
    assert len(sizes) > 10 and max(sizes) < 6000 / 4


def test_asof_join_deals_rows_without_an_answer_too(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 200)
    right = spark.createDataFrame([(0, i, _day(0), _day(9)) for i in range(30)], "k int, i int, s date, e date")
    left = spark.createDataFrame([(n % 3 or None, n, _day(n % 50)) for n in range(4000)] + [(0, 4000 + n, _day(n)) for n in range(10)] + [(0, 4010, None)], "k int, n int, d date")
    out = asof_join(left, right, "k", "d", "s", "e", salts=2).persist()
    rows = [tuple(r) for r in out.select("n", "i").collect()]
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    out.unpersist()
    assert sorted(rows, key=repr) == sorted([(n, None) for n in range(4000)] + [(4000 + n, i) for n in range(10) for i in range(30)] + [(4010, None)], key=repr)
    assert len(sizes) > 10 and max(sizes) < 1000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_join_with_salts_and_a_window_equals_the_one_without(spark, monkeypatch, how):
    monkeypatch.setattr(joins, "TASK_ROWS", 20)
    d = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    rng = random.Random(5)
    right = spark.createDataFrame([(rng.randrange(3), i, d(s := rng.randrange(60)), d(s + rng.randrange(40))) for i in range(40)], "k int, i int, s date, e date")
    left = spark.createDataFrame([(rng.randrange(4), n, d(rng.randrange(60))) for n in range(100)] + [(None, 100, d(1)), (1, 101, None)], "k int, n int, d date")
    windowed, whole, plain = (sorted(map(repr, asof_join(left, right, "k", "d", "s", "e", how, **x).select("k", "d", "n", "i").collect()))
                              for x in ({"window": (d(0), d(99)), "salts": 3}, {"salts": 3}, {}))
    assert windowed == whole == plain and len(plain) > 100


def test_asof_history_formats_days_of_events_and_broadcasts_no_blocks(spark, workdir, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 50)
    spark.range(300).selectExpr("id * 7 AS event_id", "IF(id % 9 = 0, NULL, id) AS user_id").unionAll(spark.sql("SELECT NULL, 3")).write.parquet(f"{workdir}/events.parquet")
    spark.range(400).selectExpr("id AS s_suppkey", "'x' AS s_name", "1 AS s_nationkey", "CAST(1 AS DOUBLE) AS s_acctbal").write.parquet(f"{workdir}/supplier.parquet")
    out = QUERIES["asof_history"](spark, workdir)
    plan = plan_text(out)
    assert "BroadcastHashJoin" not in plan
    steps = plan[:plan.index("\n\n(1)")].splitlines()                # the tree, top first; then each step by its number
    joined = next(i for i, line in enumerate(steps) if "Join" in line)
    formats = [int(text[:text.index(")")]) for text in plan.split("\n(")[1:] if "date_format(" in text]
    assert formats and not any(f"({n})" in line for n in formats for line in steps[:joined])
    text = "SELECT event_id, user_id % 40 AS k, date_add(DATE'1997-06-01', CAST(event_id % 700 AS INT)) AS day FROM {e}"
    versions = "SELECT s_suppkey, s_suppkey % 50 AS k, date_add(DATE'1997-01-01', CAST(s_suppkey * 37 % 900 AS INT)) AS s, CAST(s_suppkey * s_suppkey % 400 AS INT) AS days FROM {s}"
    want = spark.sql(f"SELECT e.k, CAST(day AS STRING) AS day, event_id, s_suppkey FROM ({text}) e LEFT JOIN ({versions}) v ON e.k = v.k AND day BETWEEN s AND date_add(s, days)",
                     e=spark.read.parquet(f"{workdir}/events.parquet"), s=spark.read.parquet(f"{workdir}/supplier.parquet"))
    assert out.columns == want.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect())) and out.where("s_suppkey IS NOT NULL").count() > 200


def test_interval_conflicts_are_found(spark):
    d = dt.date
    rows = [(1, d(2020, 1, 1), d(2020, 1, 31)), (1, d(2020, 2, 1), d(2020, 2, 29)),                       # clean
            (2, d(2020, 1, 1), d(2020, 1, 31)), (2, d(2020, 1, 20), d(2020, 2, 10)),                      # overlap
            (3, d(2020, 1, 1), d(2020, 1, 5)), (3, d(2020, 1, 8), d(2020, 1, 9)),                         # gap
            (4, d(2020, 1, 5), d(2020, 1, 1)), (5, None, d(2020, 1, 1)), (5, d(2020, 3, 1), None), (6, d(2020, 1, 1), d(2020, 1, 1)), (6, d(2020, 1, 1), d(2020, 1, 1))]
    got = sorted(tuple(r) for r in interval_conflicts(spark.createDataFrame(rows, "k int, s date, e date"), "k", "s", "e").collect())
    assert got == [(2, "overlap", d(2020, 1, 20), 2), (3, "gap", d(2020, 1, 6), 0), (4, "reversed", d(2020, 1, 5), 1),
                   (5, "open", d(2020, 1, 1), 1), (5, "open", d(2020, 3, 1), 1), (6, "overlap", d(2020, 1, 1), 2)]


def test_broadcasts_are_checked_against_the_estimated_size(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/nation.parquet")
    hinted = lambda x: "ResolvedHint" in x._jdf.queryExecution().analyzed().toString()
    assert hinted(bounded_broadcast(df)) and not hinted(bounded_broadcast(df, 10 ** 9))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    assert not hinted(bounded_broadcast(df))


def test_steps_run_side_by_side_and_the_first_failure_cancels(spark):
    both = threading.Barrier(2, timeout=60)
    assert daily_run.side_by_side(spark, {"a": lambda: (both.wait(), 1)[1], "b": lambda: (both.wait(), 2)[1]}) == {"a": 1, "b": 2}

    def slow():
        spark.range(0, 10 ** 15, 1, 2).where("id < 0").count()

    def fails():
        time.sleep(2)
        raise RuntimeError("first failure")

    t0 = time.time()
    with pytest.raises(RuntimeError, match="first failure"):
        daily_run.side_by_side(spark, {"slow": slow, "fails": fails})
    assert time.time() - t0 < 60


def _events(spark, work):
    log = AppendLog(spark, f"{work}/logs/log_info", LOG_INFO).read()
    return {(r.pipeline_run_id, r.event_type) for r in log.where("message_ LIKE '[END]%'").collect()}


def test_a_killed_run_goes_on_and_a_late_posting_file_refreshes_its_days(spark, workdir, monkeypatch):
    files = _detail_files(spark, BankTables(spark, SF), f"{workdir}/files")
    args = (files, f"{workdir}/run", dt.date(1998, 1, 31), dt.date(1998, 1, 20))
    with monkeypatch.context() as m:
        m.setattr(daily_run, "fill_f101", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            daily_run.run_all_from_files(spark, *args)
    out = daily_run.run_all_from_files(spark, *args, resume=True, conflicts="report")
    events = _events(spark, f"{workdir}/run")
    assert (1, "turnover") in events and (2, "f101") in events
    assert (2, "load") not in events and (2, "turnover") not in events and (2, "check") in events
    assert out.f101_csv.endswith("/report_f101_f.csv") and out.min_max_csv.endswith("/report_min_max_1998-01-20.csv")
    assert os.path.isfile(out.min_max_csv.replace("file:", "")) and out.f101.count() > 0

    # a late file: other amounts for the postings of one day
    spec, store = TABLES["ft_posting_f"], f"{workdir}/run/ds/ft_posting_f"
    table = detail_table(spark, spec, store)
    since = table.current()
    late = table.read(["1998-01-12"]).withColumn("credit_amount", F.col("credit_amount") * 2)
    path = f"{workdir}/late.csv"
    exchange.export_csv(late.select(F.lit(1).alias(" "), *late.columns), path, encoding="cp866", single_file=False)
    load_table(spark, spec, path, store)
    days = daily_run.refresh_marts(spark, f"{workdir}/run/ds", f"{workdir}/run", dt.date(1998, 1, 31), since)
    assert days == [dt.date(1998, 1, 12)]
    whole = daily_run.run_all(spark, daily_run.stored_layer(spark, f"{workdir}/run/ds", *args[2:]), f"{workdir}/full", *args[2:])
    turn = PartitionedTable(spark, f"{workdir}/run/dm/dm_account_turnover_f", "on_date").read()
    f101 = VersionedTable(spark, f"{workdir}/run/dm/dm_f101_round_f").read()
    assert sorted(turn.collect()) == sorted(whole.turnover.collect()) and sorted(f101.collect(), key=repr) == sorted(whole.f101.collect(), key=repr)
