"""The table function of the min/max report against the DataFrame plan."""

from __future__ import annotations

import datetime as dt

from ledgerlake.plans.min_max import min_max_posting
from ledgerlake.plans.sql_functions import create_min_max_posting
from ledgerlake.schemas import FT_POSTING_F, MD_ACCOUNT_D, MD_EXCHANGE_RATE_D

DAY, OTHER, NONE = dt.date(2018, 1, 9), dt.date(2018, 1, 10), dt.date(2018, 1, 11)
START, END = dt.date(2018, 1, 1), dt.date(2050, 12, 31)


def _frames(spark):
    account = lambda rk, cur, code, start=START: (start, END, rk, f"acc{rk}", "A", cur, code)
    accounts = [account(1, 34, "643"), account(2, 35, "840"), account(2, 36, "978", dt.date(2018, 1, 5)), account(3, 37, "156")]
    rates = [(START, END, 35, 57.5, "840"), (START, DAY, 36, 70.25, "978"), (OTHER, END, 36, 71.0, "978")]
    postings = [(DAY, 1, 2, 10.0, 10.0), (DAY, 2, 1, 10.0, 575.0), (DAY, 1, 9, 575.0, 10.0), (DAY, 9, 3, None, 1.5), (DAY, 9, 8, 0.1, 0.1),
                (OTHER, 2, 2, 3.0, 4.0), (OTHER, 3, 1, 5.0, 5.0)]
    return (spark.createDataFrame(postings, FT_POSTING_F), spark.createDataFrame(accounts, MD_ACCOUNT_D),
            spark.createDataFrame(rates, MD_EXCHANGE_RATE_D))


def _created(spark):
    frames = _frames(spark)
    for name, df in zip(("t_postings", "t_accounts", "t_rates"), frames, strict=True):
        df.createOrReplaceTempView(name)
    create_min_max_posting(spark, "t_postings", "t_accounts", "t_rates", "t_min_max")
    return frames


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_table_function_equals_the_plan(spark):
    frames = _created(spark)
    for day in (DAY, OTHER, NONE):
        got = spark.sql(f"SELECT * FROM t_min_max(DATE '{day.isoformat()}')")
        want = min_max_posting(*frames, day)
        assert got.columns == want.columns
        assert _rows(got) == _rows(want) and (day == NONE) == (not _rows(got))
    assert _rows(spark.sql("SELECT * FROM t_min_max(CAST(NULL AS DATE))")) == []


def test_day_reaches_the_scan(spark, workdir):
    _, accounts, rates = _created(spark)
    path = f"{workdir}/postings"
    _frames(spark)[0].write.partitionBy("oper_date").parquet(path)
    spark.read.schema(FT_POSTING_F).parquet(path).createOrReplaceTempView("t_stored")
    create_min_max_posting(spark, "t_stored", "t_accounts", "t_rates", "t_min_max_stored")
    df = spark.sql("SELECT * FROM t_min_max_stored(DATE '2018-01-09')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(oper_date" in plan and "PartitionFilters: []" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert _rows(df) == _rows(min_max_posting(_frames(spark)[0], accounts, rates, DAY))
