"""The plans we want at scale: pushed filters, pruned columns, partial aggregation, no windows."""

import re

import __spark_entry__ as E
from test_oracle import plan_text

SF = "/root/testdata/sf0.001"


def test_turnover_pushes_the_month_into_the_scan_and_preaggregates(spark):
    plan = plan_text(E.queries()["turnover_month"](spark, SF))
    assert re.search(r"PushedFilters: \[IsNotNull\(l_shipdate\), GreaterThanOrEqual\(l_shipdate,1998-01-01", plan)
    assert ("ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_extendedprice:double,"
            "l_shipdate:timestamp_ntz>") in plan
    # legs are summed per (day, account) map-side before the first shuffle and before the account join
    assert "partial_sum" in plan
    assert "Window" not in plan


def test_f101_never_materialises_the_turnover_fan_out(spark):
    plan = plan_text(E.queries()["f101_faithful"](spark, SF))
    assert "Window" not in plan and "CartesianProduct" not in plan
    assert "partial_count" in plan            # turnover days per account, counted before the join


def test_mirror_and_upsert_use_aggregates_not_windows(spark):
    for key in ("mirror_faithful", "mirror_latest"):
        plan = plan_text(E.queries()[key](spark, SF))
        assert "Window" not in plan
        assert "partial_max" in plan


def test_min_max_uses_one_merged_scalar_aggregate(spark):
    plan = plan_text(E.queries()["min_max_posting"](spark, SF))
    assert "Window" not in plan
    df = E.queries()["min_max_posting"](spark, SF)
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString()       # the plan that ran: one aggregate, reused thrice
    ran = ran[:ran.index("+- == Initial Plan ==")] if "+- == Initial Plan ==" in ran else ran
    assert ran.count("ReusedSubquery") == 3


def test_no_job_runs_before_the_query_itself(spark):
    """No size probe: building a query starts no job but the footer reads of its parquet scans."""
    tracker = spark.sparkContext.statusTracker()
    for key in ("f101_faithful", "turnover_month", "min_max_posting", "asof_rate_left"):
        spark.sparkContext.setJobGroup(f"plan-{key}", key)
        df = E.queries()[key](spark, SF)
        names = [tracker.getStageInfo(s).name for j in tracker.getJobIdsForGroup(f"plan-{key}")
                 for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
        assert all(n.startswith("parquet at") for n in names), (key, names)
        plan = plan_text(df)
        assert "SinglePartition" not in plan or key == "min_max_posting", key       # its extremes are a global aggregate
    spark.sparkContext.setJobGroup("rest", "rest")
