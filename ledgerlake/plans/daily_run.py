"""``run_all`` (L11): the reference's task graph as one plain function.

Order as in the reference: detail files loaded (``run_all_from_files``) ->
turnover for the month -> form 101 -> export to CSV -> import into a copy
table; min/max postings of a day after the detail layer, exported as
``report_min_max_<date>.csv``.  The six loads run side by side, and min/max
beside the chain of marts: driver threads with a scheduler pool each, so Spark
shares its executors between their jobs.  The first failure cancels the jobs of
the others.  Every step logs a BEGIN and an END row with the rows it affected,
its inputs and the run id claimed at the start.

The turnover mart is partitioned by day and a rerun replaces exactly the days
of the range (W2); the small form-101 mart is a versioned table whose month is
replaced (W3).  Both make a rerun idempotent.  A run from files may ``resume``:
loads and marts whose last END was logged with equal inputs (names, sizes and
times of the files, dates) are not done again.

``incremental`` marts (``refresh_marts``): a late posting file recomputes the
days it touched and the report of the month.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import py_month_bounds, py_prev_month_end
from ledgerlake.operators.joins import interval_conflicts
from ledgerlake.operators.upsert import replace_where
from ledgerlake.plans import exchange, f101 as f101_plan, min_max, runlog, turnover
from ledgerlake.plans.loader import detail_table, load_table
from ledgerlake.schemas import DM_ACCOUNT_TURNOVER_F, DM_F101_ROUND_F, TABLES
from ledgerlake.sinks import fs
from ledgerlake.sinks.store import PartitionedTable, VersionedTable


@dataclass
class DetailLayer:
    ledger: DataFrame
    accounts: DataFrame
    currency: DataFrame
    balances: DataFrame
    rates: DataFrame
    postings: DataFrame


@dataclass
class RunOutput:
    run_id: int
    turnover: DataFrame
    f101: DataFrame
    f101_copy: DataFrame
    min_max: DataFrame
    f101_csv: str
    min_max_csv: str


def side_by_side(spark: SparkSession, tasks: dict[str, Callable]) -> dict:
    """Results of independent tasks, each run in a driver thread and a scheduler pool of its name.

    The first failure cancels the Spark jobs of the others and is raised.
    """
    sc, tag = spark.sparkContext, f"ledgerlake-{uuid.uuid4().hex[:8]}"

    def run(name: str, task: Callable):
        sc.setLocalProperty("spark.scheduler.pool", name)
        sc.addJobTag(tag)
        return task()

    with ThreadPoolExecutor(max(1, len(tasks))) as threads:
        running = {name: threads.submit(inheritable_thread_target(spark)(lambda n=name, t=task: run(n, t))) for name, task in tasks.items()}
        wait(running.values(), return_when=FIRST_EXCEPTION)
        failed = next((f.exception() for f in running.values() if f.done() and f.exception()), None)
        if failed:
            left = set(running.values())
            while left:                                   # also jobs that the others are only about to start
                sc.cancelJobsWithTag(tag)
                left = wait(left, timeout=1).not_done
            raise failed
        return {name: f.result() for name, f in running.items()}


def run_all(spark: SparkSession, ds: DetailLayer, work: str, on_date: dt.date, min_max_date: dt.date,
            fanout: str = "faithful", clock=dt.datetime.now, log: runlog.RunLogger | None = None, inputs: str | None = None,
            resume: bool = False, conflicts: str = "ignore") -> RunOutput:
    """``inputs`` names the state of the detail layer; with ``resume`` marts already made from it are kept.

    ``conflicts``: "ignore", "report" (count overlapping, missing or reversed versions of accounts and rates in the log) or
    "refuse" (overlaps, which would double amounts, are an error).
    """
    work = work.rstrip("/")
    log = log or runlog.RunLogger(spark, f"{work}/logs/log_info", clock)
    ms, me = py_month_bounds(on_date)
    out_dir = f"{work}/export/run-{log.run_id}"
    if conflicts != "ignore":
        check_versions(log, ds, conflicts == "refuse")

    def marts() -> tuple[DataFrame, DataFrame, str, DataFrame]:
        name = f"looped_fill_turnover(date_to => {on_date.isoformat()})"
        turn_store = PartitionedTable(spark, f"{work}/dm/dm_account_turnover_f", "on_date", DM_ACCOUNT_TURNOVER_F)
        if not (resume and inputs and log.finished(name, "turnover", inputs)):
            with log.step(name, "turnover", inputs) as done:
                done["rows"] = turn_store.replace_range(
                    turnover.account_turnover(ds.postings, ds.accounts, ds.rates, ms, on_date), ms, on_date)
        name = f"fill_f101_round_f(i_OnDate => {on_date.isoformat()})"
        f_store = VersionedTable(spark, f"{work}/dm/dm_f101_round_f", DM_F101_ROUND_F)
        if not (resume and inputs and log.finished(name, "f101", f"{inputs} {fanout}")):
            with log.step(name, "f101", f"{inputs} {fanout}" if inputs else None) as done:
                done["rows"] = fill_f101(spark, ds, turn_store.read(ms, me), f_store, on_date, fanout)
        f = f_store.read()
        csv_file = f"{out_dir}/report_f101_f.csv"
        with log.step(f"Copy table to csv (file_path = {csv_file})", "save_f101_f"):
            exchange.export_file(f, csv_file)
        copy_store = VersionedTable(spark, f"{work}/dm/dm_f101_round_f_v2", DM_F101_ROUND_F)
        with log.step(f"Copy data from csv to table (copy_from_csv = {csv_file})", "load_f101_f_copy"):
            copy_store.write(exchange.import_csv(spark, csv_file, DM_F101_ROUND_F))
        return turn_store.read(), f, csv_file, copy_store.read()

    def min_max_report() -> tuple[DataFrame, str]:
        mm = min_max.min_max_posting(ds.postings, ds.accounts, ds.rates, min_max_date)
        mm_csv = f"{out_dir}/report_min_max_{min_max_date.isoformat()}.csv"
        with log.step(f"Call min_max_posting and save result (save_to_file = {mm_csv})", "min_max_posting"):
            exchange.export_file(mm, mm_csv)
        return exchange.import_csv(spark, mm_csv, mm.schema), mm_csv

    out = side_by_side(spark, {"marts": marts, "min_max": min_max_report})
    turn, f, csv_file, copy = out["marts"]
    return RunOutput(log.run_id, turn, f, copy, out["min_max"][0], csv_file, out["min_max"][1])


def fill_f101(spark: SparkSession, ds: DetailLayer, turn: DataFrame, store: VersionedTable, on_date: dt.date, fanout: str) -> int:
    """Replace the month's rows of the form-101 mart; returns how many there are."""
    ms, me = py_month_bounds(on_date)
    seen = Observation(f"f101_{uuid.uuid4().hex[:8]}")
    new = f101_plan.f101(ds.ledger, ds.accounts, ds.currency, ds.balances, ds.rates, turn, on_date, fanout).observe(seen, F.count(F.lit(1)).alias("rows"))
    store.write(replace_where(store.read(), new, (F.col("from_date") == F.lit(ms)) & (F.col("to_date") == F.lit(me))))
    return int(seen.get["rows"])


def check_versions(log: runlog.RunLogger, ds: DetailLayer, refuse: bool) -> None:
    """Log how many conflicts the versions of accounts and rates have, by kind; overlaps are an error with ``refuse``."""
    for table, df, key in (("md_account_d", ds.accounts, "account_rk"), ("md_exchange_rate_d", ds.rates, "currency_rk")):
        with log.step(f"check versions of {table}", "check") as done:
            kinds = {r["kind"]: r["count"] for r in interval_conflicts(df, key, "data_actual_date", "data_actual_end_date").groupBy("kind").count().collect()}
            done["rows"] = sum(kinds.values())
            if refuse and kinds.get("overlap"):
                raise ValueError(f"{table}: {kinds['overlap']} days with more than one version of a key")


def refresh_marts(spark: SparkSession, ds_dir: str, work: str, on_date: dt.date, since: int, fanout: str = "faithful",
                  clock=dt.datetime.now) -> list[dt.date]:
    """Bring the marts of a month up to date with the postings stored after manifest ``since``; returns the days recomputed.

    The change feed of the posting table (days whose segments differ between two manifests) says which days' turnover to replace;
    form 101, small, is made anew from the stored turnover.  Equal to a full run if the other tables did not change.
    """
    ms, me = py_month_bounds(on_date)
    log = runlog.RunLogger(spark, f"{work.rstrip('/')}/logs/log_info", clock)
    postings = detail_table(spark, TABLES["ft_posting_f"], f"{ds_dir.rstrip('/')}/ft_posting_f")
    days = sorted(d for d in map(dt.date.fromisoformat, postings.changed_parts(since)) if ms <= d <= on_date)
    if not days:
        return []
    ds = stored_layer(spark, ds_dir, on_date, on_date)
    changed = postings.read([d.isoformat() for d in days])
    turn_store = PartitionedTable(spark, f"{work.rstrip('/')}/dm/dm_account_turnover_f", "on_date", DM_ACCOUNT_TURNOVER_F)
    with log.step(f"refresh turnover of {len(days)} days ({days[0].isoformat()} .. {days[-1].isoformat()})", "turnover") as done:
        done["rows"] = turn_store.replace_days(turnover.account_turnover(changed, ds.accounts, ds.rates, days[0], days[-1]), days)
    with log.step(f"fill_f101_round_f(i_OnDate => {on_date.isoformat()})", "f101") as done:
        store = VersionedTable(spark, f"{work.rstrip('/')}/dm/dm_f101_round_f", DM_F101_ROUND_F)
        done["rows"] = fill_f101(spark, ds, turn_store.read(ms, me), store, on_date, fanout)
    return days


def run_all_from_files(spark: SparkSession, files: dict[str, str], work: str, on_date: dt.date, min_max_date: dt.date,
                       fanout: str = "faithful", encoding: str = "cp866", bad_values: str = "fail",
                       clock=dt.datetime.now, resume: bool = False, conflicts: str = "ignore") -> RunOutput:
    """Load the six detail files (table name -> path) into ``<work>/ds``, each with its log rows, then ``run_all``."""
    work = work.rstrip("/")
    log = runlog.RunLogger(spark, f"{work}/logs/log_info", clock)
    unknown = sorted(set(files) ^ set(TABLES))
    if unknown:
        raise ValueError(f"one file for each of {sorted(TABLES)} is needed; differs in {unknown}")
    states = {name: fs.state(spark, path) for name, path in files.items()}

    def load(name: str) -> None:
        if resume and log.finished(f"load {name}", "load", states[name]):
            return
        with log.step(f"load {name}", "load", states[name]) as done:
            done["rows"] = load_table(spark, TABLES[name], files[name], f"{work}/ds/{name}", encoding, bad_values).rows_in_file

    side_by_side(spark, {name: lambda n=name: load(n) for name in TABLES})
    inputs = hashlib.sha256(json.dumps([states, on_date.isoformat()], sort_keys=True).encode()).hexdigest()
    return run_all(spark, stored_layer(spark, f"{work}/ds", on_date, min_max_date), work, on_date, min_max_date, fanout, clock, log, inputs, resume, conflicts)


def stored_layer(spark: SparkSession, ds_dir: str, on_date: dt.date, min_max_date: dt.date) -> DetailLayer:
    """The detail layer that ``load_table`` stored below ``ds_dir``; of the facts only the days the run reads."""
    first, _ = py_month_bounds(on_date)
    month = [first + dt.timedelta(days=i) for i in range((on_date - first).days + 1)]
    days = {"ft_posting_f": [*month, min_max_date], "ft_balance_f": [py_prev_month_end(on_date)]}

    def of(name: str) -> DataFrame:
        parts = [d.isoformat() for d in days[name]] if name in days else None
        return detail_table(spark, TABLES[name], f"{ds_dir.rstrip('/')}/{name}").read(parts)

    return DetailLayer(of("md_ledger_account_s"), of("md_account_d"), of("md_currency_d"), of("ft_balance_f"),
                       of("md_exchange_rate_d"), of("ft_posting_f"))
