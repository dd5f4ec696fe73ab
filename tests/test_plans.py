"""Jobs on small hand-made inputs: turnover and f101 quirks, loader, mirror job, logs, exchange."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerlake.plans import exchange, f101 as f101_plan, mirror, runlog, turnover
from ledgerlake.plans.loader import load_table
from ledgerlake.schemas import DM_F101_ROUND_F, LOG_INFO, TABLES
from ledgerlake.sinks.parts import PartsTable
from ledgerlake.sinks.store import AppendLog, VersionedTable
from ledgerlake.sources import deltas as D
from ledgerlake.sources.bank_views import BankTables

D8 = dt.date
SF = "/root/testdata/sf0.001"


def _local(path):
    return path.replace("file:", "", 1)


# ------------------------------------------------------------------ turnover
def small_bank(spark):
    accounts = spark.createDataFrame([
        (D8(2018, 1, 1), D8(2018, 1, 31), 1, "30101810000000000001", "A", 10, "840"),
        (D8(2017, 6, 1), D8(2018, 12, 31), 2, "30102810000000000002", "A", 10, "840"),   # opened before the month
        (D8(2018, 1, 1), D8(2018, 1, 31), 3, "40702810000000000003", "P", 20, "978"),    # no rate -> 1
    ], "data_actual_date date, data_actual_end_date date, account_rk long, account_number string, "
       "char_type string, currency_rk long, currency_code string")
    rates = spark.createDataFrame([(D8(2018, 1, 1), D8(2018, 1, 31), 10, 2.0)],
                                  "data_actual_date date, data_actual_end_date date, currency_rk long, reduced_cource double")
    postings = spark.createDataFrame([
        (D8(2018, 1, 5), 1, 3, 100.0, 100.0), (D8(2018, 1, 5), 2, 3, 50.0, 50.0), (D8(2018, 1, 6), 3, 1, 7.0, 8.0)],
        "oper_date date, credit_account_rk long, debet_account_rk long, credit_amount double, debet_amount double")
    return accounts, rates, postings


def test_turnover_month_semantics(spark):
    accounts, rates, postings = small_bank(spark)
    out = {(r.on_date.day, r.account_rk): (float(r.credit_amount), float(r.credit_amount_rub),
                                           float(r.debet_amount), float(r.debet_amount_rub))
           for r in turnover.month_turnover(postings, accounts, rates, D8(2018, 1, 31)).collect()}
    assert out == {(5, 1): (100.0, 200.0, 0.0, 0.0),          # rate 2
                   (5, 3): (0.0, 0.0, 150.0, 150.0),          # no rate -> 1; account 2's leg is dropped (Q2)
                   (6, 3): (7.0, 7.0, 0.0, 0.0),
                   (6, 1): (0.0, 0.0, 8.0, 16.0)}


def test_turnover_day_by_day_equals_month_at_once(spark):
    b = BankTables(spark, SF)
    p, a, r = b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d()
    month = turnover.month_turnover(p, a, r, D8(1998, 1, 31))
    days = None
    for d in range(1, 32):
        one = turnover.account_turnover(p, a, r, D8(1998, 1, d))
        days = one if days is None else days.unionByName(one)
    assert sorted(month.collect()) == sorted(days.collect())


def test_f101_faithful_equals_corrected_when_no_account_has_two_turnover_days(spark):
    b = BankTables(spark, SF)
    t = turnover.month_turnover(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), D8(1998, 1, 31))
    one_day = t.groupBy("account_rk").count().filter("count = 1").select("account_rk")
    t1 = t.join(one_day, "account_rk")
    args = (b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(), b.md_exchange_rate_d(), t1,
            D8(1998, 1, 31))
    assert sorted(f101_plan.f101(*args, "faithful").collect()) == sorted(f101_plan.f101(*args, "corrected").collect())


# ------------------------------------------------------------------ loader
def test_loader_cp866_quotes_header_case_and_upsert(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    spec = TABLES["md_currency_d"]
    f1 = f"{_local(workdir)}/md_currency_d.csv"
    with open(f1, "w", encoding="cp866", newline="") as fh:
        fh.write("   ;CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR\n")
        fh.write('1;34;2018-01-01;2050-12-31;643;"R;B"\n')
        fh.write("2;35;2018-01-01;;840;USD\n")
        fh.write('3;34;2018-01-01;2050-12-31;810;"руб"\n')          # same key, later in the file: wins
    store = f"{workdir}/ds/md_currency_d"
    out = load_table(spark, spec, f1, store)
    assert out.rows_in_file == 3
    got = {r.currency_rk: r for r in PartsTable(spark, store, spec.schema).read().collect()}
    assert got[34].currency_code == "810" and got[34].code_iso_char == "руб"
    assert got[35].data_actual_end_date is None
    # a second file without CODE_ISO_CHAR: the column keeps its old value
    f2 = f"{_local(workdir)}/md_currency_d_2.csv"
    with open(f2, "w", encoding="cp866", newline="") as fh:
        fh.write("\t;currency_rk;data_actual_date;currency_code\n")
        fh.write("1;35;2018-01-01;999\n")
    load_table(spark, spec, f2, store)
    got = {r.currency_rk: r for r in PartsTable(spark, store, spec.schema).read().collect()}
    assert (got[35].currency_code, got[35].code_iso_char) == ("999", "USD")
    assert got[35].data_actual_end_date is None and got[34].code_iso_char == "руб"


def test_loader_date_pattern_on_first_column(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    f = f"{_local(workdir)}/ft_balance_f.csv"
    with open(f, "w", encoding="cp866") as fh:
        fh.write("\t;ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n1;31.12.2017;36237725;35;38318.13\n")
    store = f"{workdir}/ds/ft_balance_f"
    load_table(spark, TABLES["ft_balance_f"], f, store)
    r = PartsTable(spark, store).read().first()
    assert (r.on_date, r.account_rk, r.currency_rk, r.balance_out) == (D8(2017, 12, 31), 36237725, 35, 38318.13)


# ------------------------------------------------------------------ mirror job (reference folder layout)
def test_delta_loading_numbered_layout_missing_file_and_second_run(spark, workdir):
    base = f"{_local(workdir)}/deltas"
    files = {"999": None, "1000": "md_account_d.csv", "1001": "md_account_d_1.csv", "1002": None,
             "10000": "md_account_d_9000.csv"}
    rows_by = {"1000": [(1, "a"), (2, "b")], "1001": [(2, "b1"), (2, "b2")], "10000": [(3, "c")]}
    for d, name in files.items():
        os.makedirs(f"{base}/{d}")
        if name:
            with open(f"{base}/{d}/{name}", "w") as fh:
                fh.write("account_rk;v\n" + "".join(f"{k};{v}\n" for k, v in rows_by[d]))
    sessions = D.discover(spark, base, "md_account_d")
    assert [s.delta_id for s in sessions] == [999, 1000, 1001, 1002, 10000]
    seed = spark.createDataFrame([(1, "s1"), (4, "s4")], "account_rk int, v string")
    kw = dict(table="md_account_d", keys=["account_rk"], deltas_base=base, log_path=f"{workdir}/log",
              mirror_path=f"{workdir}/mirror")
    first = mirror.delta_loading(spark, seed=seed, **kw)
    assert first.applied == [1000, 1001, 10000] and first.pending_without_file == [999, 1002]
    assert sorted(tuple(r) for r in first.mirror.collect()) == [(1, "a"), (2, "b1"), (2, "b2"), (3, "c"), (4, "s4")]
    second = mirror.delta_loading(spark, **kw)
    assert second.applied == [] and second.version == first.version
    log = AppendLog(spark, f"{workdir}/log", mirror.DELTA_LOG).read()
    assert sorted(r.delta_id for r in log.collect()) == [1000, 1001, 10000]


def test_versioned_table_reads_old_version_while_writing_next(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t")
    t.write(spark.range(3))
    cur = t.read()
    t.write(cur.withColumn("id", F.col("id") + 10))       # reads v1, writes v2 (no self-overwrite)
    assert t.versions() == [1, 2]
    assert sorted(r.id for r in t.read().collect()) == [10, 11, 12]


# ------------------------------------------------------------------ run log, exchange
def test_write_log_splits_long_messages_and_next_run_id(spark, workdir):
    path = f"{workdir}/log_info"
    clock = lambda: dt.datetime(2024, 1, 1, 12, 0, 0)
    runlog.write_log(spark, path, "y" * 9001, 7, "test", 5, clock=clock)
    runlog.write_log(spark, path, "", 7, "test", clock=clock)
    runlog.write_log(spark, path, None, 7, "test", clock=clock)
    log = AppendLog(spark, path, LOG_INFO).read()
    assert sorted(len(r.message_) for r in log.collect()) == [1001, 4000, 4000]
    assert {r.message_type for r in log.collect()} == {1}
    assert runlog.next_run_id(log) == 8


def test_export_import_is_identity(spark, workdir):
    b = BankTables(spark, SF)
    t = turnover.month_turnover(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), D8(1998, 1, 31))
    f = f101_plan.f101(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                       b.md_exchange_rate_d(), t, D8(1998, 1, 31))
    path = exchange.export_csv(f, f"{workdir}/report_f101_f.csv")
    back = exchange.import_csv(spark, path, DM_F101_ROUND_F)
    assert sorted(f.collect()) == sorted(back.collect())
    parts = [n for n in os.listdir(_local(path)) if n.startswith("part-")]
    assert len(parts) == 1


def test_jdbc_options_take_credentials_from_arguments():
    o = D.jdbc_options("jdbc:postgresql://db:5432/bank", "ds.md_account_d", user="u", password="p",
                       partition_column="account_rk", lower=0, upper=1000, num_partitions=8)
    assert o["dbtable"] == "ds.md_account_d" and o["numPartitions"] == "8" and o["password"] == "p"


def test_partitioned_range_replace_removes_stale_days_and_keeps_others(spark, workdir):
    from ledgerlake.sinks.store import PartitionedTable
    schema = "on_date date, account_rk long, v int"
    t = PartitionedTable(spark, f"{workdir}/turn", "on_date")
    first = spark.createDataFrame([(D8(2018, 1, d), 1, d) for d in (1, 2, 3, 4)], schema)
    t.replace_range(first, D8(2018, 1, 1), D8(2018, 1, 31))
    rerun = spark.createDataFrame([(D8(2018, 1, 2), 1, 20)], schema)      # day 3 gets no new rows
    t.replace_range(rerun, D8(2018, 1, 2), D8(2018, 1, 3))
    got = sorted((r.on_date.day, r.v) for r in t.read().collect())
    assert got == [(1, 1), (2, 20), (4, 4)]


def test_versioned_table_skips_a_half_written_version(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t2")
    t.write(spark.range(2))
    os.makedirs(_local(t.path(2)))                       # a crashed writer left v=2 without _SUCCESS
    assert t.versions() == [1] and t.read().count() == 2
    assert t.write(spark.range(5)) == 3
    assert t.versions() == [1, 3] and t.read().count() == 5


def test_mirror_stream_late_older_delta_does_not_override_newer(spark, workdir):
    from ledgerlake.streaming import delta_stream
    base = _local(f"{workdir}/stream-deltas")
    schema = spark.createDataFrame([], "k int, v string").schema

    def put(delta_id, lines):
        os.makedirs(f"{base}/delta_id={delta_id}")
        with open(f"{base}/delta_id={delta_id}/part-0.csv", "w") as fh:
            fh.write("k;v\n" + "".join(f"{k};{v}\n" for k, v in lines))

    mpath, ck = f"{workdir}/stream-mirror", f"{workdir}/stream-ckpt"
    delta_stream.seed_mirror(spark, spark.createDataFrame([(1, "s1"), (2, "s2")], "k int, v string"), mpath, ["k"])
    put(1001, [(1, "new")])
    delta_stream.start_mirror_stream(spark, base, schema, ["k"], mpath, ck).awaitTermination()
    put(1000, [(1, "old"), (2, "old2")])                   # an older session arrives later
    delta_stream.start_mirror_stream(spark, base, schema, ["k"], mpath, ck).awaitTermination()
    got = sorted(tuple(r) for r in delta_stream.read_mirror(spark, mpath).collect())
    assert got == [(1, "new"), (2, "old2")]


def test_versioned_table_new_version_may_change_types(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t3")
    t.write(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.write(spark.createDataFrame([(1, "a", 2.5)], "k long, v string, amount double"))   # W15: new types
    assert t.read().schema.simpleString() == "struct<k:bigint,v:string,amount:double>"


def test_turnover_with_one_account_holding_a_third_of_the_postings_matches_brute_force(spark):
    import random
    from decimal import Decimal
    rnd = random.Random(11)
    days = [D8(2018, 1, d) for d in (3, 4, 5)]
    accounts = [(D8(2018, 1, 1), D8(2018, 1, 31), rk, f"{40000 + rk:05d}{rk:015d}", "P", rk % 3, "840")
                for rk in range(1, 41)]
    rates = [(d, d, 1, Decimal("2.5000")) for d in days]            # currency 1 has a rate, 0 and 2 do not
    postings = []
    for i in range(3000):
        hot = i % 3 == 0                                            # account 7 takes a third of all postings
        cr = 7 if hot else rnd.randint(1, 40)
        db = rnd.randint(1, 45)                                     # 41-45: no account -> leg dropped
        amt = Decimal(rnd.randint(1, 100000)) / 100
        postings.append((rnd.choice(days), cr, db, amt, amt + 1))
    a_df = spark.createDataFrame(accounts, "data_actual_date date, data_actual_end_date date, account_rk long, "
                                 "account_number string, char_type string, currency_rk long, currency_code string")
    r_df = spark.createDataFrame(rates, "data_actual_date date, data_actual_end_date date, currency_rk long, "
                                 "reduced_cource decimal(10,4)")
    p_df = spark.createDataFrame(postings, "oper_date date, credit_account_rk long, debet_account_rk long, "
                                 "credit_amount decimal(12,2), debet_amount decimal(13,2)")
    got = {(r.on_date, r.account_rk): (r.credit_amount, r.credit_amount_rub, r.debet_amount, r.debet_amount_rub)
           for r in turnover.month_turnover(p_df, a_df, r_df, D8(2018, 1, 31)).collect()}
    cur = {rk: c for _, _, rk, _, _, c, _ in accounts}
    want = {}
    for d, cr, db, ca, da in postings:
        for rk, c, dd in ((cr, ca, None), (db, None, da)):
            if rk not in cur:
                continue
            rate = Decimal("2.5") if cur[rk] == 1 else Decimal(1)
            w = want.setdefault((d, rk), [Decimal(0)] * 4)
            if c is not None:
                w[0] += c
                w[1] += c * rate
            if dd is not None:
                w[2] += dd
                w[3] += dd * rate
    assert got == {k: tuple(v) for k, v in want.items()}


def test_run_all_twice_in_the_same_folder_is_idempotent(spark, workdir):
    from ledgerlake.plans import daily_run
    b = BankTables(spark, SF)
    ds = daily_run.DetailLayer(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                              b.md_exchange_rate_d(), b.ft_posting_f())
    first = daily_run.run_all(spark, ds, f"{workdir}/run", D8(1998, 1, 31), D8(1998, 1, 20))
    t1, f1 = sorted(first.turnover.collect()), sorted(first.f101.collect())
    second = daily_run.run_all(spark, ds, f"{workdir}/run", D8(1998, 1, 31), D8(1998, 1, 20))
    assert (first.run_id, second.run_id) == (1, 2)
    assert sorted(second.turnover.collect()) == t1
    assert sorted(second.f101.collect()) == f1 and sorted(second.f101_copy.collect()) == f1
    log = AppendLog(spark, f"{workdir}/run/logs/log_info", LOG_INFO).read()
    assert {r.pipeline_run_id for r in log.collect()} == {1, 2}


def test_loader_rejects_rows_with_bad_values_and_loads_the_rest(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    f = f"{_local(workdir)}/md_exchange_rate_d.csv"
    with open(f, "w", encoding="cp866") as fh:
        fh.write("\t;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;CODE_ISO_NUM\n")
        fh.write("1;2018-01-01;2018-01-31;30;12.5;643\n")
        fh.write("2;2018-01-01;2018-01-31;31;12,5x;840\n")       # bad rate
        fh.write("3;2018-13-01;2018-01-31;32;1.0;978\n")          # bad date
        fh.write("4;2018-01-01;;33;;\n")                           # empty fields are NULL, not bad
    store = f"{workdir}/ds/md_exchange_rate_d"
    out = load_table(spark, TABLES["md_exchange_rate_d"], f, store, bad_values="reject")
    assert (out.rows_in_file, out.rows_rejected) == (4, 2)
    assert sorted(r.currency_rk for r in PartsTable(spark, store).read().collect()) == [30, 33]
    rej = sorted((r.bad_columns, r.row_text) for r in spark.read.parquet(f"{store}_rejects").collect())
    assert [b for b, _ in rej] == [["data_actual_date"], ["reduced_cource"]]
    assert '"reduced_cource":"12,5x"' in rej[1][1]


def test_versioned_table_prune_keeps_the_newest_versions(spark, workdir):
    t = VersionedTable(spark, f"{workdir}/t4")
    for n in range(4):
        t.write(spark.range(n + 1))
    os.makedirs(_local(t.path(5)))                       # a dead, uncommitted folder above them
    assert t.current() == 4
    assert t.prune(keep=2) == [1, 2]
    assert t.versions() == [3, 4] and t.read().count() == 4
