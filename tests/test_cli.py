"""The spark-submit entry points, run in-process."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ledgerlake import cli
from ledgerlake.plans.loader import part_of
from ledgerlake.schemas import TABLES
from ledgerlake.sinks.parts import PartsTable
from ledgerlake.sources.bank_views import BankTables

SF = "/root/testdata/sf0.001"


def _local(p):
    return p.replace("file:", "", 1)


def test_cli_load_and_mirror(spark, workdir):
    os.makedirs(_local(workdir), exist_ok=True)
    f = f"{_local(workdir)}/md_currency_d.csv"
    with open(f, "w", encoding="cp866") as fh:
        fh.write("\t;CURRENCY_RK;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_CODE;CODE_ISO_CHAR\n1;34;2018-01-01;;643;RUB\n")
    out = cli.main(["load", "DS.MD_CURRENCY_D", f, f"{workdir}/ds/md_currency_d"], spark)
    assert out["rows_in_file"] == 1 and out["version"] == 1

    base = f"{_local(workdir)}/deltas"
    os.makedirs(f"{base}/1000")
    with open(f"{base}/1000/md_account_d.csv", "w") as fh:
        fh.write("account_rk;v\n1;a\n")
    seed = f"{workdir}/seed.parquet"
    spark.createDataFrame([(1, "s"), (2, "t")], "account_rk int, v string").write.parquet(seed)
    args = ["mirror", "md_account_d", base, f"{workdir}/logs", f"{workdir}/mirror", "account_rk", "--seed-parquet", seed]
    assert cli.main(args, spark)["applied"] == [1000]
    assert cli.main(args, spark)["applied"] == []


def test_cli_run_all_from_stored_detail_tables(spark, workdir):
    b = BankTables(spark, SF)
    views = {"md_ledger_account_s": b.md_ledger_account_s(), "md_account_d": b.md_account_d(),
             "md_currency_d": b.md_currency_d(), "ft_balance_f": b.ft_balance_f(),
             "md_exchange_rate_d": b.md_exchange_rate_d(), "ft_posting_f": b.ft_posting_f()}
    for name, df in views.items():                       # what `load` leaves: the declared schema
        schema = TABLES[name].schema
        cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields]
        PartsTable(spark, f"{workdir}/ds/{name}", schema).replace(df.select(*cols), part_of(TABLES[name]))
    out = cli.main(["run-all", f"{workdir}/ds", f"{workdir}/work", "--date", "1998-01-31",
                    "--min-max-date", "1998-01-20"], spark)
    assert out["run_id"] == 1
    assert spark.read.option("header", True).option("sep", ";").csv(out["f101_csv"]).count() > 0
    assert out["min_max_csv"].split("/")[-1].startswith(f"report_min_max_{dt.date(1998, 1, 20).isoformat()}")
