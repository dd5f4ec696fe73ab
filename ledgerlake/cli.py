"""Command line for spark-submit: the jobs users of the reference start by hand.

    spark-submit ledgerlake/cli.py mirror TABLE DELTAS LOGS MIRROR KEY [KEY ...] [--seed-parquet P]
    spark-submit ledgerlake/cli.py load TABLE FILE STORE [--encoding cp866] [--bad-values fail|null|reject]
    spark-submit ledgerlake/cli.py run-all DS_DIR WORK --date YYYY-MM-DD --min-max-date YYYY-MM-DD
    spark-submit ledgerlake/cli.py run-files FILES_DIR WORK --date YYYY-MM-DD --min-max-date YYYY-MM-DD

``run-all`` reads the six detail tables from ``DS_DIR/<table>`` (written by
``load``); ``run-files`` first loads ``FILES_DIR/<table>.csv``.  ``mirror`` can
seed from parquet or over JDBC (``--seed-jdbc URL TABLE``; user and password
come from the environment) and export the mirror as CSV.  The session comes
from spark-submit; nothing here sets cluster options.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

if __name__ == "__main__" and not __package__:          # started as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("mirror", help="apply pending delta sessions to a mirror, once each")
    m.add_argument("table")
    m.add_argument("deltas")
    m.add_argument("logs")
    m.add_argument("mirror")
    m.add_argument("keys", nargs="+")
    m.add_argument("--seed-parquet", help="seed the mirror from this parquet path on the first run")
    m.add_argument("--seed-jdbc", nargs=2, metavar=("URL", "TABLE"), help="seed from a database table (JDBC_USER, JDBC_PASSWORD)")
    m.add_argument("--export-to", help="also write the mirror as CSV below this folder")
    m.add_argument("--positional", action="store_true", help="delta columns by position, not by name")
    m.add_argument("--layout", default="numbered", choices=["numbered", "partitioned"])
    m.add_argument("--mode", default="faithful", choices=["faithful", "latest"])
    m.add_argument("--keep-versions", type=int, default=None, help="prune older mirror versions, keeping this many")
    ld = sub.add_parser("load", help="upsert a delimited detail file into its table")
    ld.add_argument("table")
    ld.add_argument("file")
    ld.add_argument("store")
    ld.add_argument("--encoding", default="cp866")
    ld.add_argument("--bad-values", default="fail", choices=["fail", "null", "reject"])
    for name, source in (("run-all", "ds_dir"), ("run-files", "files_dir")):
        ra = sub.add_parser(name, help="turnover -> form 101 -> export/import, plus the min/max report")
        ra.add_argument(source)
        ra.add_argument("work")
        ra.add_argument("--date", required=True, type=dt.date.fromisoformat)
        ra.add_argument("--min-max-date", required=True, type=dt.date.fromisoformat)
        ra.add_argument("--fanout", default="faithful", choices=["faithful", "corrected"])
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"ledgerlake-{args.cmd}").getOrCreate()
    if args.cmd == "mirror":
        from ledgerlake.plans.mirror import delta_loading
        seed = spark.read.parquet(args.seed_parquet) if args.seed_parquet else None
        if args.seed_jdbc:
            from ledgerlake.sources.deltas import read_jdbc
            seed = read_jdbc(spark, url=args.seed_jdbc[0], table=args.seed_jdbc[1], user=os.environ.get("JDBC_USER"),
                             password=os.environ.get("JDBC_PASSWORD"))
        res = delta_loading(spark, args.table, args.keys, args.deltas, args.logs, args.mirror, seed=seed,
                            layout=args.layout, mode=args.mode, keep_versions=args.keep_versions,
                            positional=args.positional, export_to=args.export_to)
        return {"applied": res.applied, "pending_without_file": res.pending_without_file, "version": res.version}
    if args.cmd == "load":
        from ledgerlake.plans.loader import load_table
        from ledgerlake.schemas import TABLES
        out = load_table(spark, TABLES[args.table.lower().split(".")[-1]], args.file, args.store,
                         encoding=args.encoding, bad_values=args.bad_values)
        return {"table": out.table, "rows_in_file": out.rows_in_file, "rows_rejected": out.rows_rejected,
                "version": out.version}
    from ledgerlake.plans.daily_run import run_all, run_all_from_files, stored_layer
    from ledgerlake.schemas import TABLES
    if args.cmd == "run-files":
        files = {name: f"{args.files_dir.rstrip('/')}/{name}.csv" for name in TABLES}
        out = run_all_from_files(spark, files, args.work, args.date, args.min_max_date, args.fanout)
    else:
        out = run_all(spark, stored_layer(spark, args.ds_dir, args.date, args.min_max_date), args.work, args.date, args.min_max_date, args.fanout)
    return {"run_id": out.run_id, "f101_csv": out.f101_csv, "min_max_csv": out.min_max_csv}


if __name__ == "__main__":
    print(main(sys.argv[1:]))
