"""Registered queries, part 2: writes, mirror, loaders, logs, counts and scalars.

Queries that write do so below the session's shared work folder
(``spark.checkpoint.dir``), each in a fresh folder, and return what they
read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake import oracle as O
from ledgerlake.functions import calendar as cal
from ledgerlake.functions.scalars import fm_digits
from ledgerlake.operators.chunks import split_chunks
from ledgerlake.operators.upsert import duplicate_keys, replace_where, upsert
from ledgerlake.plans import counts, daily_run, exchange, f101 as f101_plan, mirror, runlog, turnover
from ledgerlake.plans.loader import detail_table, load_table
from ledgerlake.queries import MONTH_START, REPORT_DATE, _f101, _turnover_month, bank, register
from ledgerlake.schemas import DELTA_LOG, DM_ACCOUNT_TURNOVER_F, DM_F101_ROUND_F, LOG_INFO, TABLES
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.store import AppendLog, PartitionedTable, VersionedTable
from ledgerlake.sources import deltas as D
from ledgerlake.sources.csv_files import read_delta_csv, read_plain_csv
from ledgerlake.sources.local import rows_frame
from ledgerlake.streaming import delta_stream

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DUCK_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def _ts(c: str) -> str:
    return DUCK_TS.format(c=c)


# ---------------------------------------------------------------- 5. writes
LI_PK = ["l_orderkey", "l_linenumber"]
LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_linestatus", "l_shipdate"]
B2_COLS = ["l_quantity", "l_extendedprice", "l_shipdate"]
CUT = dt.datetime(1996, 1, 1)


@register("upsert_last_wins", f"""
WITH b1 AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01'
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                    ORDER BY {", ".join(c + " DESC NULLS LAST" for c in LI_REST)}) = 1),
b2 AS (SELECT l_orderkey, l_linenumber, {", ".join(B2_COLS)} FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY {", ".join(c + " DESC NULLS LAST" for c in B2_COLS)}) = 1),
state AS (
  SELECT b1.l_orderkey, b1.l_linenumber, b1.l_partkey, b1.l_suppkey, b1.l_quantity, b1.l_extendedprice,
         b1.l_discount, b1.l_tax, b1.l_returnflag, b1.l_linestatus, b1.l_shipdate
  FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.l_orderkey = b1.l_orderkey
                                         AND b2.l_linenumber = b1.l_linenumber)
  UNION ALL
  SELECT b2.l_orderkey, b2.l_linenumber, b1.l_partkey, b1.l_suppkey, b2.l_quantity, b2.l_extendedprice,
         b1.l_discount, b1.l_tax, b1.l_returnflag, b1.l_linestatus, b2.l_shipdate
  FROM b2 LEFT JOIN b1 ON b1.l_orderkey = b2.l_orderkey AND b1.l_linenumber = b2.l_linenumber)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, {_ts("l_shipdate")} AS l_shipdate FROM state""")
def upsert_last_wins(spark, sf_dir):
    """Two batches of line items upserted on (orderkey, linenumber); the second batch lacks most
    columns, which keep their old values; inside a batch the last row in file order wins."""
    li = bank(spark, sf_dir).raw("lineitem")
    store = VersionedTable(spark, fresh_dir(spark, "upsert"), li.schema)
    b1 = li.filter(F.col("l_shipdate") < cal.ntz(CUT))
    b2 = li.filter(F.col("l_shipdate") >= cal.ntz(CUT)).select(*LI_PK, *B2_COLS)
    store.write(upsert(store.read(), b1, LI_PK, LI_REST))
    store.write(upsert(store.read(), b2, LI_PK, B2_COLS))
    return store.read()


FINAL_POSTINGS = """ft_posting_final AS (
  SELECT CAST(l_shipdate AS DATE) AS oper_date, CAST(l_suppkey AS BIGINT) AS credit_account_rk,
         CAST(1000000 + o_custkey AS BIGINT) AS debet_account_rk,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS credit_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_linenumber AS DECIMAL(12,2)) AS debet_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')"""
D10, D20 = dt.date(1998, 1, 10), dt.date(1998, 1, 20)


@register("replace_day_range", O.with_prelude(
    FINAL_POSTINGS, O.turnover_of("1998-01-01", "1998-01-31", "turn_first", "ft_posting_final"),
    O.turnover_of("1998-01-10", "1998-01-20", "turn_rerun"), body=O.TURN_OUT + """ FROM (
  SELECT * FROM turn_first WHERE on_date NOT BETWEEN DATE '1998-01-10' AND DATE '1998-01-20'
  UNION ALL SELECT * FROM turn_rerun) t"""))
def replace_day_range(spark, sf_dir):
    """The month loaded from finished orders only, then days 10-20 recomputed from all postings
    replace exactly those days (a day without new rows would end empty)."""
    b = bank(spark, sf_dir)
    acc, rates = b.md_account_d(), b.md_exchange_rate_d()
    store = PartitionedTable(spark, fresh_dir(spark, "turnover"), "on_date", DM_ACCOUNT_TURNOVER_F)
    store.replace_range(turnover.month_turnover(b.ft_posting_f("F"), acc, rates, REPORT_DATE), MONTH_START,
                        REPORT_DATE)
    store.replace_range(turnover.account_turnover(b.ft_posting_f(), acc, rates, D10, D20), D10, D20)
    return store.read()


DEC_DATE = dt.date(1997, 12, 31)


@register("replace_month", O.with_prelude(
    O.turnover_of("1997-12-01", "1997-12-31", "turn_dec"), O.form101("1997-12-31", True, "turn_dec", "f_dec"),
    O.turnover_of("1998-01-01", "1998-01-31"), O.form101("1998-01-31"),
    body=O.f101_out("f_dec") + "\nUNION ALL\n" + O.f101_out("f101")))
def replace_month(spark, sf_dir):
    """A mart holding December and a first (corrected) January; January is replaced by the
    faithful run, December stays."""
    b = bank(spark, sf_dir)
    acc, rates = b.md_account_d(), b.md_exchange_rate_d()

    def month(d, fanout):
        t = turnover.month_turnover(b.ft_posting_f(), acc, rates, d)
        return f101_plan.f101(b.md_ledger_account_s(), acc, b.md_currency_d(), b.ft_balance_f(), rates, t, d,
                              fanout)

    store = VersionedTable(spark, fresh_dir(spark, "f101"), DM_F101_ROUND_F)
    store.write(month(DEC_DATE, "faithful").unionByName(month(REPORT_DATE, "corrected")))
    ms, me = cal.py_month_bounds(REPORT_DATE)
    jan = (F.col("from_date") == F.lit(ms)) & (F.col("to_date") == F.lit(me))
    store.write(replace_where(store.read(), month(REPORT_DATE, "faithful"), jan))
    return store.read()


@register("row_count_observed", O.with_prelude(O.turnover_of("1998-01-01", "1998-01-31"), body="""
SELECT 'dm_account_turnover_f' AS table_name, count(*) AS rows_affected FROM turnover"""))
def row_count_observed(spark, sf_dir):
    """Rows written, observed on the write itself (no second count job)."""
    obs = Observation("turnover_rows")
    df = _turnover_month(bank(spark, sf_dir)).observe(obs, F.count(F.lit(1)).alias("rows"))
    VersionedTable(spark, fresh_dir(spark, "turnover")).write(df)
    return rows_frame(spark, [("dm_account_turnover_f", int(obs.get["rows"]))],
                                 "table_name string, rows_affected bigint")


# ---------------------------------------------------------------- 6. mirror
SEED_END = dt.datetime(2024, 1, 6)
EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_split(spark, sf_dir):
    ev = bank(spark, sf_dir).raw("events")
    seed = ev.filter(F.col("ts") < cal.ntz(SEED_END))
    deltas = ev.filter(F.col("ts") >= cal.ntz(SEED_END)).withColumn(
        "delta_id", (F.lit(1000) + F.dayofmonth("ts") - 1).cast("int"))
    return seed, deltas


MIRROR_TAGGED = """tagged AS (
  SELECT *, -1 AS d FROM events WHERE ts < TIMESTAMP '2024-01-06'
  UNION ALL SELECT *, 1000 + day(ts) - 1 FROM events WHERE ts >= TIMESTAMP '2024-01-06')"""
MIRROR_FAITHFUL_SQL = f"""WITH {MIRROR_TAGGED}
SELECT event_id, {_ts("ts")} AS ts, user_id, event_type, value, props
FROM (SELECT *, max(d) OVER (PARTITION BY user_id) AS newest FROM tagged) WHERE d = newest"""


@register("mirror_faithful", MIRROR_FAITHFUL_SQL)
def mirror_faithful(spark, sf_dir):
    """Events of days 1-5 seed the mirror, each later day is one delta session; per user the
    rows of the newest session survive, all of them."""
    seed, deltas = _events_split(spark, sf_dir)
    return mirror.apply_deltas(seed, deltas, ["user_id"], "faithful")


@register("mirror_latest", f"""WITH {MIRROR_TAGGED}
SELECT event_id, {_ts("ts")} AS ts, user_id, event_type, value, props FROM tagged
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY d DESC, ts DESC, event_id DESC) = 1""")
def mirror_latest(spark, sf_dir):
    """X1 corrected: one row per user, the last of the newest session."""
    seed, deltas = _events_split(spark, sf_dir)
    return mirror.apply_deltas(seed, deltas, ["user_id"], "latest", order=["ts", "event_id"])


@register("add_columns", f"""WITH tagged AS (
  SELECT event_id, ts, user_id, event_type, NULL::DOUBLE AS value, NULL::VARCHAR AS props, -1 AS d
  FROM events WHERE ts < TIMESTAMP '2024-01-06'
  UNION ALL SELECT *, 1000 + day(ts) - 1 FROM events WHERE ts >= TIMESTAMP '2024-01-06')
SELECT event_id, {_ts("ts")} AS ts, user_id, event_type, value, props
FROM (SELECT *, max(d) OVER (PARTITION BY user_id) AS newest FROM tagged) WHERE d = newest""")
def add_columns(spark, sf_dir):
    """The seed mirror predates two columns; deltas carry them; old rows read NULL."""
    seed, deltas = _events_split(spark, sf_dir)
    return mirror.apply_deltas(seed.drop("value", "props"), deltas, ["user_id"], "faithful").select(*EV_COLS)


@register("mirror_positional", MIRROR_FAITHFUL_SQL)
def mirror_positional(spark, sf_dir):
    """Delta files whose header spells the columns differently (upper case); the reference's
    positional union maps them onto the mirror's columns by position."""
    seed, deltas = _events_split(spark, sf_dir)
    renamed = deltas.select(*[F.col(c).alias(c.upper()) for c in EV_COLS], "delta_id")
    return mirror.apply_deltas(seed, renamed, ["user_id"], "faithful", positional=True)


def _write_deltas(spark, deltas, base, mode="errorifexists"):
    (deltas.write.mode(mode).partitionBy("delta_id").option("header", True).option("sep", ";").option("escape", '"')
     .option("timestampFormat", TS_FMT).option("timestampNTZFormat", TS_FMT).csv(base))


@register("mirror_pending", """
SELECT DISTINCT CAST(1000 + day(ts) - 1 AS INTEGER) AS delta_id FROM events
WHERE ts >= TIMESTAMP '2024-01-16'""")
def mirror_pending(spark, sf_dir):
    """S13 + P14: delta folders discovered on storage minus the sessions the log lists for this table
    (the log already has days 6-15 for 'events' and days 16-18 for another table)."""
    _, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas, base)
    log = AppendLog(spark, fresh_dir(spark, "delta_log"), DELTA_LOG)
    ids = deltas.select("delta_id").distinct()
    logged = (ids.filter(F.col("delta_id") <= 1014).withColumn("table_name", F.lit("events"))
              .unionByName(ids.filter(F.col("delta_id").between(1015, 1017)).withColumn("table_name",
                                                                                        F.lit("orders"))))
    log.append(logged.select(F.lit(None).cast("timestamp").alias("started_at"),
                             F.lit(None).cast("timestamp").alias("finished_at"), "delta_id", "table_name"))
    sessions = D.sessions_frame(spark, D.discover(spark, base, "events", layout="partitioned"))
    return mirror.pending_ids(log.read(), sessions, "events").select("delta_id")


@register("mirror_idempotent", MIRROR_FAITHFUL_SQL)
def mirror_idempotent(spark, sf_dir):
    """L8 end to end, twice: seed, discover the delta folders, apply all pending sessions in one pass,
    log them; the second run finds nothing pending and leaves the mirror as it is."""
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas, base)
    mpath, lpath = fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log")
    opts = {"timestamp_format": TS_FMT}
    first = mirror.delta_loading(spark, "events", ["user_id"], base, lpath, mpath, seed=seed, layout="partitioned",
                                 read_options=opts)
    second = mirror.delta_loading(spark, "events", ["user_id"], base, lpath, mpath, layout="partitioned",
                                  read_options=opts)
    if second.applied or second.version != first.version:
        raise AssertionError("second delta_loading applied sessions again")
    return second.mirror.select(*EV_COLS)


def _load(spark, base, mpath, lpath, seed=None, **kw):
    return mirror.delta_loading(spark, "events", ["user_id"], base, lpath, mpath, seed=seed, layout="partitioned",
                                read_options={"timestamp_format": TS_FMT}, **kw)


@register("mirror_mixed_headers", MIRROR_FAITHFUL_SQL)
def mirror_mixed_headers(spark, sf_dir):
    """L8 / S6 through files whose headers list the columns in different orders: matched by name, pending together."""
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas.filter("delta_id < 1012"), base)
    turned = deltas.filter("delta_id >= 1012").select(*reversed(EV_COLS), "delta_id")
    _write_deltas(spark, turned, base, "append")
    return _load(spark, base, fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log"), seed).mirror.select(*EV_COLS)


@register("mirror_string_codes", f"""WITH {MIRROR_TAGGED}
SELECT event_id, user_id, lpad(CAST(event_id % 1000 AS VARCHAR), 6, '0') AS code
FROM (SELECT *, max(d) OVER (PARTITION BY user_id) AS newest FROM tagged) WHERE d = newest""")
def mirror_string_codes(spark, sf_dir):
    """A text column whose delta values look like numbers keeps the mirror's declared type and its zeros."""
    code = F.lpad((F.col("event_id") % 1000).cast("string"), 6, "0").alias("code")
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas.select("event_id", "user_id", code, "delta_id"), base)
    return _load(spark, base, fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log"), seed.select("event_id", "user_id", code)).mirror


@register("mirror_new_column_file", f"""WITH tagged AS (
  SELECT event_id, ts, user_id, event_type, NULL::VARCHAR AS props, -1 AS d FROM events WHERE ts < TIMESTAMP '2024-01-06'
  UNION ALL SELECT event_id, ts, user_id, event_type, CASE WHEN day(ts) >= 12 THEN props END, 1000 + day(ts) - 1
  FROM events WHERE ts >= TIMESTAMP '2024-01-06')
SELECT event_id, {_ts("ts")} AS ts, user_id, event_type, props
FROM (SELECT *, max(d) OVER (PARTITION BY user_id) AS newest FROM tagged) WHERE d = newest""")
def mirror_new_column_file(spark, sf_dir):
    """W13 through files: sessions from the 12th bring a column that the seed and earlier sessions lack."""
    old = ["event_id", "ts", "user_id", "event_type"]
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas.filter("delta_id < 1011").select(*old, "delta_id"), base)
    _write_deltas(spark, deltas.filter("delta_id >= 1011").select(*old, "props", "delta_id"), base, "append")
    out = _load(spark, base, fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log"), seed.select(*old))
    return out.mirror.select(*old, "props")


@register("mirror_late_session", MIRROR_FAITHFUL_SQL)
def mirror_late_session(spark, sf_dir):
    """Sessions of days 6-11 arrive after later ones were applied; they never override a newer session."""
    seed, deltas = _events_split(spark, sf_dir)
    base, mpath, lpath = (fresh_dir(spark, x) for x in ("deltas", "mirror", "delta_log"))
    _write_deltas(spark, deltas.filter("delta_id >= 1011"), base)
    _load(spark, base, mpath, lpath, seed)
    _write_deltas(spark, deltas.filter("delta_id < 1011"), base, "append")
    return _load(spark, base, mpath, lpath).mirror.select(*EV_COLS)


@register("mirror_export", MIRROR_FAITHFUL_SQL)
def mirror_export(spark, sf_dir):
    """The mirror as the CSV ``mirr_<table>``, read back."""
    seed, deltas = _events_split(spark, sf_dir)
    base, out = fresh_dir(spark, "deltas"), fresh_dir(spark, "export")
    _write_deltas(spark, deltas, base)
    _load(spark, base, fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log"), seed, export_to=out)
    return exchange.import_csv(spark, f"{out}/mirr_events", seed.schema)


@register("delta_log_view", """
SELECT DISTINCT CAST(1000 + day(ts) - 1 AS INTEGER) AS delta_id, 'events' AS table_name,
       '2024-02-01 00:00:00.000000' AS started_at, '2024-02-01 00:00:00.000000' AS finished_at
FROM events WHERE ts >= TIMESTAMP '2024-01-06'""")
def delta_log_view(spark, sf_dir):
    """W5 + W14: the log of a load, with an injected clock, through its session view."""
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas, base)
    _load(spark, base, fresh_dir(spark, "mirror"), fresh_dir(spark, "delta_log"), seed, clock=lambda: dt.datetime(2024, 2, 1),
          log_view="delta_logs_query")
    at = lambda c: F.date_format(c, TS_FMT).alias(c)
    return spark.table("delta_logs_query").select("delta_id", "table_name", at("started_at"), at("finished_at"))


@register("mirror_stream", MIRROR_FAITHFUL_SQL)
def mirror_stream(spark, sf_dir):
    """L8 as a file stream: delta folders picked up by a streaming file source, applied per
    micro-batch with foreachBatch; the checkpoint is the load log."""
    seed, deltas = _events_split(spark, sf_dir)
    base = fresh_dir(spark, "deltas")
    _write_deltas(spark, deltas, base)
    mpath = fresh_dir(spark, "mirror")
    delta_stream.seed_mirror(spark, seed, mpath, ["user_id"])
    q = delta_stream.start_mirror_stream(spark, base, seed.schema, ["user_id"], mpath, fresh_dir(spark, "ckpt"))
    q.awaitTermination()
    return delta_stream.read_mirror(spark, mpath).select(*EV_COLS)


@register("distinct_ids", """
SELECT DISTINCT event_type AS table_name, CAST(1000 + day(ts) - 1 AS INTEGER) AS delta_id FROM events""")
def distinct_ids(spark, sf_dir):
    """Distinct (table, session id) pairs of a load log, computed in the plan."""
    ev = bank(spark, sf_dir).raw("events")
    return ev.select(F.col("event_type").alias("table_name"),
                     (F.lit(1000) + F.dayofmonth("ts") - 1).cast("int").alias("delta_id")).distinct()


# ---------------------------------------------------------------- 7. counts
@register("count_by_group", """SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type""")
def count_by_group(spark, sf_dir):
    """A4: rows per value, NULL being a group."""
    return counts.count_by(bank(spark, sf_dir).raw("events"), "event_type")


# A small lower-case dimension of event names, one of which never occurs.
EVENT_DIM = [(1, "click", "web"), (2, "view", "web"), (3, "purchase", "shop"), (4, "signup", "web"),
             (5, "refund", "shop")]


@register("count_for_dim_left", """
WITH dim(row_id, discipline, season) AS (VALUES (1, 'click', 'web'), (2, 'view', 'web'), (3, 'purchase', 'shop'),
                                                (4, 'signup', 'web'), (5, 'refund', 'shop')),
cnt AS (SELECT upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS "Discipline", count(*) AS "count"
        FROM events GROUP BY 1)
SELECT dim.discipline, cnt."count" FROM dim LEFT JOIN cnt ON dim.discipline = lower(cnt."Discipline")""")
def count_for_dim_left(spark, sf_dir):
    """L7 end to end: the dimension saved as one tab-separated CSV (W7); an all-string ';' file of
    capitalised names read back (S8), counted (A4) and attached to the lower-case dimension (J8);
    the result saved as one parquet file (W8) and read back.  Unmatched names keep a NULL count."""
    ev = bank(spark, sf_dir).raw("events")
    work = fresh_dir(spark, "counts")
    dim = rows_frame(spark, EVENT_DIM, "row_id bigint, discipline string, season string")
    exchange.export_csv(dim, f"{work}/dimension.csv", sep="\t")
    named = ev.select(F.concat(F.upper(F.substring("event_type", 1, 1)),
                               F.expr("substring(event_type, 2)")).alias("Discipline"), "user_id")
    exchange.export_csv(named, f"{work}/names.csv", single_file=False)
    c = counts.count_by(read_plain_csv(spark, f"{work}/names.csv"), "Discipline")
    out = counts.count_for_dim(read_plain_csv(spark, f"{work}/dimension.csv", sep="\t"), "discipline", c,
                               "Discipline")
    path = exchange.write_parquet(out, f"{work}/counts_joined.parquet", single_file=True)
    return spark.read.parquet(path)


@register("parquet_roundtrip", """SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type""")
def parquet_roundtrip(spark, sf_dir):
    """W8 + S11: group counts written as parquet and read back."""
    path = exchange.write_parquet(counts.count_by(bank(spark, sf_dir).raw("events"), "event_type"),
                                  fresh_dir(spark, "counts") + "/counts.parquet")
    return spark.read.parquet(path)


@register("global_count", O.with_prelude(body="""
SELECT 'ft_posting_f' AS table_name, count(*) AS n FROM ft_posting_f
UNION ALL SELECT 'md_account_d', count(*) FROM md_account_d"""))
def global_count(spark, sf_dir):
    """A5: row counts of two tables."""
    b = bank(spark, sf_dir)
    return (b.ft_posting_f().agg(F.count(F.lit(1)).alias("n")).select(F.lit("ft_posting_f").alias("table_name"), "n")
            .unionByName(b.md_account_d().agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit("md_account_d").alias("table_name"), "n")))


# ---------------------------------------------------------------- 8. files
@register("export_import_roundtrip", O.with_prelude(
    O.turnover_of("1998-01-01", "1998-01-31"), O.form101("1998-01-31"),
    body=O.f101_out()))
def export_import_roundtrip(spark, sf_dir):
    """W9 + W12 + S15: form 101 exported to one ';' CSV with header, imported into a table LIKE it."""
    f = _f101(bank(spark, sf_dir), "faithful")
    path = exchange.export_csv(f, fresh_dir(spark, "export") + "/report_f101_f.csv")
    copy = exchange.like(spark, f).unionByName(exchange.import_csv(spark, path, DM_F101_ROUND_F))
    return copy


# Chapter names written in Cyrillic to exercise the cp866 path.
CHAPTER_NAMES = {"A": "Балансовые счета", "B": "Внебалансовые"}


@register("csv_cp866_load", O.with_prelude(body="""
SELECT chapter, CASE WHEN chapter = 'A' THEN 'Балансовые счета' ELSE 'Внебалансовые' END AS chapter_name,
       CAST(ledger_account AS INTEGER) AS ledger_account, CAST(NULL AS VARCHAR) AS characteristic,
       CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM md_ledger_account_s"""))
def csv_cp866_load(spark, sf_dir):
    """S1-S5 + L1: the ledger written as a cp866 ';' file (blank-headed row-number column, upper-case
    header, Cyrillic names, an empty field) and loaded through the detail-table loader."""
    led = bank(spark, sf_dir).md_ledger_account_s()
    name = F.when(F.col("chapter") == "A", F.lit(CHAPTER_NAMES["A"])).otherwise(F.lit(CHAPTER_NAMES["B"]))
    out = led.select((F.monotonically_increasing_id() + 1).alias("   "), F.col("chapter").alias("CHAPTER"),
                     name.alias("CHAPTER_NAME"), F.col("ledger_account").alias("LEDGER_ACCOUNT"),
                     F.lit("").alias("CHARACTERISTIC"), F.col("start_date").alias("START_DATE"),
                     F.col("end_date").alias("END_DATE"))
    path = fresh_dir(spark, "ds-files") + "/md_ledger_account_s.csv"
    exchange.export_csv(out, path, encoding="cp866", single_file=False)
    spec = TABLES["md_ledger_account_s"]
    store = fresh_dir(spark, "ds")
    load_table(spark, spec, path, store, encoding="cp866")
    return detail_table(spark, spec, store).read().select(
        "chapter", "chapter_name", "ledger_account", "characteristic", "start_date", "end_date")


@register("csv_balance_load", O.with_prelude(body="""
SELECT CAST(on_date AS VARCHAR) AS on_date, account_rk, CAST(currency_rk AS BIGINT) AS currency_rk,
       CAST(balance_out AS DOUBLE) AS balance_out FROM ft_balance_f"""))
def csv_balance_load(spark, sf_dir):
    """S4 + W1 via L1: balances written with dd.MM.yyyy dates and loaded twice (idempotent upsert)."""
    bal = bank(spark, sf_dir).ft_balance_f()
    out = bal.select((F.monotonically_increasing_id() + 1).alias("\t"),
                     F.date_format("on_date", "dd.MM.yyyy").alias("ON_DATE"), F.col("account_rk").alias("ACCOUNT_RK"),
                     F.col("currency_rk").alias("CURRENCY_RK"), F.col("balance_out").alias("BALANCE_OUT"))
    path = fresh_dir(spark, "ds-files") + "/ft_balance_f.csv"
    exchange.export_csv(out, path, encoding="cp866", single_file=False)
    spec = TABLES["ft_balance_f"]
    store = fresh_dir(spark, "ds")
    load_table(spark, spec, path, store)
    load_table(spark, spec, path, store)
    return detail_table(spark, spec, store).read()


@register("csv_infer", O.with_prelude(body="""
SELECT CAST(data_actual_date AS VARCHAR) AS data_actual_date, CAST(data_actual_end_date AS VARCHAR) AS data_actual_end_date,
       CAST(account_rk AS INTEGER) AS account_rk, CAST(CAST(account_number AS DECIMAL(20,0)) AS DOUBLE) AS account_number, char_type,
       CAST(currency_rk AS INTEGER) AS currency_rk, CAST(currency_code AS INTEGER) AS currency_code FROM md_account_d"""))
def csv_infer(spark, sf_dir):
    """A delta-style file read with inferred types and a dd.MM.yyyy date pattern: digits become numbers."""
    acc = bank(spark, sf_dir).md_account_d()
    out = acc.select(F.date_format("data_actual_date", "dd.MM.yyyy").alias("data_actual_date"),
                     F.date_format("data_actual_end_date", "dd.MM.yyyy").alias("data_actual_end_date"),
                     "account_rk", "account_number", "char_type", "currency_rk", "currency_code")
    path = fresh_dir(spark, "delta-files") + "/md_account_d.csv"
    exchange.export_csv(out, path, single_file=False)
    return read_delta_csv(spark, path)


# ---------------------------------------------------------------- 9. logs and keys
@register("log_chunks", """
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, substr(text, CAST(i * 4000 + 1 AS INTEGER), 4000) AS chunk
FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 3999) // 4000)) AS i FROM documents
      WHERE length(text) > 0)""")
def log_chunks(spark, sf_dir):
    """whole texts split into 4000-character rows (empty/NULL text: no row)."""
    docs = bank(spark, sf_dir).raw("documents").select("doc_id", "text")
    return split_chunks(docs, "text")


@register("log_report", f"""
SELECT o_orderkey AS load_id, {_ts("o_orderdate")} AS started_at,
       {_ts("o_orderdate + INTERVAL 1 DAY")} AS finished_at, {_ts("l_shipdate")} AS event_time,
       CASE WHEN l_orderkey IS NULL THEN NULL ELSE 'lineitem' END AS source_table, l_linestatus AS event_type,
       CAST(l_quantity AS INTEGER) AS rows_affected,
       (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0 AS load_duration_sec
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def log_report(spark, sf_dir):
    """J9 + F15: loads (orders) left-joined to their table events (line items) with the duration."""
    b = bank(spark, sf_dir)
    loads = b.raw("orders").select(F.col("o_orderkey").alias("load_id"), F.col("o_orderdate").alias("started_at"),
                                   (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("finished_at"))
    events = b.raw("lineitem").select(F.col("l_orderkey").alias("load_id"), F.col("l_shipdate").alias("event_time"),
                                      F.lit("lineitem").alias("source_table"),
                                      F.col("l_linestatus").alias("event_type"),
                                      F.col("l_quantity").cast("int").alias("rows_affected"))
    return runlog.load_report(loads, events)


@register("load_runs", f"""
WITH ev AS (SELECT o_orderkey AS load_id, 'start' AS event, o_orderdate AS event_time FROM orders
            UNION ALL SELECT l_orderkey, 'finish', l_shipdate FROM lineitem)
SELECT load_id, {_ts("min(CASE WHEN event = 'start' THEN event_time END)")} AS started_at,
       {_ts("max(CASE WHEN event = 'finish' THEN event_time END)")} AS finished_at
FROM ev GROUP BY load_id""")
def load_runs(spark, sf_dir):
    """Loads closed by appended 'finish' events instead of an UPDATE; finished_at is the last one."""
    b = bank(spark, sf_dir)
    ev = (b.raw("orders").select(F.col("o_orderkey").alias("load_id"), F.lit("start").alias("event"),
                                 F.col("o_orderdate").alias("event_time"))
          .unionByName(b.raw("lineitem").select(F.col("l_orderkey").alias("load_id"), F.lit("finish").alias("event"),
                                                F.col("l_shipdate").alias("event_time"))))
    return runlog.load_runs(ev)


@register("pk_check", O.with_prelude(body="""
SELECT CAST(oper_date AS VARCHAR) AS oper_date, credit_account_rk, debet_account_rk, count(*) AS n
FROM ft_posting_f GROUP BY oper_date, credit_account_rk, debet_account_rk HAVING count(*) > 1"""))
def pk_check(spark, sf_dir):
    """Keys of ft_posting_f that break its primary key."""
    return duplicate_keys(bank(spark, sf_dir).ft_posting_f(), ["oper_date", "credit_account_rk", "debet_account_rk"])


# ---------------------------------------------------------------- 10. scalars, sort, limit
@register("scalar_dates", """
SELECT o_orderkey, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
       CAST(last_day(d) AS VARCHAR) AS month_end, CAST(CAST(date_trunc('month', d) AS DATE) - 1 AS VARCHAR) AS prev_month_end,
       CAST(d + 1 AS VARCHAR) AS next_day, strftime(d, '%Y-%m-%d') AS iso,
       CAST(CAST(strptime(strftime(d, '%d.%m.%Y'), '%d.%m.%Y') AS DATE) AS VARCHAR) AS parsed
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def scalar_dates(spark, sf_dir):
    """F1-F6 over every order date."""
    o = bank(spark, sf_dir).raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", cal.month_start("d").alias("month_start"), cal.month_end("d").alias("month_end"),
                    cal.prev_month_end("d").alias("prev_month_end"), cal.next_day("d").alias("next_day"),
                    cal.iso_date("d").alias("iso"),
                    F.to_date(F.date_format("d", "dd.MM.yyyy"), "dd.MM.yyyy").alias("parsed"))


@register("scalar_strings", O.with_prelude(body="""
SELECT account_rk, CAST(data_actual_date AS VARCHAR) AS data_actual_date, substr(account_number, 1, 5) AS ledger,
       substr(account_number, 6) AS tail, CAST(length(account_number) AS INTEGER) AS len,
       CASE WHEN abs(account_rk) < 10000 THEN CAST(account_rk AS VARCHAR) ELSE '####' END AS fm,
       char_type || '-' || currency_code AS label, lower(char_type) AS kind
FROM md_account_d"""))
def scalar_strings(spark, sf_dir):
    """F7-F11 over every account version (FM9999: five digits and more print '####')."""
    a = bank(spark, sf_dir).md_account_d()
    return a.select("account_rk", "data_actual_date", F.substring("account_number", 1, 5).alias("ledger"),
                    F.expr("substring(account_number, 6)").alias("tail"), F.length("account_number").alias("len"),
                    fm_digits(F.col("account_rk"), 4).alias("fm"),
                    F.concat("char_type", F.lit("-"), "currency_code").alias("label"),
                    F.lower("char_type").alias("kind"))


@register("scalar_conditional", O.with_prelude(O.turnover_of("1998-01-01", "1998-01-31"), body="""
SELECT CAST(on_date AS VARCHAR) AS on_date, account_rk,
       CAST(debet_amount_rub - credit_amount_rub AS DOUBLE) AS net_rub,
       CASE WHEN debet_amount_rub > credit_amount_rub THEN 'D' WHEN debet_amount_rub < credit_amount_rub THEN 'C'
            ELSE 'Z' END AS side,
       CAST(COALESCE(NULLIF(credit_amount, 0), debet_amount) AS DOUBLE) AS first_nonzero
FROM turnover"""))
def scalar_conditional(spark, sf_dir):
    """F12 + F13: CASE, COALESCE, NULLIF and decimal arithmetic over the turnover month."""
    t = _turnover_month(bank(spark, sf_dir))
    d, c = F.col("debet_amount_rub"), F.col("credit_amount_rub")
    return t.select("on_date", "account_rk", (d - c).alias("net_rub"),
                    F.when(d > c, "D").when(d < c, "C").otherwise("Z").alias("side"),
                    F.coalesce(F.nullif(F.col("credit_amount"), F.lit(0)), F.col("debet_amount")).alias("first_nonzero"))


@register("sorted_limit", O.with_prelude(O.turnover_of("1998-01-01", "1998-01-31"),
                                         body=O.TURN_OUT + """ FROM turnover
ORDER BY credit_amount_rub DESC, account_rk, on_date LIMIT 10"""))
def sorted_limit(spark, sf_dir):
    """X2 + X3: the ten largest credit turnovers (a top-k report; total order, so ties cannot flip)."""
    t = _turnover_month(bank(spark, sf_dir))
    return t.orderBy(F.col("credit_amount_rub").desc(), "account_rk", "on_date").limit(10)


# ---------------------------------------------------------------- 11. the whole run
@register("run_all", O.with_prelude(O.turnover_of("1998-01-01", "1998-01-31"),
                                    O.form101("1998-01-31"), body=O.f101_out()))
def run_all(spark, sf_dir):
    """Turnover -> form 101 -> CSV export -> import into the copy table (+ min/max report);
    returns the imported copy."""
    b = bank(spark, sf_dir)
    ds = daily_run.DetailLayer(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                              b.md_exchange_rate_d(), b.ft_posting_f())
    out = daily_run.run_all(spark, ds, fresh_dir(spark, "run"), REPORT_DATE, dt.date(1998, 1, 20))
    return out.f101_copy


def _detail_files(spark, b, base):
    """The six detail tables as cp866 files with a blank-headed row number, as the loader expects them."""
    def day(c):
        return F.date_format(c, "yyyy-MM-dd").alias(c)

    postings = b.ft_posting_f().groupBy("oper_date", "credit_account_rk", "debet_account_rk").agg(
        F.sum("credit_amount").alias("credit_amount"), F.sum("debet_amount").alias("debet_amount"))     # one row a key
    frames = {
        "md_ledger_account_s": b.md_ledger_account_s().select("chapter", "ledger_account", day("start_date"), day("end_date")),
        "md_account_d": b.md_account_d().select(day("data_actual_date"), day("data_actual_end_date"), "account_rk", "account_number",
                                                "char_type", "currency_rk", F.coalesce("currency_code", F.lit("000")).alias("currency_code")),
        "md_currency_d": b.md_currency_d().select("currency_rk", day("data_actual_date"), day("data_actual_end_date"), "currency_code"),
        "md_exchange_rate_d": b.md_exchange_rate_d().select(day("data_actual_date"), day("data_actual_end_date"), "currency_rk",
                                                            "reduced_cource"),
        "ft_balance_f": b.ft_balance_f().select(F.date_format("on_date", "dd.MM.yyyy").alias("on_date"), "account_rk", "currency_rk",
                                                "balance_out"),
        "ft_posting_f": postings.select(day("oper_date"), "credit_account_rk", "debet_account_rk", "credit_amount", "debet_amount"),
    }
    for name, df in frames.items():
        numbered = df.select((F.monotonically_increasing_id() + 1).alias("   "), *[F.col(c).alias(c.upper()) for c in df.columns])
        exchange.export_csv(numbered, f"{base}/{name}.csv", encoding="cp866", single_file=False)
    return {name: f"{base}/{name}.csv" for name in frames}


KEYED_POSTINGS = """ft_posting_keyed AS (
  SELECT oper_date, credit_account_rk, debet_account_rk, sum(credit_amount) AS credit_amount, sum(debet_amount) AS debet_amount
  FROM ft_posting_f GROUP BY oper_date, credit_account_rk, debet_account_rk)"""


@register("run_all_from_files", O.with_prelude(
    KEYED_POSTINGS, O.turnover_of("1998-01-01", "1998-01-31", postings="ft_posting_keyed"), O.form101("1998-01-31"), body=O.f101_out()))
def run_all_from_files(spark, sf_dir):
    """L1 + L11: six detail files loaded, then the whole run; returns the imported copy of form 101."""
    work = fresh_dir(spark, "run")
    files = _detail_files(spark, bank(spark, sf_dir), f"{work}/files")
    return daily_run.run_all_from_files(spark, files, work, REPORT_DATE, dt.date(1998, 1, 20)).f101_copy


@register("run_log", O.with_prelude(
    KEYED_POSTINGS, O.turnover_of("1998-01-01", "1998-01-31", postings="ft_posting_keyed"), O.form101("1998-01-31"), body="""
, steps(event_type, subject, rows_affected) AS (
  SELECT 'load', 'md_ledger_account_s', count(*) FROM md_ledger_account_s
  UNION ALL SELECT 'load', 'md_account_d', count(*) FROM md_account_d
  UNION ALL SELECT 'load', 'md_currency_d', count(*) FROM md_currency_d
  UNION ALL SELECT 'load', 'md_exchange_rate_d', count(*) FROM md_exchange_rate_d
  UNION ALL SELECT 'load', 'ft_balance_f', count(*) FROM ft_balance_f
  UNION ALL SELECT 'load', 'ft_posting_f', count(*) FROM ft_posting_keyed
  UNION ALL SELECT 'turnover', '', count(*) FROM turnover UNION ALL SELECT 'f101', '', count(*) FROM f101
  UNION ALL SELECT 'save_f101_f', '', NULL UNION ALL SELECT 'load_f101_f_copy', '', NULL UNION ALL SELECT 'min_max_posting', '', NULL)
SELECT CAST(1 AS BIGINT) AS pipeline_run_id, '2024-03-01 12:00:00.000000' AS date_time, event_type, phase, subject,
       CASE WHEN phase = 'END' THEN rows_affected END AS rows_affected, CAST(1 AS INTEGER) AS message_type
FROM steps, (VALUES ('BEGIN'), ('END')) AS phases(phase)""".lstrip()))
def run_log(spark, sf_dir):
    """L9 + F14 + F16 + A7: the log of a run from files, written with an injected clock, read back with its row counts."""
    work = fresh_dir(spark, "run")
    files = _detail_files(spark, bank(spark, sf_dir), f"{work}/files")
    daily_run.run_all_from_files(spark, files, work, REPORT_DATE, dt.date(1998, 1, 20), clock=lambda: dt.datetime(2024, 3, 1, 12))
    log = AppendLog(spark, f"{work}/logs/log_info", LOG_INFO).read()
    return log.select("pipeline_run_id", F.date_format("date_time", TS_FMT).alias("date_time"), "event_type",
                      F.regexp_extract("message_", r"^\[(\w+)\]", 1).alias("phase"),
                      F.when(F.col("event_type") == "load", F.regexp_extract("message_", r"load (\w+)", 1)).otherwise("").alias("subject"),
                      "rows_affected", "message_type")


@register("min_max_report", O.with_prelude(O.day_extremes("1998-01-20"), body=O.EXTREMES_OUT))
def min_max_report(spark, sf_dir):
    """The min/max report that the whole run leaves as a CSV, read back."""
    b = bank(spark, sf_dir)
    ds = daily_run.DetailLayer(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                              b.md_exchange_rate_d(), b.ft_posting_f())
    out = daily_run.run_all(spark, ds, fresh_dir(spark, "run"), REPORT_DATE, dt.date(1998, 1, 20))
    return exchange.import_csv(spark, out.min_max_csv, out.min_max.schema)


@register("load_constraints", O.with_prelude(body="""
SELECT CAST(account_rk AS VARCHAR) AS account_rk, CAST(data_actual_date AS VARCHAR) AS data_actual_date,
       concat_ws(',', CASE WHEN account_rk % 11 = 0 THEN 'account_number' END, CASE WHEN currency_code IS NULL THEN 'currency_code' END)
         AS bad_columns
FROM md_account_d WHERE account_rk % 11 = 0 OR currency_code IS NULL"""))
def load_constraints(spark, sf_dir):
    """S5 + W11: rows that break NOT NULL or a length go to the rejects of the load, with the columns at fault."""
    acc = bank(spark, sf_dir).md_account_d()
    number = F.when(F.col("account_rk") % 11 == 0, F.concat("account_number", F.lit("X"))).otherwise(F.col("account_number"))
    out = acc.withColumn("account_number", number).select((F.monotonically_increasing_id() + 1).alias("   "), *acc.columns)
    path, store = fresh_dir(spark, "ds-files") + "/md_account_d.csv", fresh_dir(spark, "ds")
    exchange.export_csv(out, path, encoding="cp866", single_file=False)
    load_table(spark, TABLES["md_account_d"], path, store, bad_values="reject")
    of = lambda c: F.get_json_object("row_text", f"$.{c}").alias(c)
    return spark.read.parquet(f"{store}_rejects").select(of("account_rk"), of("data_actual_date"),
                                                         F.array_join("bad_columns", ",").alias("bad_columns"))


@register("versioned_types", """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_nationkey AS DOUBLE) / 2 AS half FROM nation""")
def versioned_types(spark, sf_dir):
    """A table written with integer keys, then with long ones and one more column; readers see the new types."""
    n = bank(spark, sf_dir).raw("nation")
    t = VersionedTable(spark, fresh_dir(spark, "types"))
    t.write(n.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name"))
    t.write(t.read().select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", (F.col("n_nationkey") / 2).alias("half")))
    return t.read()
