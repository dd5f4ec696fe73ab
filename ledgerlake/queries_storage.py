"""Registered queries of text exchange, growing tables and streams by header.

Imported by ``ledgerlake.queries``; each has a DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import oracle as O
from ledgerlake.operators.joins import asof_join, interval_conflicts
from ledgerlake.operators.upsert import upsert
from ledgerlake.plans import exchange
from ledgerlake.plans.loader import detail_table, load_table
from ledgerlake.plans.sql_functions import create_min_max_posting
from ledgerlake.queries import MINMAX_DATE, bank, register
from ledgerlake.queries_more import EV_COLS, MIRROR_FAITHFUL_SQL, _events_split, _write_deltas
from ledgerlake.schemas import TABLES
from ledgerlake.session import fresh_dir
from ledgerlake.sinks.parts import PartsTable
from ledgerlake.streaming import delta_stream

# Stands between nothing: a separator no line has, so that a file of ready lines is written as it is.
_NEVER = "\x01"


def _account_lines(spark, sf_dir):
    """The accounts with one text column ``line``, a record of the detail file."""
    acc = bank(spark, sf_dir).md_account_d()
    line = F.concat_ws(";", F.lit("1"), *[F.coalesce(F.col(c).cast("string"), F.lit("000")) for c in acc.columns])
    return acc.withColumn("line", line), "\t;" + ";".join(c.upper() for c in acc.columns)


# ---------------------------------------------------------------- 1. text exchange
@register("csv_ragged_rows", O.with_prelude(body="""
, lines AS (SELECT account_rk, CAST(data_actual_date AS VARCHAR) AS data_actual_date,
  concat_ws(';', '1', CAST(data_actual_date AS VARCHAR), CAST(data_actual_end_date AS VARCHAR), CAST(account_rk AS VARCHAR), account_number,
    char_type, CAST(currency_rk AS VARCHAR), coalesce(currency_code, '000')) AS line FROM md_account_d)
SELECT CASE WHEN account_rk % 13 <> 0 AND account_rk % 17 <> 0 THEN account_rk END AS account_rk,
  CASE WHEN account_rk % 13 <> 0 AND account_rk % 17 <> 0 THEN data_actual_date END AS data_actual_date,
  CASE WHEN account_rk % 13 = 0 THEN line || ';x;y' WHEN account_rk % 17 = 0 THEN regexp_replace(line, ';[^;]*;[^;]*$', '') END AS rejected
FROM lines""".lstrip()))
def csv_ragged_rows(spark, sf_dir):
    """S1 + S5: a file in which some records have two fields too many and some two too few; these go to the rejects with
    their text, the others load."""
    acc, header = _account_lines(spark, sf_dir)
    line = F.when(F.col("account_rk") % 13 == 0, F.concat("line", F.lit(";x;y"))) \
        .when(F.col("account_rk") % 17 == 0, F.regexp_replace("line", ";[^;]*;[^;]*$", "")).otherwise(F.col("line"))
    path, store = fresh_dir(spark, "ds-files") + "/md_account_d.csv", fresh_dir(spark, "ds")
    exchange.export_csv(acc.select(line.alias(header)), path, sep=_NEVER, encoding="cp866", single_file=False)
    spec = TABLES["md_account_d"]
    load_table(spark, spec, path, store, bad_values="reject")
    good = detail_table(spark, spec, store).read().select("account_rk", "data_actual_date", F.lit(None).cast("string").alias("rejected"))
    bad = spark.read.parquet(f"{store}_rejects").where("bad_columns[0] = '(width)'")
    return good.unionByName(bad.select(F.lit(None).cast("long").alias("account_rk"), F.lit(None).cast("date").alias("data_actual_date"),
                                       F.get_json_object("row_text", "$['(width)']").alias("rejected")))


@register("csv_multiline", O.with_prelude(body=r"""
SELECT chapter, 'a"' || chapter || ';' || chr(10) || '"b"' AS chapter_name, CAST(ledger_account AS INTEGER) AS ledger_account,
  CAST(start_date AS VARCHAR) AS start_date, ' one' || chr(13) || chr(10) || 'two ' AS section_name FROM md_ledger_account_s"""))
def csv_multiline(spark, sf_dir):
    """A detail file whose quoted names hold separators, doubled quotes and line breaks: one record each."""
    led = bank(spark, sf_dir).md_ledger_account_s()
    name = F.concat(F.lit('a"'), "chapter", F.lit(';\n"b"'))
    out = led.select(F.lit(1).alias(" "), "chapter", name.alias("chapter_name"), "ledger_account", "start_date",
                     F.lit(" one\r\ntwo ").alias("section_name"))
    path, store = fresh_dir(spark, "ds-files") + "/md_ledger_account_s.csv", fresh_dir(spark, "ds")
    exchange.export_csv(out, path, encoding="cp866", single_file=False)
    load_table(spark, TABLES["md_ledger_account_s"], path, store)
    return detail_table(spark, TABLES["md_ledger_account_s"], store).read().select(
        "chapter", "chapter_name", "ledger_account", "start_date", "section_name")


@register("export_import_text", r"""
SELECT doc_id, sha256(text) AS text_sha256, CAST(length(text) AS INTEGER) AS n, '  ' || lang || ' ' AS padded,
  CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'say "hi"; \ok\' ELSE '""' || chr(13) || chr(10) END AS odd FROM documents""")
def export_import_text(spark, sf_dir):
    """W9 + S15: whole texts (line breaks, quotes, separators, blanks, empty beside NULL) exported as CSV and imported again."""
    docs = bank(spark, sf_dir).raw("documents")
    k = F.col("doc_id") % 4
    odd = F.when(k == 0, "").when(k == 2, 'say "hi"; \\ok\\').when(k == 3, '""\r\n')
    out = docs.select("doc_id", "text", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("padded"), odd.alias("odd"))
    path = exchange.export_csv(out, fresh_dir(spark, "export") + "/texts.csv", single_file=False)
    back = exchange.import_csv(spark, path, out.schema)
    return back.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.char_length("text").alias("n"), "padded", "odd")


# ---------------------------------------------------------------- 2. tables that grow and change
ROUNDS = 4


@register("growing_buckets", f"""
SELECT o_orderkey, o_totalprice, CAST((SELECT max(r) FROM range({ROUNDS}) t(r) WHERE o_orderkey % CAST(pow(4, {ROUNDS - 1} - r) AS BIGINT) = 0) AS INTEGER) AS loaded
FROM orders""")
def growing_buckets(spark, sf_dir):
    """W1 + L8: loads that each multiply a keyed table by four; its buckets split one by one and hold no more rows than allowed."""
    orders = bank(spark, sf_dir).raw("orders").select("o_orderkey", "o_totalprice")
    schema = T.StructType([*orders.schema.fields, T.StructField("loaded", T.IntegerType())])
    table = PartsTable(spark, fresh_dir(spark, "growing"), schema, split_rows=2000)
    for r in range(ROUNDS):
        batch = orders.where(F.col("o_orderkey") % 4 ** (ROUNDS - 1 - r) == 0).withColumn("loaded", F.lit(r))
        table.merge(batch, ["o_orderkey"], lambda old, new: upsert(old, new, ["o_orderkey"], ["loaded"]))
    return table.read()


@register("typed_history", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 4 = 1 THEN CAST(c_nationkey * 2 AS VARCHAR) || 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS code,
  CAST(CAST(c_acctbal AS DECIMAL(23,8)) AS DOUBLE) AS c_acctbal, CASE WHEN c_custkey % 4 = 1 THEN 'new' END AS note FROM customer""")
def typed_history(spark, sf_dir):
    """W13 + W15: parts written with int codes and double amounts, one part replaced later with text codes, decimal(23,8)
    amounts and one more column; the other parts are read as they are and widened."""
    c = bank(spark, sf_dir).raw("customer")
    table = PartsTable(spark, fresh_dir(spark, "typed"))
    old = c.select(F.col("c_custkey").cast("int").alias("c_custkey"), F.col("c_nationkey").cast("int").alias("code"), F.col("c_acctbal").cast("double").alias("c_acctbal"))
    part = F.pmod(F.col("c_custkey").cast("int"), F.lit(4))
    table.replace(old, part)
    new = c.where("c_custkey % 4 = 1").select(F.col("c_custkey").cast("string").alias("c_custkey"), F.concat((F.col("c_nationkey") * 2).cast("string"), F.lit("x")).alias("code"),
                                              F.col("c_acctbal").cast("decimal(23,8)").alias("c_acctbal"), F.lit("new").alias("note"))
    table.replace(new, part, ["1"], schema=new.schema)
    return table.read()


@register("load_skips", O.with_prelude(body="""
SELECT 'old keys' AS step, count(*) AS rows_written, CAST(0 AS BIGINT) AS segments_rewritten FROM md_account_d WHERE account_rk % 2 = 0
UNION ALL SELECT 'new keys', count(*), 0 FROM md_account_d WHERE account_rk % 2 = 1
UNION ALL SELECT 'new keys again', count(*), 1 FROM md_account_d WHERE account_rk % 2 = 1"""))
def load_skips(spark, sf_dir):
    """W1 + W11: a load of keys the table lacks appends them and rewrites nothing; loaded again, it rewrites what it brought only."""
    acc = bank(spark, sf_dir).md_account_d().withColumn("currency_code", F.coalesce("currency_code", F.lit("000")))
    store, spec, steps = fresh_dir(spark, "ds"), TABLES["md_account_d"], []
    for step, rest in (("old keys", 0), ("new keys", 1), ("new keys again", 1)):
        path = fresh_dir(spark, "ds-files") + "/md_account_d.csv"
        out = acc.where(F.col("account_rk") % 2 == rest).select(F.lit(1).alias(" "), *acc.columns)
        exchange.export_csv(out, path, encoding="cp866", single_file=False)
        m = load_table(spark, spec, path, store).merged
        steps.append((step, m.rows_written, m.segments_rewritten))
    return spark.createDataFrame(steps, "step string, rows_written long, segments_rewritten long")


# ---------------------------------------------------------------- 3. intervals
@register("asof_history", O.with_prelude(body="""
, e AS (SELECT event_id, CAST(user_id % 40 AS BIGINT) AS k, CAST(DATE '1997-06-01' + CAST(event_id % 700 AS INTEGER) AS DATE) AS day FROM events),
v AS (SELECT CAST(s_suppkey % 50 AS BIGINT) AS k, s_suppkey, CAST(DATE '1997-01-01' + CAST((s_suppkey * 37) % 900 AS INTEGER) AS DATE) AS s,
  CAST(DATE '1997-01-01' + CAST((s_suppkey * 37) % 900 + (s_suppkey * s_suppkey) % 400 AS INTEGER) AS DATE) AS e FROM supplier)
SELECT event_id, e.k, CAST(day AS VARCHAR) AS day, s_suppkey FROM e LEFT JOIN v ON e.k = v.k AND day BETWEEN v.s AND v.e""".lstrip()))
def asof_history(spark, sf_dir):
    """J1 + J2 over a whole history, without a window: events joined to all versions valid on their day, by blocks of days."""
    b = bank(spark, sf_dir)
    day0 = lambda d, n: F.date_add(F.lit(d).cast("date"), n.cast("int"))
    ev = b.raw("events").select("event_id", (F.col("user_id") % 40).cast("long").alias("k"), day0("1997-06-01", F.col("event_id") % 700).alias("day"))
    at = (F.col("s_suppkey") * 37) % 900
    versions = b.raw("supplier").select((F.col("s_suppkey") % 50).cast("long").alias("k"), "s_suppkey", day0("1997-01-01", at).alias("s"),
                                        day0("1997-01-01", at + (F.col("s_suppkey") * F.col("s_suppkey")) % 400).alias("e"))
    ev = ev.withColumn("text", F.date_format("day", "yyyy-MM-dd"))      # of an event, not of each row of the result
    return asof_join(ev, versions, "k", "day", "s", "e", salts=4).select("k", F.col("text").alias("day"), "event_id", "s_suppkey")


@register("interval_conflicts", O.with_prelude(body="""
, bad AS (SELECT account_rk, CASE WHEN account_rk % 19 = 0 THEN data_actual_end_date + 5 ELSE data_actual_date END AS s,
  CASE WHEN account_rk % 5 = 0 THEN data_actual_end_date - 1 WHEN account_rk % 23 = 0 THEN NULL WHEN account_rk % 7 = 0 THEN data_actual_end_date + 40
    ELSE data_actual_end_date END AS e FROM md_account_d),
good AS (SELECT account_rk, CAST(s AS DATE) AS s, CAST(e AS DATE) AS e FROM bad WHERE s <= e),
last AS (SELECT account_rk, max(e) AS last FROM good GROUP BY account_rk),
starts AS (SELECT DISTINCT account_rk, s AS day FROM good),
ends AS (SELECT DISTINCT g.account_rk, CAST(g.e + 1 AS DATE) AS day FROM good g JOIN last USING (account_rk) WHERE g.e < last)
SELECT account_rk, CASE WHEN e < s THEN 'reversed' ELSE 'open' END AS kind, CAST(CAST(coalesce(s, e) AS DATE) AS VARCHAR) AS day, CAST(1 AS BIGINT) AS n
  FROM bad WHERE s IS NULL OR e IS NULL OR e < s
UNION ALL SELECT starts.account_rk, 'overlap', CAST(day AS VARCHAR), count(*) FROM starts JOIN good g ON g.account_rk = starts.account_rk AND day BETWEEN g.s AND g.e
  GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT account_rk, 'gap', CAST(day AS VARCHAR), 0 FROM ends
  WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.account_rk = ends.account_rk AND ends.day BETWEEN g.s AND g.e)""".lstrip()))
def interval_conflicts_query(spark, sf_dir):
    """P2 + J4 + W11: account versions, some of them made to overlap, to leave gaps, to be reversed or open: all are reported."""
    acc, rk = bank(spark, sf_dir).md_account_d(), F.col("account_rk")
    s = F.when(rk % 19 == 0, F.date_add("data_actual_end_date", 5)).otherwise(F.col("data_actual_date"))
    e = F.when(rk % 5 == 0, F.date_sub("data_actual_end_date", 1)).when(rk % 23 == 0, None).when(rk % 7 == 0, F.date_add("data_actual_end_date", 40)) \
        .otherwise(F.col("data_actual_end_date"))
    return interval_conflicts(acc.select("account_rk", s.alias("s"), e.alias("e")), "account_rk", "s", "e")


# ---------------------------------------------------------------- 4. the stream by header
@register("mirror_stream_headers", MIRROR_FAITHFUL_SQL)
def mirror_stream_headers(spark, sf_dir):
    """L8 as a stream over files whose headers list the columns in different orders: matched by name, as in the batch job."""
    seed, deltas = _events_split(spark, sf_dir)
    base, mpath = fresh_dir(spark, "deltas"), fresh_dir(spark, "mirror")
    _write_deltas(spark, deltas.filter("delta_id < 1012"), base)
    _write_deltas(spark, deltas.filter("delta_id >= 1012").select(*reversed(EV_COLS), "delta_id"), base, "append")
    delta_stream.seed_mirror(spark, seed, mpath, ["user_id"])
    delta_stream.start_mirror_stream(spark, base, seed.schema, ["user_id"], mpath, fresh_dir(spark, "ckpt")).awaitTermination()
    return delta_stream.read_mirror(spark, mpath).select(*EV_COLS)


# ---------------------------------------------------------------- 5. SQL functions
@register("min_max_sql", O.with_prelude(O.day_extremes("1998-01-20"), body=O.EXTREMES_OUT))
def min_max_sql(spark, sf_dir):
    """The report of a day through the SQL table function, over views of the detail layer."""
    b = bank(spark, sf_dir)
    views = {"sql_postings": b.ft_posting_f(), "sql_accounts": b.md_account_d(), "sql_rates": b.md_exchange_rate_d()}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    create_min_max_posting(spark, *views)
    return spark.sql(f"SELECT * FROM min_max_posting(DATE '{MINMAX_DATE.isoformat()}')")
