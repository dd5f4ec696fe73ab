"""Registered queries: one per operator / job of the survey inventory.

Each query takes ``(spark, sf_dir)``, reads the test tables under ``sf_dir``
(or data Spark derives from them) and returns a DataFrame normalised by
``for_compare``.  ``ORACLE`` holds the matching DuckDB SQL where an honest
SQL twin exists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import oracle as O
from ledgerlake.compare import for_compare
from ledgerlake.functions import calendar as cal
from ledgerlake.functions.scalars import fm_digits
from ledgerlake.operators.extremes import extreme_rows
from ledgerlake.operators.joins import asof_join, bounded_broadcast
from ledgerlake.plans import f101 as f101_plan
from ledgerlake.plans import min_max, turnover
from ledgerlake.sources.bank_views import MONTH_START, REPORT_DATE, BankTables, FineBank

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MINMAX_DATE = dt.date(1998, 1, 20)
TURNOVER_DAY = dt.date(1998, 1, 20)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_compare(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def bank(spark: SparkSession, sf_dir: str) -> BankTables:
    return BankTables(spark, sf_dir)


def _turnover_month(b: BankTables) -> DataFrame:
    return turnover.month_turnover(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), REPORT_DATE)


def _f101(b: BankTables, fanout: str) -> DataFrame:
    return f101_plan.f101(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                          b.md_exchange_rate_d(), _turnover_month(b), REPORT_DATE, fanout)


# ---------------------------------------------------------------- 1. calendar and as-of lookups
@register("month_bounds", O.with_prelude(body="""
SELECT DISTINCT CAST(CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS VARCHAR) AS month_start,
       CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS month_end,
       CAST(CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) - 1 AS VARCHAR) AS prev_month_end
FROM orders"""))
def month_bounds(spark, sf_dir):
    """F1-F3 for every month that has orders."""
    d = bank(spark, sf_dir).raw("orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return d.select(cal.month_start("d").alias("month_start"), cal.month_end("d").alias("month_end"),
                    cal.prev_month_end("d").alias("prev_month_end")).distinct()


LEGS_SQL = """legs AS (
  SELECT oper_date, credit_account_rk AS account_rk FROM ft_posting_f
   WHERE oper_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'
  UNION ALL
  SELECT oper_date, debet_account_rk FROM ft_posting_f
   WHERE oper_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31')"""


@register("asof_rate_left", O.with_prelude(LEGS_SQL, body="""
SELECT CAST(l.oper_date AS VARCHAR) AS oper_date, l.account_rk, a.currency_rk,
       CAST(er.reduced_cource AS DOUBLE) AS reduced_cource
FROM legs l
JOIN md_account_d a ON a.account_rk = l.account_rk AND l.oper_date BETWEEN a.data_actual_date AND a.data_actual_end_date
LEFT JOIN md_exchange_rate_d er ON er.currency_rk = a.currency_rk
     AND l.oper_date BETWEEN er.data_actual_date AND er.data_actual_end_date"""))
def asof_rate_left(spark, sf_dir):
    """Every posting leg of the month, its account as of the day, left-joined to the rate of the day."""
    b = bank(spark, sf_dir)
    legs = turnover.posting_legs(b.ft_posting_f(), MONTH_START, REPORT_DATE).select("oper_date", "account_rk")
    acc = b.md_account_d().select("account_rk", "currency_rk", "data_actual_date", "data_actual_end_date")
    j = asof_join(legs, acc, "account_rk", "oper_date", "data_actual_date", "data_actual_end_date", "inner")
    rates = b.md_exchange_rate_d().select("currency_rk", "data_actual_date", "data_actual_end_date",
                                          F.col("reduced_cource").cast("double").alias("reduced_cource"))
    j = asof_join(j, rates, "currency_rk", "oper_date", "data_actual_date", "data_actual_end_date", "left",
                  window=(MONTH_START, REPORT_DATE))
    return j.select("oper_date", "account_rk", "currency_rk", "reduced_cource")


@register("account_asof_inner", O.with_prelude(LEGS_SQL, body="""
SELECT CAST(l.oper_date AS VARCHAR) AS oper_date, l.account_rk,
       CAST(a.data_actual_date AS VARCHAR) AS version_start, a.char_type
FROM legs l
JOIN md_account_d a ON a.account_rk = l.account_rk
WHERE l.oper_date BETWEEN a.data_actual_date AND a.data_actual_end_date
  AND a.data_actual_date BETWEEN date_trunc('month', l.oper_date) AND last_day(l.oper_date)"""))
def account_asof_inner(spark, sf_dir):
    """J1 + P3: legs joined to the account version valid that day that also starts in the day's month."""
    b = bank(spark, sf_dir)
    legs = turnover.posting_legs(b.ft_posting_f(), MONTH_START, REPORT_DATE).select("oper_date", "account_rk")
    acc = b.md_account_d().select("account_rk", F.col("data_actual_date").alias("_start"),
                                  F.col("data_actual_end_date").alias("_end"), "char_type")
    j = legs.join(acc, "account_rk").filter(turnover._asof_in_month())
    return j.select("oper_date", "account_rk", F.col("_start").alias("version_start"), "char_type")


# ---------------------------------------------------------------- 2. turnover
@register("turnover_day", O.with_prelude(O.turnover_of("1998-01-20", "1998-01-20"), body=O.TURN_OUT + " FROM turnover"))
def turnover_day(spark, sf_dir):
    """L2: the turnover mart rows of one day."""
    b = bank(spark, sf_dir)
    return turnover.account_turnover(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), TURNOVER_DAY)


@register("turnover_month", O.with_prelude(O.turnover_of("1998-01-01", "1998-01-31"), body=O.TURN_OUT + " FROM turnover"))
def turnover_month(spark, sf_dir):
    """L3: the turnover mart for every day of the month, as one job."""
    return _turnover_month(bank(spark, sf_dir))


@register("turnover_legs", O.with_prelude(O.priced_legs("1998-01-01", "1998-01-31"), body=O.LEGS_OUT))
def turnover_legs(spark, sf_dir):
    """U1 + P10: the credit and debit legs before grouping, NULL on the other side."""
    b = bank(spark, sf_dir)
    return turnover.turnover_legs(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(),
                                  MONTH_START, REPORT_DATE)


# ---------------------------------------------------------------- 3. form 101
JANUARY = O.turnover_of("1998-01-01", "1998-01-31")


@register("f101_faithful", O.with_prelude(JANUARY, O.form101("1998-01-31"), body=O.f101_out()))
def f101_faithful(spark, sf_dir):
    """L4 as the reference computes it: opening balances counted once per turnover day (Q1)."""
    return _f101(bank(spark, sf_dir), "faithful")


@register("f101_corrected", O.with_prelude(JANUARY, O.form101("1998-01-31", fanout=False), body=O.f101_out()))
def f101_corrected(spark, sf_dir):
    """L4 with each opening balance counted once."""
    return _f101(bank(spark, sf_dir), "corrected")


@register("f101_balance_in", O.with_prelude(JANUARY, O.form101("1998-01-31", fanout=False), body="""
SELECT chapter, ledger_account, characteristic, CAST(balance_in_rub AS DOUBLE) AS balance_in_rub,
       CAST(balance_in_val AS DOUBLE) AS balance_in_val, CAST(balance_in_total AS DOUBLE) AS balance_in_total
FROM f101"""))
def f101_balance_in(spark, sf_dir):
    """A2 + P4/P5/P7: conditional opening-balance sums; NULL codes fall in neither rub nor val."""
    return _f101(bank(spark, sf_dir), "corrected").select(
        "chapter", "ledger_account", "characteristic", "balance_in_rub", "balance_in_val", "balance_in_total")


@register("f101_roll_forward", O.with_prelude(JANUARY, O.form101("1998-01-31"), body="""
SELECT chapter, ledger_account, characteristic, CAST(balance_out_rub AS DOUBLE) AS balance_out_rub,
       CAST(balance_out_val AS DOUBLE) AS balance_out_val, CAST(balance_out_total AS DOUBLE) AS balance_out_total
FROM f101"""))
def f101_roll_forward(spark, sf_dir):
    """Closing balance per characteristic."""
    return _f101(bank(spark, sf_dir), "faithful").select(
        "chapter", "ledger_account", "characteristic", "balance_out_rub", "balance_out_val", "balance_out_total")


@register("ledger_expr_join", O.with_prelude(body="""
SELECT s.ledger_account, s.chapter, a.account_rk, CAST(a.data_actual_date AS VARCHAR) AS data_actual_date
FROM md_ledger_account_s s
JOIN md_account_d a ON substr(a.account_number, 1, 5) = CAST(s.ledger_account AS VARCHAR)"""))
def ledger_expr_join(spark, sf_dir):
    """Ledger accounts joined to account versions on an expression of both sides."""
    b = bank(spark, sf_dir)
    led = b.md_ledger_account_s().select("ledger_account", "chapter",
                                         fm_digits(F.col("ledger_account")).alias("_k"))
    acc = b.md_account_d().select("account_rk", "data_actual_date",
                                  F.substring("account_number", 1, 5).alias("_k"))
    return acc.join(bounded_broadcast(led), "_k").select("ledger_account", "chapter", "account_rk", "data_actual_date")


@register("f101_null_r_cols", O.with_prelude(JANUARY, O.form101("1998-01-31"), body="""
SELECT ledger_account, characteristic, """ + ", ".join(f"CAST(NULL AS DOUBLE) AS r_{m}" for m in O.F101_MEASURES)
                                             + " FROM f101"))
def f101_null_r_cols(spark, sf_dir):
    """The twelve ``r_*`` columns are never filled."""
    return _f101(bank(spark, sf_dir), "faithful").select(
        "ledger_account", "characteristic", *[f"r_{m}" for m in O.F101_MEASURES])


@register("f101_mid_month", O.with_prelude(JANUARY, O.form101("1998-01-15"), body=O.f101_out()))
def f101_mid_month(spark, sf_dir):
    """L4 with a report date inside the month: dimensions and rates as of the 15th (the second
    version of a split account is not yet valid), turnover still over the whole month."""
    b = bank(spark, sf_dir)
    return f101_plan.f101(b.md_ledger_account_s(), b.md_account_d(), b.md_currency_d(), b.ft_balance_f(),
                          b.md_exchange_rate_d(), _turnover_month(b), dt.date(1998, 1, 15), "faithful")


@register("f101_fine_rates", O.with_prelude(
    O.FINE, O.turnover_of("1998-01-01", "1998-01-31", postings="ft_posting_fine", rates="md_rate_fine"),
    O.form101("1998-01-31", balances="ft_balance_fine", rates="md_rate_fine"), body=O.f101_out(rounded=True)))
def f101_fine_rates(spark, sf_dir):
    """L4 over the loader's doubles with 8-decimal rates and 3-decimal amounts: nothing is cut before the product."""
    b = FineBank(spark, sf_dir)
    return _f101(b, "faithful")


@register("turnover_fine_rates", O.with_prelude(
    O.FINE, O.turnover_of("1998-01-01", "1998-01-31", postings="ft_posting_fine", rates="md_rate_fine"),
    body=O.TURN_OUT + " FROM turnover"))
def turnover_fine_rates(spark, sf_dir):
    """L3 over the loader's doubles with 8-decimal rates and 3-decimal amounts."""
    return _turnover_month(FineBank(spark, sf_dir))


# ---------------------------------------------------------------- 4. min / max postings
@register("min_max_posting", O.with_prelude(O.day_extremes("1998-01-20"), body=O.EXTREMES_OUT))
def min_max_posting(spark, sf_dir):
    """The day's smallest and largest credit and debit postings in roubles, ties included."""
    b = bank(spark, sf_dir)
    return min_max.min_max_posting(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), MINMAX_DATE)


@register("min_max_asof", O.with_prelude(O.day_extremes("1998-01-20", asof=True), body=O.EXTREMES_OUT))
def min_max_asof(spark, sf_dir):
    """L5 with ``as_of=True``: accounts looked up as of the day, so split accounts do not double rows (Q4 fixed)."""
    b = bank(spark, sf_dir)
    return min_max.min_max_posting(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), MINMAX_DATE,
                                   as_of=True)


@register("min_max_fine_rates", O.with_prelude(
    O.FINE, O.day_extremes("1998-01-20", postings="ft_posting_fine", rates="md_rate_fine"), body=O.EXTREMES_OUT))
def min_max_fine_rates(spark, sf_dir):
    """L5 over the loader's doubles with 8-decimal rates and 3-decimal amounts."""
    b = FineBank(spark, sf_dir)
    return min_max.min_max_posting(b.ft_posting_f(), b.md_account_d(), b.md_exchange_rate_d(), MINMAX_DATE)


@register("min_max_ties", O.with_prelude("""m AS (
  SELECT * FROM ft_posting_f WHERE oper_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31')""", body="""
SELECT 'Min_credit' AS tag, CAST(oper_date AS VARCHAR) AS oper_date, credit_account_rk, debet_account_rk,
       CAST(credit_amount AS DOUBLE) AS credit_amount FROM m WHERE credit_amount = (SELECT min(credit_amount) FROM m)
UNION ALL
SELECT 'Max_credit', CAST(oper_date AS VARCHAR), credit_account_rk, debet_account_rk, CAST(credit_amount AS DOUBLE)
FROM m WHERE credit_amount = (SELECT max(credit_amount) FROM m)
UNION ALL
SELECT 'Min_day', CAST(oper_date AS VARCHAR), credit_account_rk, debet_account_rk, CAST(credit_amount AS DOUBLE)
FROM m WHERE oper_date = (SELECT min(oper_date) FROM m)"""))
def min_max_ties(spark, sf_dir):
    """All rows equal to an extreme; the earliest day of the month ties on many rows."""
    b = bank(spark, sf_dir)
    m = b.ft_posting_f().filter(F.col("oper_date").between(F.lit(MONTH_START), F.lit(REPORT_DATE)))
    out = extreme_rows(m, {"Min_credit": ("min", "credit_amount"), "Max_credit": ("max", "credit_amount"),
                           "Min_day": ("min", "oper_date")}, "tag")
    return out.select("tag", "oper_date", "credit_account_rk", "debet_account_rk", "credit_amount")


@register("double_lookup_coalesce", O.with_prelude(O.day_extremes("1998-01-20"), body="""
SELECT CAST(oper_date AS VARCHAR) AS oper_date, credit_account_rk, debet_account_rk,
       CAST(credit_amount AS DOUBLE) AS credit_amount, CAST(debet_amount AS DOUBLE) AS debet_amount,
       currency_rk, currency_code FROM day_postings"""))
def double_lookup_coalesce(spark, sf_dir):
    """J7 + P8: two left lookups of the same dimension without as-of; debit currency first."""
    b = bank(spark, sf_dir)
    return min_max.postings_with_currency(b.ft_posting_f(), b.md_account_d(), MINMAX_DATE)


# Part 2 registers itself into the same dictionaries.
from ledgerlake import queries_more, queries_storage  # noqa: E402,F401
