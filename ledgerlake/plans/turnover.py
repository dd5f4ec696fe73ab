"""Daily account turnover mart (L2 one day, L3 a month) as one set-based job.

Reference semantics kept exactly:

* each posting gives a credit leg and a debit leg (U1);
* a leg counts only if its account has a version valid on the day **and**
  that version starts inside the day's month (P3, quirk Q2);
* the rate is the one valid on the day, a missing rate counts as 1 (P6);
* sums per (day, account), NULL sums become 0 (A1); a day without postings
  has no rows.

Plan shape (scale): the postings of the window are read once (filter pushed
into the scan), turned into legs with one ``inline`` generator, and pre-aggregated per
(day, account) *before* any join -- partial aggregation runs map-side, so a
hot account that holds a third of all postings sends one row per map task,
not a third of the data.  Multiplying by the rate after the sum is exact in
decimal arithmetic (``sum(a_i) * r = sum(a_i * r)``), and a version/rate
fan-out multiplies both forms alike.  The per-day rate lookup is a pure
equi-join on (currency, day), a broadcast if its estimated size allows,
so a currency holding most rows never meets in one task.  The account versions
of the window join as Spark sees fit (by bytes, at run time).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import py_month_bounds
from ledgerlake.functions.scalars import dec, mart_dec
from ledgerlake.operators.joins import bounded_broadcast, daily_rows

# Doubles of the detail layer become decimals that keep 8 decimals of an amount and 10 of a rate; a product keeps at
# least 13 decimals and is rounded once, to the mart's 8.
AMOUNT = (21, 8)
RATE = (16, 10)


def _amount(df: DataFrame, name: str):
    return dec(F.col(name), df.schema[name].dataType, *AMOUNT)


def posting_legs(postings: DataFrame, d_from: dt.date, d_to: dt.date) -> DataFrame:
    """U1 in one scan: (oper_date, account_rk, credit_amount, debet_amount), the other side NULL (P10)."""
    p = postings.filter(F.col("oper_date").between(F.lit(d_from), F.lit(d_to)))
    p = p.select("oper_date", "credit_account_rk", "debet_account_rk",
                 _amount(p, "credit_amount").alias("c"), _amount(p, "debet_amount").alias("d"))
    c_null = F.lit(None).cast(p.schema["c"].dataType)
    d_null = F.lit(None).cast(p.schema["d"].dataType)
    legs = F.array(
        F.struct(F.col("credit_account_rk").alias("account_rk"), F.col("c").alias("credit_amount"),
                 d_null.alias("debet_amount")),
        F.struct(F.col("debet_account_rk").alias("account_rk"), c_null.alias("credit_amount"),
                 F.col("d").alias("debet_amount")))
    return p.select("oper_date", F.inline(legs))


def accounts_for_window(accounts: DataFrame, d_from: dt.date, d_to: dt.date) -> DataFrame:
    """Versions that overlap the window and start inside a month the window touches (pre-filter for P3)."""
    lo, _ = py_month_bounds(d_from)
    _, hi = py_month_bounds(d_to)
    s, e = F.col("data_actual_date"), F.col("data_actual_end_date")
    return (accounts.filter(s.between(F.lit(lo), F.lit(hi)) & (s <= F.lit(d_to)) & (e >= F.lit(d_from)))
            .select("account_rk", s.alias("_start"), e.alias("_end"), "currency_rk"))


def _asof_in_month(day_col: str = "oper_date"):
    d = F.col(day_col)
    return (d.between(F.col("_start"), F.col("_end"))
            & F.col("_start").between(F.trunc(d, "MM"), F.last_day(d)))


def daily_rates(rates: DataFrame, d_from: dt.date, d_to: dt.date) -> DataFrame:
    """(currency_rk, oper_date, rate) for every day of the window a rate version covers."""
    r = daily_rows(rates, "data_actual_date", "data_actual_end_date", d_from, d_to, "oper_date")
    return r.select("currency_rk", "oper_date",
                    dec(F.col("reduced_cource"), rates.schema["reduced_cource"].dataType, *RATE).alias("_rate"))


def account_turnover(postings: DataFrame, accounts: DataFrame, rates: DataFrame,
                     d_from: dt.date, d_to: dt.date | None = None) -> DataFrame:
    """Turnover rows (on_date, account_rk, credit/debet amount and rub) for every day in [d_from, d_to]."""
    d_to = d_to or d_from
    legs = posting_legs(postings, d_from, d_to)
    pre = legs.groupBy("oper_date", "account_rk").agg(F.sum("credit_amount").alias("_c"),
                                                      F.sum("debet_amount").alias("_d"))
    pre = pre.select("oper_date", "account_rk", mart_dec(F.col("_c")).alias("_c"), mart_dec(F.col("_d")).alias("_d"))
    acc = accounts_for_window(accounts, d_from, d_to)
    day_rates = bounded_broadcast(daily_rates(rates, d_from, d_to))      # currencies x days of the window
    j = pre.join(acc, "account_rk").filter(_asof_in_month())
    j = j.join(day_rates, ["currency_rk", "oper_date"], "left")
    r = F.coalesce(F.col("_rate"), F.lit(1))
    agg = j.groupBy("oper_date", "account_rk").agg(
        F.sum("_c").alias("c"), F.sum(F.col("_c") * r).alias("cr"),
        F.sum("_d").alias("d"), F.sum(F.col("_d") * r).alias("dr"))
    z = F.lit(0)
    return agg.select(F.col("oper_date").alias("on_date"), "account_rk",
                      mart_dec(F.coalesce("c", z)).alias("credit_amount"),
                      mart_dec(F.coalesce("cr", z)).alias("credit_amount_rub"),
                      mart_dec(F.coalesce("d", z)).alias("debet_amount"),
                      mart_dec(F.coalesce("dr", z)).alias("debet_amount_rub"))


def turnover_legs(postings: DataFrame, accounts: DataFrame, rates: DataFrame,
                  d_from: dt.date, d_to: dt.date | None = None) -> DataFrame:
    """The reference's ``wt_turn`` rows before grouping: one row per matched leg."""
    d_to = d_to or d_from
    legs = posting_legs(postings, d_from, d_to)
    acc = accounts_for_window(accounts, d_from, d_to)
    day_rates = bounded_broadcast(daily_rates(rates, d_from, d_to))
    j = legs.join(acc, "account_rk").filter(_asof_in_month())
    j = j.join(day_rates, ["currency_rk", "oper_date"], "left")
    r = F.coalesce(F.col("_rate"), F.lit(1))
    return j.select(F.col("oper_date").alias("on_date"), "account_rk",
                    mart_dec(F.col("credit_amount")).alias("credit_amount"),
                    mart_dec(F.col("credit_amount") * r).alias("credit_amount_rub"),
                    mart_dec(F.col("debet_amount")).alias("debet_amount"),
                    mart_dec(F.col("debet_amount") * r).alias("debet_amount_rub"))


def month_turnover(postings: DataFrame, accounts: DataFrame, rates: DataFrame, date_to: dt.date) -> DataFrame:
    """L3: every day from the month start to ``date_to`` -- one job, days are independent."""
    start, _ = py_month_bounds(date_to)
    return account_turnover(postings, accounts, rates, start, date_to)
