"""Smallest and largest postings of a day in roubles (L5, the reference's only table function).

Plan: the accounts are first reduced to those the day's postings name (a
semi-join against the day's key set), then looked up twice.

Semantics kept: the account lookup has **no** as-of filter, so an account
with several versions multiplies its postings (quirk Q4; ``as_of=True``
restricts to versions valid on the day); the currency is the debit
account's, else the credit account's (P8); the rate is as of the day and a
missing one counts as 1 (P6); ties all survive (X4); a row can sit in
several categories (U2).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.extremes import extreme_rows
from ledgerlake.operators.joins import asof_filter, bounded_broadcast
from ledgerlake.functions.scalars import dec
from ledgerlake.plans.turnover import AMOUNT, RATE

# The four result categories, in the reference's order.
CATEGORIES = {
    "Min_credit_amount_rub": ("min", "credit_amnt_rub"),
    "Max_credit_amount_rub": ("max", "credit_amnt_rub"),
    "Min_debet_amount_rub": ("min", "debet_amnt_rub"),
    "Max_debet_amount_rub": ("max", "debet_amnt_rub"),
}


def postings_with_currency(postings: DataFrame, accounts: DataFrame, on_date: dt.date,
                           as_of: bool = False) -> DataFrame:
    """``t1``: the day's postings with the debit account's currency, else the credit account's."""
    p = postings.filter(F.col("oper_date") == F.lit(on_date))
    acc = asof_filter(accounts, on_date, "data_actual_date", "data_actual_end_date") if as_of else accounts
    # semi-join reduction: only the accounts the day's postings name, so the account history is
    # shuffled at most once for one day (not at all where Spark finds the key set small)
    keys = p.select(F.explode(F.array("credit_account_rk", "debet_account_rk")).alias("account_rk")).distinct()
    acc = acc.join(keys, "account_rk", "left_semi")
    deb = acc.select(F.col("account_rk").alias("_d_rk"), F.col("currency_rk").alias("_d_cur"),
                     F.col("currency_code").alias("_d_code"))
    cre = acc.select(F.col("account_rk").alias("_c_rk"), F.col("currency_rk").alias("_c_cur"),
                     F.col("currency_code").alias("_c_code"))
    j = (p.join(deb, p.debet_account_rk == deb._d_rk, "left")
         .join(cre, F.col("credit_account_rk") == F.col("_c_rk"), "left"))
    return j.select("oper_date", "credit_account_rk", "debet_account_rk", "credit_amount", "debet_amount",
                    F.coalesce("_d_cur", "_c_cur").alias("currency_rk"),
                    F.coalesce("_d_code", "_c_code").alias("currency_code"))


def postings_in_rub(postings: DataFrame, accounts: DataFrame, rates: DataFrame, on_date: dt.date,
                    as_of: bool = False) -> DataFrame:
    """``t2``: amounts times the rate valid on the day (missing rate = 1), exact decimals."""
    t1 = postings_with_currency(postings, accounts, on_date, as_of)
    r = asof_filter(rates, on_date, "data_actual_date", "data_actual_end_date").select(
        F.col("currency_rk").alias("_r_cur"),
        dec(F.col("reduced_cource"), rates.schema["reduced_cource"].dataType, *RATE).alias("_rate"))
    j = t1.join(bounded_broadcast(r), t1.currency_rk == F.col("_r_cur"), "left")
    k = F.coalesce(F.col("_rate"), F.lit(1))
    c_amt = dec(F.col("credit_amount"), t1.schema["credit_amount"].dataType, *AMOUNT)
    d_amt = dec(F.col("debet_amount"), t1.schema["debet_amount"].dataType, *AMOUNT)
    return j.select(F.col("oper_date").alias("Entered_date"), F.col("credit_account_rk").alias("credit_accnt_rk"),
                    F.col("debet_account_rk").alias("debet_accnt_rk"), (c_amt * k).alias("credit_amnt_rub"),
                    (d_amt * k).alias("debet_amnt_rub"), F.col("currency_code").alias("currency"))


def min_max_posting(postings: DataFrame, accounts: DataFrame, rates: DataFrame, on_date: dt.date,
                    as_of: bool = False) -> DataFrame:
    """Rows: Category, Entered_date, credit_accnt_rk, debet_accnt_rk, credit_amnt_rub, debet_amnt_rub, currency."""
    t2 = postings_in_rub(postings, accounts, rates, on_date, as_of)
    out = extreme_rows(t2, CATEGORIES, "Category")
    return out.select("Category", "Entered_date", "credit_accnt_rk", "debet_accnt_rk",
                      F.col("credit_amnt_rub").cast("double").alias("credit_amnt_rub"),
                      F.col("debet_amnt_rub").cast("double").alias("debet_amnt_rub"), "currency")
