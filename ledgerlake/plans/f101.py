"""Form 101 mart (L4): balances and turnovers per (chapter, ledger account, characteristic).

Semantics (all kept): dimensions as of the report date; opening balance from
the day before the month; rate as of the report date for opening balances;
turnover over the whole month.  RUB is ``currency_code IN ('643','810')``
with SQL three-valued logic, so a NULL code lands in neither rub nor val, but
the ``total`` expressions still convert it (P5).  Opening balances are not
coalesced (P7), turnovers are.

``fanout="faithful"`` reproduces quirk Q1: the reference left-joins every
turnover *day* of an account, so the opening balance is summed once per day.
We never materialise that fan-out: turnover is pre-aggregated per account
(sums + number of days ``n``) and the balance is weighted by
``greatest(n, 1)`` -- the same numbers, one row per account.
``fanout="corrected"`` weights it by 1.

Plan shape: accounts (as of the date), balances and the month's turnover all
join on ``account_rk`` -- one hash partitioning shared by the joins; ledger,
currency and rates are small dimensions, broadcast if their estimated size allows.
The final group has few keys and aggregates partially map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import py_month_bounds, py_prev_month_end
from ledgerlake.functions.scalars import dec, fm_digits, mart_dec, typed_null
from ledgerlake.operators.joins import asof_filter, bounded_broadcast
from ledgerlake.plans.turnover import AMOUNT, RATE
from ledgerlake.schemas import F101_COLUMNS

# Currency codes that count as roubles.
RUB_CODES = ("643", "810")


def _t1(ledger: DataFrame, accounts: DataFrame, currency: DataFrame, balances: DataFrame, rates: DataFrame,
        turnover: DataFrame, on_date: dt.date, fanout: str) -> DataFrame:
    ms, me = py_month_bounds(on_date)
    led = asof_filter(ledger, on_date, "start_date", "end_date").select(
        "chapter", fm_digits(F.col("ledger_account")).alias("_ledger"))
    acc = asof_filter(accounts, on_date, "data_actual_date", "data_actual_end_date").select(
        "account_rk", F.substring("account_number", 1, 5).alias("ledger_account"),
        F.col("char_type").alias("characteristic"), "currency_rk")
    cur = asof_filter(currency, on_date, "data_actual_date", "data_actual_end_date").select(
        "currency_rk", "currency_code")
    bal = balances.filter(F.col("on_date") == F.lit(py_prev_month_end(on_date))).select(
        "account_rk", dec(F.col("balance_out"), balances.schema["balance_out"].dataType, *AMOUNT).alias("_bal"))
    rate = asof_filter(rates, on_date, "data_actual_date", "data_actual_end_date").select(
        "currency_rk", dec(F.col("reduced_cource"), rates.schema["reduced_cource"].dataType, *RATE).alias("_rate"))
    turn = (turnover.filter(F.col("on_date").between(F.lit(ms), F.lit(me)))
            .groupBy("account_rk")
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("debet_amount_rub").alias("_deb"),
                 F.sum("credit_amount_rub").alias("_cre")))

    led, cur, rate = (bounded_broadcast(x) for x in (led, cur, rate))
    base = (acc.join(led, F.col("ledger_account") == F.col("_ledger"))
            .join(cur, "currency_rk")
            .join(bal, "account_rk", "left")
            .join(rate, "currency_rk", "left")
            .join(turn, "account_rk", "left"))

    if fanout == "faithful":
        k = F.greatest(F.coalesce(F.col("_n"), F.lit(0)), F.lit(1)).cast("decimal(4,0)")
    elif fanout == "corrected":
        k = F.lit(1).cast("decimal(4,0)")
    else:
        raise ValueError(f"fanout must be 'faithful' or 'corrected', not {fanout!r}")

    rub = F.col("currency_code").isin(*RUB_CODES)
    val = ~F.col("currency_code").isin(*RUB_CODES)
    bal_k = F.col("_bal") * k
    bal_rk = F.col("_bal") * F.col("_rate") * k
    z = F.lit(0)
    agg = base.groupBy("chapter", "ledger_account", "characteristic").agg(
        F.sum(F.when(rub, bal_k).otherwise(z)).alias("balance_in_rub"),
        F.sum(F.when(val, bal_rk).otherwise(z)).alias("balance_in_val"),
        F.sum(F.when(rub, bal_k).otherwise(bal_rk)).alias("balance_in_total"),
        F.coalesce(F.sum(F.when(rub, F.col("_deb")).otherwise(z)), z).alias("turn_deb_rub"),
        F.coalesce(F.sum(F.when(val, F.col("_deb")).otherwise(z)), z).alias("turn_deb_val"),
        F.coalesce(F.sum("_deb"), z).alias("turn_deb_total"),
        F.coalesce(F.sum(F.when(rub, F.col("_cre")).otherwise(z)), z).alias("turn_cre_rub"),
        F.coalesce(F.sum(F.when(val, F.col("_cre")).otherwise(z)), z).alias("turn_cre_val"),
        F.coalesce(F.sum("_cre"), z).alias("turn_cre_total"))
    # widths that leave the roll-forward's sums and differences room, so Spark does not shorten their scale
    wide = {c: F.col(c).cast("decimal(34,13)" if c.startswith("balance") else "decimal(28,8)").alias(c) for c in agg.columns[3:]}
    return agg.select(F.lit(ms).alias("from_date"), F.lit(me).alias("to_date"), *agg.columns[:3], *wide.values())


def roll_forward(t1: DataFrame) -> DataFrame:
    """Closing balances -- 'A': in - cre + deb, 'P': in + cre - deb, others NULL."""
    c = F.col("characteristic")

    def out(part: str):
        a = F.col(f"balance_in_{part}") - F.col(f"turn_cre_{part}") + F.col(f"turn_deb_{part}")
        p = F.col(f"balance_in_{part}") + F.col(f"turn_cre_{part}") - F.col(f"turn_deb_{part}")
        return a, p

    ra, rp = out("rub")
    va, vp = out("val")
    return t1.select(
        "*",
        F.when(c == "A", ra).when(c == "P", rp).alias("balance_out_rub"),
        F.when(c == "A", va).when(c == "P", vp).alias("balance_out_val"),
        F.when(c == "A", ra + va).when(c == "P", rp + vp).alias("balance_out_total"))


def f101(ledger: DataFrame, accounts: DataFrame, currency: DataFrame, balances: DataFrame, rates: DataFrame,
         turnover: DataFrame, on_date: dt.date, fanout: str = "faithful") -> DataFrame:
    """The full mart row set for the month of ``on_date`` (29 columns, ``r_*`` left NULL -- P16)."""
    t = roll_forward(_t1(ledger, accounts, currency, balances, rates, turnover, on_date, fanout))
    cols = []
    for name in F101_COLUMNS:
        if name in ("from_date", "to_date", "chapter", "ledger_account", "characteristic"):
            cols.append(F.col(name))
        elif name.startswith("r_"):
            cols.append(typed_null("decimal(23,8)").alias(name))
        else:
            cols.append(mart_dec(F.col(name)).alias(name))
    return t.select(*cols)
