"""Amounts and rates keep their decimals until the mart rounds once."""

import datetime as dt
from decimal import Decimal

from ledgerlake.plans import f101, min_max, turnover

DAY = dt.date(2018, 1, 20)
OPEN = (dt.date(2018, 1, 1), dt.date(2018, 1, 31))


def _tables(spark):
    postings = spark.createDataFrame([(DAY, 1, 2, 1_000_000.0, 10.555), (DAY, 1, 2, 0.001, 0.0)],
                                     "oper_date date, credit_account_rk long, debet_account_rk long, credit_amount double, debet_amount double")
    accounts = spark.createDataFrame([(*OPEN, rk, "40817" + str(rk).zfill(15), "A", 7, "156") for rk in (1, 2)],
                                     "data_actual_date date, data_actual_end_date date, account_rk long, account_number string, "
                                     "char_type string, currency_rk long, currency_code string")
    rates = spark.createDataFrame([(*OPEN, 7, 0.00251234)], "data_actual_date date, data_actual_end_date date, currency_rk long, reduced_cource double")
    return postings, accounts, rates


def test_turnover_keeps_small_rates_and_third_decimals(spark):
    rows = {r["account_rk"]: r for r in turnover.account_turnover(*_tables(spark), DAY).collect()}
    assert rows[1]["credit_amount"] == Decimal("1000000.001") and rows[1]["credit_amount_rub"] == Decimal("2512.34000251")
    assert rows[2]["debet_amount"] == Decimal("10.555") and rows[2]["debet_amount_rub"] == Decimal("0.02651775")


def test_min_max_keeps_small_rates(spark):
    out = {r["Category"]: r for r in min_max.min_max_posting(*_tables(spark), DAY).collect()}
    assert out["Max_credit_amount_rub"]["credit_amnt_rub"] == 2512.34
    assert out["Min_credit_amount_rub"]["credit_amnt_rub"] == 0.00000251234


def test_f101_keeps_small_rates_and_third_decimals_of_balances(spark):
    postings, accounts, rates = _tables(spark)
    ledger = spark.createDataFrame([("A", 40817, *OPEN)], "chapter string, ledger_account int, start_date date, end_date date")
    currency = spark.createDataFrame([(7, *OPEN, "156")], "currency_rk long, data_actual_date date, data_actual_end_date date, currency_code string")
    balances = spark.createDataFrame([(dt.date(2017, 12, 31), 1, 7, 1_000_000.125)], "on_date date, account_rk long, currency_rk long, balance_out double")
    turn = turnover.month_turnover(postings, accounts, rates, OPEN[1])
    (row,) = f101.f101(ledger, accounts, currency, balances, rates, turn, OPEN[1]).collect()
    assert row["balance_in_val"] == Decimal("2512.34031404")
    assert row["turn_cre_val"] == Decimal("2512.34000251") and row["turn_deb_total"] == Decimal("0.02651775")
