"""L5 in SQL: the min/max report of a day as a table function, ``SELECT * FROM min_max_posting(DATE '...')``.

The function is a SQL body over three tables or views of the detail layer, so Catalyst
inlines it: the day reaches the scans as a filter, and the plan is that of
``plans.min_max`` (accounts reduced to those that the day's postings name, the extremes
as one aggregate).  Its rows equal ``min_max_posting``'s: accounts without an as-of
filter (Q4), the debit account's currency before the credit account's (P8), a missing
rate as 1 (P6), all ties (X4), a row in several categories (U2).

The extremes meet their postings in an equi-join on (side, amount); the side of the
extremes has at most four rows.  A day without postings, or a null day, gives no rows.
The day is a constant expression: Spark refuses the column of another table (a lateral
join) in it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ledgerlake.plans.min_max import CATEGORIES
from ledgerlake.plans.turnover import AMOUNT, RATE

_SIDES = {"credit_amnt_rub": "credit", "debet_amnt_rub": "debet"}


def _exact(column: str, schema: T.StructType, precision: int, scale: int) -> str:
    """The column as DECIMAL; one that is a decimal already stays as it is."""
    return column if isinstance(schema[column].dataType, T.DecimalType) else f"CAST({column} AS DECIMAL({precision}, {scale}))"


def create_min_max_posting(spark: SparkSession, postings: str = "ft_posting_f", accounts: str = "md_account_d",
                           rates: str = "md_exchange_rate_d", name: str = "min_max_posting") -> None:
    """Create (or replace) the session's table function ``name(on_date DATE)`` over the named tables or views."""
    amounts, rate = spark.table(postings).schema, spark.table(rates).schema
    day = f"{name}.on_date"
    extremes = ", ".join(f"named_struct('category', '{c}', 'side', '{_SIDES[column]}', 'amount', {agg}({_SIDES[column]}))"
                         for c, (agg, column) in CATEGORIES.items())
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(on_date DATE)
RETURNS TABLE (Category STRING, Entered_date DATE, credit_accnt_rk BIGINT, debet_accnt_rk BIGINT,
  credit_amnt_rub DOUBLE, debet_amnt_rub DOUBLE, currency STRING)
RETURN
  WITH posted AS (SELECT * FROM {postings} WHERE oper_date = {day}),
  named AS (SELECT DISTINCT rk FROM posted LATERAL VIEW explode(array(credit_account_rk, debet_account_rk)) k AS rk),
  account AS (SELECT account_rk, currency_rk, currency_code FROM {accounts} LEFT SEMI JOIN named ON account_rk = rk),
  valid_rate AS (SELECT currency_rk, {_exact("reduced_cource", rate, *RATE)} AS rate FROM {rates}
    WHERE {day} BETWEEN data_actual_date AND data_actual_end_date),
  roubles AS (
    SELECT oper_date, credit_account_rk, debet_account_rk, coalesce(d.currency_code, c.currency_code) AS currency,
      {_exact("credit_amount", amounts, *AMOUNT)} * coalesce(rate, 1) AS credit,
      {_exact("debet_amount", amounts, *AMOUNT)} * coalesce(rate, 1) AS debet
    FROM posted LEFT JOIN account d ON d.account_rk = debet_account_rk
    LEFT JOIN account c ON c.account_rk = credit_account_rk
    LEFT JOIN valid_rate r ON r.currency_rk = coalesce(d.currency_rk, c.currency_rk)),
  extreme AS (
    SELECT side, amount, collect_set(category) AS categories
    FROM (SELECT inline(array({extremes})) AS (category, side, amount) FROM roubles)
    GROUP BY side, amount)
  SELECT category, oper_date, credit_account_rk, debet_account_rk, CAST(credit AS DOUBLE), CAST(debet AS DOUBLE), currency
  FROM (SELECT *, explode(map('credit', credit, 'debet', debet)) AS (side, amount) FROM roubles) m
  JOIN extreme USING (side, amount) LATERAL VIEW explode(categories) e AS category""")
