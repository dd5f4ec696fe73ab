"""Bank detail tables derived from the TPC-H-style test tables (FIXTURES.md §3).

Every frame here is a lazy plan over the parquet scans, so filters placed on
top of them (a month of postings, a report date) reach the scan.  The rules
(which accounts get two versions, which currencies have no rate, ...) are the
fixture's; the oracle SQL in ``ledgerlake.oracle`` spells out the same rules.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.calendar import month_end, month_start

# Fixed values of the fixture: the report month and the balance date before it.
REPORT_DATE = dt.date(1998, 1, 31)
MONTH_START = dt.date(1998, 1, 1)
BALANCE_DATE = dt.date(1997, 12, 31)
ACCOUNT_OPEN_EARLY = (dt.date(1997, 6, 1), dt.date(1998, 12, 31))
SPLIT_DAY = dt.date(1998, 1, 15)
OPEN_DIM = (dt.date(1990, 1, 1), dt.date(2050, 12, 31))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def currency_code_of(rk: Column) -> Column:
    """Fixture rule: nation 0 -> '643', 1 -> '810', 2 -> NULL, else 100+key."""
    return (F.when(rk == 0, F.lit("643")).when(rk == 1, F.lit("810")).when(rk == 2, F.lit(None).cast("string"))
            .otherwise((F.lit(100) + rk).cast("string")))


def _memo(fn):
    @functools.wraps(fn)
    def wrapper(self):
        key = fn.__name__
        if key not in self._plans:
            self._plans[key] = fn(self)
        return self._plans[key]
    return wrapper


@dataclass
class BankTables:
    """Lazy bank detail tables over one scale-factor directory."""

    spark: SparkSession
    sf_dir: str
    month: dt.date = MONTH_START
    _plans: dict = field(default_factory=dict, repr=False)

    def raw(self, name: str) -> DataFrame:
        """The scan of one test table; one DataFrame per table and instance (plans only, no data cached)."""
        if name not in self._plans:
            self._plans[name] = read_table(self.spark, self.sf_dir, name)
        return self._plans[name]

    # -- bank_party: suppliers are active ('A') accounts, customers passive ('P') ones
    @_memo
    def bank_party(self) -> DataFrame:
        s = self.raw("supplier").select(
            F.col("s_suppkey").cast("bigint").alias("account_rk"), F.col("s_nationkey").alias("currency_rk"),
            F.lit("A").alias("char_type"), F.col("s_acctbal").cast("decimal(12,2)").alias("acctbal"))
        c = self.raw("customer").select(
            (F.lit(1000000) + F.col("c_custkey")).cast("bigint").alias("account_rk"),
            F.col("c_nationkey").alias("currency_rk"), F.lit("P").alias("char_type"),
            F.col("c_acctbal").cast("decimal(12,2)").alias("acctbal"))
        return s.unionByName(c)

    @_memo
    def md_account_d(self) -> DataFrame:
        """SCD2 account versions: %10=0 opened early, %10=1 split in two, others one version in the month."""
        p = self.bank_party()
        m = F.col("account_rk") % 10
        ms, me = month_start(F.lit(self.month)), month_end(F.lit(self.month))
        vers = F.when(m == 0, F.array(F.struct(F.lit(ACCOUNT_OPEN_EARLY[0]).alias("s"),
                                               F.lit(ACCOUNT_OPEN_EARLY[1]).alias("e"))))
        vers = vers.when(m == 1, F.array(F.struct(ms.alias("s"), F.lit(SPLIT_DAY).alias("e")),
                                         F.struct(F.date_add(F.lit(SPLIT_DAY), 1).alias("s"), me.alias("e"))))
        vers = vers.otherwise(F.array(F.struct(ms.alias("s"), me.alias("e"))))
        v = p.select("*", F.explode(vers).alias("v"))
        return v.select(
            F.col("v.s").alias("data_actual_date"), F.col("v.e").alias("data_actual_end_date"), "account_rk",
            F.concat((F.lit(10000) + F.col("account_rk") % 18).cast("string"),
                     F.lpad(F.col("account_rk").cast("string"), 15, "0")).alias("account_number"),
            "char_type", "currency_rk", currency_code_of(F.col("currency_rk")).alias("currency_code"))

    @_memo
    def md_currency_d(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("currency_rk"), F.lit(OPEN_DIM[0]).alias("data_actual_date"),
            F.lit(OPEN_DIM[1]).alias("data_actual_end_date"),
            currency_code_of(F.col("n_nationkey")).alias("currency_code"))

    @_memo
    def calendar(self) -> DataFrame:
        """Business days of the month: days with an order or a shipment."""
        lo, hi = self.month, month_end_py(self.month)
        o = (self.raw("orders").select(F.col("o_orderdate").cast("date").alias("d"))
             .filter(F.col("d").between(lo, hi)))
        li = (self.raw("lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
              .filter(F.col("d").between(lo, hi)))
        return o.union(li).distinct()

    @_memo
    def md_exchange_rate_d(self) -> DataFrame:
        """One rate per currency and business day; currencies 0, 1 (roubles) and 5 have none.

        Every currency gets the days of the month from a generator (no join),
        and a semi-join on the date keeps the business days -- an equi-join
        against at most 31 calendar rows, never a cartesian product.
        """
        lo, hi = self.month, month_end_py(self.month)
        n = (self.raw("nation").select(F.col("n_nationkey").alias("currency_rk"))
             .filter(~F.col("currency_rk").isin(0, 1, 5))
             .select("currency_rk", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("d")))
        days = n.join(self.calendar(), "d", "left_semi")
        rate = (F.col("currency_rk").cast("decimal(6,2)") * F.lit(0.50).cast("decimal(4,2)")
                + F.dayofmonth("d").cast("decimal(6,2)") * F.lit(0.01).cast("decimal(4,2)") + F.lit(1))
        return days.select(
            F.col("d").alias("data_actual_date"), F.col("d").alias("data_actual_end_date"), "currency_rk",
            rate.cast("decimal(10,4)").alias("reduced_cource"))

    @_memo
    def ft_balance_f(self) -> DataFrame:
        return (self.bank_party().filter(F.col("account_rk") % 7 != 3)
                .select(F.lit(BALANCE_DATE).alias("on_date"), "account_rk", "currency_rk",
                        F.col("acctbal").alias("balance_out")))

    def ft_posting_f(self, order_status: str | None = None) -> DataFrame:
        """Postings: supplier credit, customer debit, one per line item; ``order_status`` keeps only
        the lines of orders in that status (a partial first load)."""
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_linenumber",
                                         F.col("l_shipdate").cast("date").alias("oper_date"))
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        if order_status is not None:
            o = o.filter(F.col("o_orderstatus") == order_status)
        amt = F.col("l_extendedprice").cast("decimal(12,2)")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            "oper_date", F.col("l_suppkey").cast("bigint").alias("credit_account_rk"),
            (F.lit(1000000) + F.col("o_custkey")).cast("bigint").alias("debet_account_rk"),
            amt.alias("credit_amount"), (amt + F.col("l_linenumber").cast("decimal(12,2)")).alias("debet_amount"))

    @_memo
    def md_ledger_account_s(self) -> DataFrame:
        r = F.col("account_rk") % 18
        return self.bank_party().select(
            (F.lit(10000) + r).alias("ledger_account"),
            F.when(r < 9, F.lit("A")).otherwise(F.lit("B")).alias("chapter"),
            F.lit(OPEN_DIM[0]).alias("start_date"), F.lit(OPEN_DIM[1]).alias("end_date")).distinct()


class FineBank(BankTables):
    """The same bank with 3-decimal amounts and small 8-decimal rates, as the doubles a detail file loads as."""

    def _milli(self, amount: str, extra: Column) -> Column:
        return (F.col(amount) + extra.cast("decimal(4,0)") * F.lit(0.001).cast("decimal(4,3)")).cast("double").alias(amount)

    def ft_posting_f(self, order_status: str | None = None) -> DataFrame:
        p = super().ft_posting_f(order_status)
        return p.select("oper_date", "credit_account_rk", "debet_account_rk",
                        self._milli("credit_amount", F.col("credit_account_rk") % 10),
                        self._milli("debet_amount", F.col("debet_account_rk") % 9 + 1))

    def ft_balance_f(self) -> DataFrame:
        return super().ft_balance_f().select("on_date", "account_rk", "currency_rk",
                                             self._milli("balance_out", F.col("account_rk") % 10))

    def md_exchange_rate_d(self) -> DataFrame:
        r = super().md_exchange_rate_d()
        small = (F.col("reduced_cource") * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(12,8)")
        tail = ((F.col("currency_rk") * 1237 + F.dayofmonth("data_actual_date") * 7919).cast("decimal(8,0)")
                * F.lit(0.00000001).cast("decimal(9,8)"))
        return r.select("data_actual_date", "data_actual_end_date", "currency_rk", (small + tail).cast("double").alias("reduced_cource"))


def month_end_py(d: dt.date) -> dt.date:
    nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return nxt - dt.timedelta(days=1)
