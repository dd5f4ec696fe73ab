"""Table registry: declared schemas, primary keys and load specs.

The detail layer (``ds``) keeps the reference's column names.  Keys that the
reference stores as NUMERIC without precision are LongType; amounts and rates
arrive as doubles and are turned into decimals where marts compute with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

D = T.DateType()
L = T.LongType()
I = T.IntegerType()
S = T.StringType()
DBL = T.DoubleType()
MART_DEC = T.DecimalType(23, 8)


def _schema(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


FT_BALANCE_F = _schema(("on_date", D, False), ("account_rk", L, False), ("currency_rk", L, True),
                       ("balance_out", DBL, True))
FT_POSTING_F = _schema(("oper_date", D, False), ("credit_account_rk", L, False), ("debet_account_rk", L, False),
                       ("credit_amount", DBL, True), ("debet_amount", DBL, True))
MD_ACCOUNT_D = _schema(("data_actual_date", D, False), ("data_actual_end_date", D, False), ("account_rk", L, False),
                       ("account_number", S, False), ("char_type", S, False), ("currency_rk", L, False),
                       ("currency_code", S, False))
MD_CURRENCY_D = _schema(("currency_rk", L, False), ("data_actual_date", D, False), ("data_actual_end_date", D, True),
                        ("currency_code", S, True), ("code_iso_char", S, True))
MD_EXCHANGE_RATE_D = _schema(("data_actual_date", D, False), ("data_actual_end_date", D, True),
                             ("currency_rk", L, False), ("reduced_cource", DBL, True), ("code_iso_num", S, True))
MD_LEDGER_ACCOUNT_S = _schema(
    ("chapter", S, True), ("chapter_name", S, True), ("section_number", I, True), ("section_name", S, True),
    ("subsection_name", S, True), ("ledger1_account", I, True), ("ledger1_account_name", S, True),
    ("ledger_account", I, False), ("ledger_account_name", S, True), ("characteristic", S, True),
    ("is_resident", I, True), ("is_reserve", I, True), ("is_reserved", I, True), ("is_loan", I, True),
    ("is_reserved_assets", I, True), ("is_overdue", I, True), ("is_interest", I, True), ("pair_account", S, True),
    ("start_date", D, False), ("end_date", D, True), ("is_rub_only", I, True), ("min_term", S, True),
    ("min_term_measure", S, True), ("max_term", S, True), ("max_term_measure", S, True),
    ("ledger_acc_full_name_translit", S, True), ("is_revaluation", S, True), ("is_correct", S, True))

DM_ACCOUNT_TURNOVER_F = _schema(("on_date", D, True), ("account_rk", L, True), ("credit_amount", MART_DEC, True),
                                ("credit_amount_rub", MART_DEC, True), ("debet_amount", MART_DEC, True),
                                ("debet_amount_rub", MART_DEC, True))

# The form-101 mart: 12 measures are filled, their 12 ``r_`` twins never are.
F101_MEASURES = [f"{m}_{c}" for m in ("balance_in", "turn_deb", "turn_cre", "balance_out")
                 for c in ("rub", "val", "total")]
F101_COLUMNS = ["from_date", "to_date", "chapter", "ledger_account", "characteristic"] + [
    x for m in F101_MEASURES for x in (m, f"r_{m}")]
DM_F101_ROUND_F = _schema(("from_date", D, True), ("to_date", D, True), ("chapter", S, True),
                          ("ledger_account", S, True), ("characteristic", S, True),
                          *[(c, MART_DEC, True) for c in F101_COLUMNS[5:]])

DELTA_LOG = _schema(("started_at", T.TimestampType(), True), ("finished_at", T.TimestampType(), True),
                    ("delta_id", I, True), ("table_name", S, True))
DELTA_LOG_DDL = "started_at timestamp, finished_at timestamp, delta_id integer, table_name string"

LOG_INFO = _schema(("record_id", L, True), ("pipeline_run_id", L, True), ("date_time", T.TimestampType(), True),
                   ("event_type", S, True), ("message_", S, True), ("rows_affected", L, True),
                   ("message_type", I, True), ("app_id", S, True), ("user_name", S, True), ("info_", S, True))


@dataclass(frozen=True)
class TableSpec:
    """Load spec of one detail table (S14): name, schema, key, date handling."""

    name: str
    schema: T.StructType
    pk: tuple[str, ...]
    need_date_format: bool = False
    date_format: str | None = None
    by_day: bool = False                    # stored in parts of a day of the first key column, else of a key hash

    @property
    def column_names(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# Greatest lengths of text columns, the same in every table that has the column.
TEXT_LENGTHS = {
    "account_number": 20, "char_type": 1, "currency_code": 3, "code_iso_char": 3, "code_iso_num": 3, "chapter": 1,
    "chapter_name": 16, "section_name": 22, "subsection_name": 21, "ledger1_account_name": 47, "ledger_account_name": 153,
    "characteristic": 1, "pair_account": 5, "min_term": 1, "min_term_measure": 1, "max_term": 1, "max_term_measure": 1,
    "ledger_acc_full_name_translit": 1, "is_revaluation": 1, "is_correct": 1,
}

# The six detail tables, their keys and date handling, as configured by the reference's loader.
TABLES: dict[str, TableSpec] = {
    "md_ledger_account_s": TableSpec("md_ledger_account_s", MD_LEDGER_ACCOUNT_S, ("ledger_account", "start_date")),
    "md_exchange_rate_d": TableSpec("md_exchange_rate_d", MD_EXCHANGE_RATE_D, ("data_actual_date", "currency_rk")),
    "ft_balance_f": TableSpec("ft_balance_f", FT_BALANCE_F, ("on_date", "account_rk"), True, "dd.MM.yyyy", by_day=True),
    "ft_posting_f": TableSpec("ft_posting_f", FT_POSTING_F, ("oper_date", "credit_account_rk", "debet_account_rk"), by_day=True),
    "md_account_d": TableSpec("md_account_d", MD_ACCOUNT_D, ("data_actual_date", "account_rk")),
    "md_currency_d": TableSpec("md_currency_d", MD_CURRENCY_D, ("currency_rk", "data_actual_date")),
}
