"""Detail-table load (L1): delimited file -> typed rows -> upsert into the stored table.

The file is parsed once: its checked rows (``_bad`` names the columns of a row
that do not convert or break NOT NULL or a length) are staged, counted (A7) and
merged from there, and the staged rows are removed.  Facts are stored in parts
of a day, dimensions in buckets of a key hash that split as they grow.  Only
segments that hold a key of the file are read, upserted and rewritten, rows of
new keys are appended (``sinks.parts``); the switch is atomic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.upsert import upsert
from ledgerlake.schemas import TableSpec
from ledgerlake.sinks.parts import Merged, PartsTable, bucket_in, directory_of
from ledgerlake.sinks.staging import staged
from ledgerlake.sources.csv_files import BAD, FILE_ORDER, RAW, read_bank_file

BUCKETS = 1                # of a new table; they split as it grows


class ConstraintError(ValueError):
    """Rows of a file break the table's constraints."""


@dataclass
class LoadOutcome:
    table: str
    rows_in_file: int
    version: int
    rows_rejected: int = 0
    merged: Merged | None = None


def part_of(spec: TableSpec) -> Column:
    """The part of a row in a table that is written whole."""
    return F.col(spec.pk[0]) if spec.by_day else bucket_in(F.xxhash64(*spec.pk), directory_of(BUCKETS))


def detail_table(spark: SparkSession, spec: TableSpec, store_base: str) -> PartsTable:
    return PartsTable(spark, store_base, spec.schema)


def load_table(spark: SparkSession, spec: TableSpec, path: str, store_base: str, encoding: str = "cp866",
               bad_values: str = "fail") -> LoadOutcome:
    """``bad_values``: "fail" (a bad value fails the load), "null" (it becomes NULL) or "reject" (the row
    goes to ``<store_base>_rejects`` with its text and the failing columns; the other rows load).
    A row that breaks NOT NULL or a length fails the load, or is rejected with "reject"."""
    store = detail_table(spark, spec, store_base)
    with staged(read_bank_file(spark, path, spec, encoding=encoding, bad_values=bad_values), "load") as batch:
        bad = F.size(BAD) > 0
        counts = batch.groupBy(bad.alias("bad")).agg(
            F.count(F.lit(1)).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(BAD)))).alias("columns")).collect()
        rows_bad = sum(r["n"] for r in counts if r["bad"])
        if rows_bad and bad_values != "reject":
            columns = sorted({c for r in counts if r["bad"] for c in r["columns"]})
            raise ConstraintError(f"{spec.name}: {rows_bad} rows break NOT NULL or a length, or have the wrong width, in {', '.join(columns)}")
        if rows_bad:
            batch.filter(bad).select(F.lit(spec.name).alias("table_name"), F.col(f"{FILE_ORDER}.p").alias("file"),
                                     F.col(BAD).alias("bad_columns"), F.to_json(RAW).alias("row_text")) \
                .write.mode("append").parquet(f"{store_base}_rejects")
        good = batch.filter(~bad).drop(BAD, RAW) if rows_bad else batch.drop(BAD, RAW)
        pk = list(spec.pk)
        merged = store.merge(good, pk, lambda old, new: upsert(old, new, pk, F.col(FILE_ORDER)), F.col(pk[0]) if spec.by_day else None,
                             schema=spec.schema, buckets=BUCKETS)
    return LoadOutcome(spec.name, sum(r["n"] for r in counts), merged.version, rows_bad, merged)
