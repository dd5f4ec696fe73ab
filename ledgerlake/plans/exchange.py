"""CSV / parquet exchange (L6 export and import of form 101; W7-W10, W12, S11, S15).

A stored table is never written as a single file; only an export to a
person or another system goes to one part file (``single_file``), and that
is the only place a single task writes.  It is ``repartition(1)``, not
``coalesce(1)``: a coalesce would fold into the last stage and run the
scans and joins feeding the export in one task too; the repartition keeps
them parallel and moves only the result to the writer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.sinks import fs
from ledgerlake.sources.csv_files import enable_charset, read_csv_with_schema
from ledgerlake.sources.local import rows_frame

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def export_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True, single_file: bool = True,
               encoding: str = "utf-8") -> str:
    """``COPY ... TO ... CSV DELIMITER ';' HEADER``: NULL is an empty field, an empty text ``""``; fields with the
    separator, a quote or a line break are quoted, quotes in them doubled; blanks stay."""
    enable_charset(df.sparkSession, encoding)
    out = df.repartition(1) if single_file else df
    (out.write.mode("errorifexists").option("sep", sep).option("header", header).option("nullValue", "").option("emptyValue", '""')
     .option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    .option("encoding", encoding).option("dateFormat", "yyyy-MM-dd")
     .option("timestampFormat", TS_FMT).option("timestampNTZFormat", TS_FMT).csv(path))
    return path


def export_file(df: DataFrame, path: str, **options) -> str:
    """The export as one file of that very name (it is written aside and renamed)."""
    spark = df.sparkSession
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    export_csv(df, aside, **options)
    part, = [n for n in fs.list_names(spark, aside) if n.startswith("part-")]
    fs.rename(spark, f"{aside}/{part}", path)
    fs.delete(spark, aside)
    return path


def import_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", encoding: str = "utf-8") -> DataFrame:
    """``COPY ... FROM ... CSV HEADER`` into a table shaped like ``schema`` (columns by position)."""
    return read_csv_with_schema(spark, path, schema, sep=sep, header=True, encoding=encoding, timestamp_format=TS_FMT)


def like(spark: SparkSession, df: DataFrame) -> DataFrame:
    """An empty table with the structure of ``df``."""
    return rows_frame(spark, [], df.schema)


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> str:
    """W8 (single file only for an export)."""
    (df.repartition(1) if single_file else df).write.mode("errorifexists").parquet(path)
    return path
