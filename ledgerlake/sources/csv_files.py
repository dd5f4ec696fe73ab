"""Delimited-file sources.

``read_bank_file`` is the detail-table loader's reader (S1-S5):

* ``;`` separated, quoted fields, any Java charset (cp866 by default -- it
  needs ``spark.sql.legacy.javaCharsets``, which we switch on when asked for
  a non-standard charset);
* a record ends at a line break outside quotes, a doubled quote is a quote (as
  Python's ``csv`` reads them); files whose records stay within their lines are
  split over tasks, see ``spans_lines``;
* a record with fewer or more fields than the header fails the load like the
  INSERT of a wrong number of values did, in every mode but ``reject``, which
  routes it to the rejects with its text; blank lines are skipped;
* column 0 is a row number with a blank header: dropped *by position*; the
  file order used for "last row wins" comes from the file path, block and a
  per-task increasing id instead;
* names come from the header (case-insensitive), in the file's order (S2);
* empty text becomes NULL (S3);
* the first data column can be parsed with a date pattern (S4);
* every other value is cast to the declared type (S5).  With ANSI on a bad
  value fails the job like the database did; ``bad_values="null"`` uses
  ``try_cast`` and keeps the row with NULLs instead; ``bad_values="reject"``
  also uses ``try_cast`` and adds ``_raw`` (the row's text) so the loader can
  route such rows to a rejects table.  Every mode adds ``_bad``: names of the
  columns whose text did not convert or that break the table's NOT NULL and
  length constraints, or ``(width)`` for a record of the wrong width.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import TEXT_LENGTHS, TableSpec
from ledgerlake.sinks import fs

STANDARD_CHARSETS = {"utf-8", "utf8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"}
FILE_ORDER = "_file_order"
BAD, RAW = "_bad", "_raw"
WIDTH = "(width)"
# Stands for an unquoted empty field while a file is parsed: a Unicode noncharacter, which no text may hold.
NO_VALUE = "\ufdd0"


def enable_charset(spark: SparkSession, encoding: str) -> None:
    if encoding.lower() not in STANDARD_CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def file_order() -> Column:
    """Order of rows as they stand in the files: (path, block start, increasing id within the task)."""
    return F.struct(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("i"))


def spans_lines(spark: SparkSession, files: list[str], sep: str = ";", encoding: str = "utf-8") -> bool:
    """Whether records may run over several lines, so that a file cannot be split by lines.

    Files that are one split anyway are parsed as they are.  Larger ones are looked through as text (split over
    tasks): a record that goes on in the next line leaves a quote in its first line that closes no field.
    """
    if encoding.lower().startswith(("utf-16", "utf-32")) or fs.greatest_file(spark, files) <= _split_bytes(spark):
        return True
    return not spark.read.text(files).where(_goes_on(F.col("value"), sep)).isEmpty()


def _goes_on(line: Column, sep: str) -> Column:
    """Whether a line has a quote that closes no field.  Most lines have no quote at all: nothing is taken out of them."""
    left = F.regexp_replace(F.regexp_replace(line, '""', ""), f'(^|{sep})"[^"]*"(?={sep}|$)', "$1")
    return line.contains('"') & left.contains('"')


def _split_bytes(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def _quoted_reader(spark: SparkSession, files: list[str], sep: str, encoding: str):
    """A CSV reader with quotes as RFC 4180 has them, and one record a row whatever its line breaks."""
    enable_charset(spark, encoding)
    return (spark.read.option("sep", sep).option("encoding", encoding).option("quote", '"').option("escape", '"')
            .option("multiLine", spans_lines(spark, files, sep, encoding)))


def _cast(c: Column, t: T.DataType, strict: bool) -> Column:
    return c.cast(t) if strict else c.try_cast(t)


def read_bank_file(spark: SparkSession, path: str, spec: TableSpec, encoding: str = "cp866", sep: str = ";",
                   bad_values: str = "fail") -> DataFrame:
    """A detail file as typed columns of ``spec`` (only those present in the file) + ``_file_order``, ``_bad`` (, ``_raw``)."""
    files = fs.data_files(spark, path)
    headers = {h for h in (csv_header(spark, f, sep) for f in files) if h}
    if len(headers) != 1:
        raise ValueError(f"{path}: " + ("the files' headers differ" if headers else "no header"))
    file_cols = headers.pop()[1:]                     # column 0: row number, dropped by position
    declared = {f.name.lower(): f for f in spec.schema.fields}
    unknown = [c for c in file_cols if c.lower() not in declared]
    if unknown or len({c.lower() for c in file_cols}) < len(file_cols):
        raise ValueError(f"{spec.name}: columns not in the table: {unknown}" if unknown else f"{spec.name}: a column occurs twice in {file_cols}")
    if bad_values not in ("fail", "null", "reject"):
        raise ValueError(f"bad_values must be 'fail', 'null' or 'reject', not {bad_values!r}")
    names = [f"_{i}" for i in range(len(file_cols) + 1)]
    raw = (_quoted_reader(spark, files, sep, encoding).schema(T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_record"]]))
           .option("header", True).option("columnNameOfCorruptRecord", "_record").option("columnPruning", False).csv(files))
    ragged = F.col("_record").isNotNull()
    strict = bad_values == "fail"
    out, failed, texts = [], [F.when(ragged, F.lit(WIDTH))], []
    for i, c in enumerate(file_cols):
        f = declared[c.lower()]
        text = F.nullif(F.col(names[i + 1]), F.lit(""))
        good = F.when(~ragged, text)                  # the fields of a ragged record belong to no column
        if i == 0 and spec.need_date_format:
            v = F.to_date(good, spec.date_format) if strict else F.try_to_date(good, F.lit(spec.date_format))
        else:
            v = _cast(good, f.dataType, strict)
        out.append(v.alias(f.name))
        broken = (text.isNotNull() & v.isNull()) if bad_values == "reject" else F.lit(False)
        if not f.nullable:
            broken = broken | v.isNull()
        if f.name in TEXT_LENGTHS:
            broken = broken | F.coalesce(F.length(v) > TEXT_LENGTHS[f.name], F.lit(False))
        failed.append(F.when(~ragged & broken, F.lit(f.name)))
        texts.append(F.when(~ragged, text).alias(f.name))
    extra = [F.filter(F.array(*failed), lambda x: x.isNotNull()).alias(BAD)]
    if bad_values == "reject":
        extra.append(F.struct(*texts, F.col("_record").alias(WIDTH)).alias(RAW))
    return raw.select(*out, file_order().alias(FILE_ORDER), *extra)


def csv_header(spark: SparkSession, path: str, sep: str = ";") -> tuple[str, ...]:
    """Column names in a file's first line."""
    names = next(csv.reader([fs.first_line(spark, path)], delimiter=sep), [])
    return tuple(n.strip() for n in names)


def read_delta_csv(spark: SparkSession, paths: list[str] | str, date_format: str = "dd.MM.yyyy",
                   timestamp_format: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """``;`` CSV with header, dates in ``date_format``; types by ``schema`` (in the files' column order) or inferred."""
    files = [f for p in ([paths] if isinstance(paths, str) else paths) for f in fs.data_files(spark, p)]
    r = _quoted_reader(spark, files, ";", "utf-8").option("header", True).option("dateFormat", date_format).option("mode", "FAILFAST")
    r = r.option("columnPruning", False)              # every record is held against the whole header, whatever is selected
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return r.csv(paths)


def read_deltas(spark: SparkSession, files: list[str], declared: T.StructType, keys: list[str], positional: bool = False,
                **options) -> tuple[DataFrame, T.StructType]:
    """Delta files with different headers as one frame of the declared types, and the schema with the columns they add.

    Files are grouped by header (read as metadata); each group is read with the declared types in its own column
    order and united by name (case-insensitively).  A column nobody declared is added as text; a header without a
    key column, or with a name twice, is an error.  ``positional``: the columns are the declared ones in order,
    whatever the header calls them, and their number must agree.  ``_file`` is the path of a row's file.
    """
    known = {f.name.lower(): f for f in declared.fields}
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        groups.setdefault(csv_header(spark, f), []).append(f)
    added: dict[str, T.StructField] = {}
    frames = []
    for header, paths in groups.items():
        names = [n.lower() for n in header]
        if positional:
            if len(names) != len(declared.fields):
                raise ValueError(f"positional union needs {len(declared.fields)} delta columns, got {len(names)} ({paths[0]})")
            fields = list(declared.fields)
        else:
            missing = [k for k in keys if k.lower() not in names]
            if missing or len(set(names)) != len(names):
                raise ValueError(f"header {header} of {paths[0]}: " + (f"no key column {missing}" if missing else "a name occurs twice"))
            fields = [known.get(n) or added.setdefault(n, T.StructField(h, T.StringType())) for n, h in zip(names, header, strict=True)]
        read = read_delta_csv(spark, paths, schema=T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]), **options)
        frames.append(read.withColumn("_file", F.col("_metadata.file_path")))
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out, T.StructType([*declared.fields, *added.values()])


def read_csv_with_schema(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";",
                         header: bool = True, encoding: str = "utf-8", timestamp_format: str | None = None) -> DataFrame:
    """Declared schema, columns by position (the header line is skipped, not matched), as ``COPY ... CSV`` reads.

    An unquoted empty field is NULL, a quoted one the empty text; blanks stay; a record of another width or a value
    that does not convert is an error.
    """
    r = (_quoted_reader(spark, fs.data_files(spark, path), sep, encoding).schema(schema).option("header", header)
         .option("enforceSchema", True).option("nullValue", NO_VALUE).option("emptyValue", "").option("mode", "FAILFAST")
         .option("columnPruning", False).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    return r.csv(path)


def read_plain_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Header, all columns as strings."""
    return _quoted_reader(spark, fs.data_files(spark, path), sep, "utf-8").option("header", True).csv(path)
