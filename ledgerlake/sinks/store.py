"""Versioned parquet tables: atomic replace without a table format.

A table is a folder of versions ``v=000001/``, ``v=000002/``...  A writer
writes the next version with Spark's commit protocol (the ``_SUCCESS``
marker appears only after the job committed); readers take the highest
committed version.  So a job may read version n while writing n+1 -- the
reference's "overwrite the file I am reading" (Q7) cannot happen -- and a
failed or killed write leaves no committed marker and is ignored.

Old versions stay until ``prune(keep)`` removes all but the newest ``keep``
committed ones (and dead folders below them).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sinks import fs
from ledgerlake.sinks.parts import PartsTable
from ledgerlake.sources.local import rows_frame

MARK = "_SUCCESS"


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | None = None):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema

    def _folders(self) -> list[int]:
        return sorted(int(n[2:]) for n in fs.list_names(self.spark, self.base) if n.startswith("v=") and n[2:].isdigit())

    def versions(self) -> list[int]:
        """Committed versions (their ``_SUCCESS`` marker exists)."""
        return [v for v in self._folders() if fs.exists(self.spark, f"{self.path(v)}/{MARK}")]

    def current(self) -> int | None:
        """Newest committed version: folders are scanned from the newest down (usually one lookup)."""
        for v in reversed(self._folders()):
            if fs.exists(self.spark, f"{self.path(v)}/{MARK}"):
                return v
        return None

    def prune(self, keep: int = 2) -> list[int]:
        """Remove committed versions older than the newest ``keep`` (and dead folders below them).

        Readers still on a removed version would fail, so ``keep`` must cover
        the longest-running reader; 2 keeps the previous version for them.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        committed = self.versions()
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        gone = [v for v in self._folders() if v < oldest_kept]
        for v in gone:
            fs.delete(self.spark, self.path(v))
        return gone

    def path(self, version: int) -> str:
        return f"{self.base}/v={version:06d}"

    def exists(self) -> bool:
        return self.current() is not None

    def read(self) -> DataFrame:
        v = self.current()
        if v is None:
            if self.schema is None:
                raise FileNotFoundError(f"no committed version under {self.base}")
            return rows_frame(self.spark, [], self.schema)
        r = self.spark.read
        if self.schema is not None:
            r = r.schema(self.schema)
        return r.parquet(self.path(v))

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write ``df`` as the next version and return its number.

        The number skips every existing folder, committed or not, so a write
        that died half-way (no ``_SUCCESS``) is simply left behind and ignored.
        """
        folders = self._folders()
        v = (folders[-1] if folders else 0) + 1
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(v))
        return v


class AppendLog:
    """Append-only parquet log (W5/W6): each write adds files, nothing is rewritten."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema

    def read(self) -> DataFrame:
        if not fs.exists(self.spark, self.base):
            return rows_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.base)

    def append(self, df: DataFrame) -> None:
        df.select(*[f.name for f in self.schema.fields]).write.mode("append").parquet(self.base)


class PartitionedTable:
    """A parquet table in parts of one day each, replaced one range of days at a time.

    For marts that grow with time (turnover: accounts x days) a full rewrite
    per reload does not scale.  ``replace_range`` writes the days of ``[lo, hi]``
    anew and switches to them in one step (``PartsTable``): days of the range
    without new rows end empty (W2), rows outside it are an error, other days
    keep their files.
    """

    def __init__(self, spark: SparkSession, base: str, part_col: str, schema: T.StructType | None = None):
        self.part_col, self.table = part_col, PartsTable(spark, base, schema)

    def read(self, lo=None, hi=None) -> DataFrame:
        """The table, or only the days from ``lo`` to ``hi``."""
        if lo is None and hi is None:
            return self.table.read()
        days = [p for p in self.table.parts() if (lo is None or p >= lo.isoformat()) and (hi is None or p <= hi.isoformat())]
        return self.table.read(days)

    def replace_range(self, new_rows: DataFrame, lo, hi) -> int:
        """Returns the number of rows written (seen on the write itself, A7)."""
        return self.replace_days(new_rows, [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)])

    def replace_days(self, new_rows: DataFrame, days: list[dt.date]) -> int:
        """The same for single days."""
        self.table.replace(new_rows, F.col(self.part_col), [d.isoformat() for d in days])
        return self.table.rows_written
