"""Delta-session discovery (S13) and the one-time JDBC seed of a mirror.

Two folder layouts are understood:

* ``"numbered"`` (the reference's): ``<base>/<id>/<table>.csv`` for id 1000,
  ``<base>/<id>/<table>_<id-1000>.csv`` otherwise;
* ``"partitioned"`` (what Spark writes with ``partitionBy("delta_id")``):
  ``<base>/delta_id=<id>/part-*.csv``.

Ids are sorted numerically (the reference used listing order, quirk Q5).  A
numbered folder whose expected file is missing stays pending and is reported
with ``file=None`` (Q11).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks import fs
from ledgerlake.sources.local import rows_frame

# Fixed value: the id of the first delta session; its file carries no suffix.
FIRST_DELTA_ID = 1000


@dataclass(frozen=True)
class DeltaSession:
    delta_id: int
    folder: str
    file: str | None


def expected_file(table: str, delta_id: int) -> str:
    return f"{table}.csv" if delta_id == FIRST_DELTA_ID else f"{table}_{delta_id - FIRST_DELTA_ID}.csv"


def discover(spark: SparkSession, base: str, table: str, layout: str = "numbered") -> list[DeltaSession]:
    """Delta sessions under ``base`` in numeric order (metadata only: folder names)."""
    base = base.rstrip("/")
    out = []
    for name in fs.list_dirs(spark, base):
        if layout == "partitioned":
            if not name.startswith("delta_id="):
                continue
            did, folder = int(name.split("=", 1)[1]), f"{base}/{name}"
            out.append(DeltaSession(did, folder, folder))
        else:
            if not name.isdigit():
                continue
            did, folder = int(name), f"{base}/{name}"
            f = expected_file(table, did)
            out.append(DeltaSession(did, folder, f"{folder}/{f}" if fs.exists(spark, f"{folder}/{f}") else None))
    return sorted(out, key=lambda s: s.delta_id)


def data_files(spark: SparkSession, session_file: str) -> list[str]:
    """The session's data files: the file itself, or the files of its folder."""
    names = [n for n in fs.list_names(spark, session_file) if not n.startswith(("_", "."))]
    single = session_file.rstrip("/").split("/")[-1]
    return [session_file] if names == [single] else [f"{session_file}/{n}" for n in names]


def delta_id_of_path(path: Column, layout: str = "numbered") -> Column:
    """The delta id from a data file's path: its parent folder's name."""
    parent = F.element_at(F.split(path, "/"), -2)
    if layout == "partitioned":
        parent = F.regexp_extract(parent, r"^delta_id=(\d+)$", 1)
    return parent.cast("int")


def sessions_frame(spark: SparkSession, sessions: list[DeltaSession]) -> DataFrame:
    """The discovered sessions as a small DataFrame (one row per folder)."""
    return rows_frame(spark, [(s.delta_id, s.file) for s in sessions], "delta_id int, file string")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    """Options for a parallel JDBC full-table read (credentials come from config, never source: Q9)."""
    o = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        o["user"] = user
    if password is not None:
        o["password"] = password
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower, upper and num_partitions")
        o.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                 numPartitions=str(num_partitions))
    return o


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kw)).load()
