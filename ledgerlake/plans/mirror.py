"""Keyed mirror fed by ordered delta sessions, each applied once.

``apply_deltas`` is the set form of the reference's per-delta loop: the mirror
rows are tagged -1 (or keep their stored tag), every delta row its session
id, and per key the rows of the newest tag survive.  Applying N pending
deltas is one pass instead of N full rewrites, and gives the same rows as the
sequential loop in ascending order (duplicates inside a session included; NULL
keys are one group).  The stored mirror keeps the tags, so an older session
that arrives late never overrides a newer one, in the batch job or the stream.
Columns are matched by name; columns a delta adds (W13) are NULL in older rows.

``delta_loading`` is the job around it: discover sessions, skip those the
log already lists for this table (P14), read the pending files by their
headers with the mirror's declared types, apply, write, then append one log
row per applied session with shared start/finish times.  The files are parsed
once: their typed rows are staged and removed after the switch.  The mirror is
a table of key-hash buckets that split as they grow (``PartsTable``): only
segments that hold a delta's key are read and rewritten, rows of new keys are
appended, so a run costs in proportion to the deltas; the switch is atomic (Q7)
and its manifest lists the sessions it contains.  After a crash between the switch and the log append the sessions
are only logged: the effect is exactly once.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.latest import keep_newest_batch, latest_per_key
from ledgerlake.plans.exchange import export_csv
from ledgerlake.schemas import DELTA_LOG
from ledgerlake.sinks.parts import Merged, PartsTable, bucket_in, directory_of
from ledgerlake.sinks.staging import staged
from ledgerlake.sinks.store import AppendLog
from ledgerlake.sources import deltas as D
from ledgerlake.sources.csv_files import read_deltas
from ledgerlake.sources.local import rows_frame

DELTA_COL = "delta_id"
SEED_TAG = -1
BUCKETS = 32               # of a new mirror; they split as it grows


def apply_deltas(mirror: DataFrame, delta_rows: DataFrame, keys: list[str], mode: str = "faithful",
                 order: list[str] | None = None, delta_col: str = DELTA_COL, keep_tag: bool = False,
                 positional: bool = False, reduced: bool = False) -> DataFrame:
    """Mirror after applying every delta in ``delta_rows`` (which carry ``delta_col``).

    Columns are matched by name (new delta columns are NULL in older rows).
    ``positional=True`` is the reference's ``union``: delta columns take the
    mirror's names in file order, and the column counts must agree (U3).
    ``reduced`` says the mirror has one row per key already (``latest`` mode
    after its first run), so keys no delta touches need no reduction.
    """
    if mode not in ("faithful", "latest"):
        raise ValueError(f"mode must be 'faithful' or 'latest', not {mode!r}")
    if positional:
        data = [c for c in delta_rows.columns if c != delta_col]
        target = [c for c in mirror.columns if c != delta_col]
        if len(data) != len(target):
            raise ValueError(f"positional union needs {len(target)} delta columns, got {len(data)}")
        delta_rows = delta_rows.select(*[F.col(f"`{a}`").alias(b) for a, b in zip(data, target)], delta_col)
    delta_rows = delta_rows.withColumn(delta_col, F.col(delta_col).cast("int"))
    if delta_col not in mirror.columns:
        mirror = mirror.withColumn(delta_col, F.lit(SEED_TAG))

    def newest(rows: DataFrame) -> DataFrame:
        return keep_newest_batch(rows, keys, delta_col) if mode == "faithful" else latest_per_key(rows, keys, [delta_col, *(order or [])])

    # keys no delta touches keep their rows as they are; where the delta key set turns out small, Spark
    # makes this a map-side anti-join and those rows never reach a shuffle
    if mode == "faithful" or reduced:
        dkeys = delta_rows.select(*keys).distinct()
        hit = reduce(lambda a, b: a & b, [mirror[k].eqNullSafe(dkeys[k]) for k in keys])
        touched = mirror.join(dkeys, hit, "left_semi").unionByName(delta_rows, allowMissingColumns=True)
        out = mirror.join(dkeys, hit, "left_anti").unionByName(newest(touched), allowMissingColumns=True)
    else:
        out = newest(mirror.unionByName(delta_rows, allowMissingColumns=True))
    return out if keep_tag else out.drop(delta_col)


class MirrorStore:
    """The stored mirror: tagged rows in key-hash buckets.  Only what holds a delta's key is rewritten."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.keys, self.table, self._buckets = spark, keys, PartsTable(spark, path), buckets

    def exists(self) -> bool:
        return self.table.exists()

    def seed(self, rows: DataFrame, mode: str = "faithful", order: list[str] | None = None) -> int:
        tagged = rows.drop(DELTA_COL).withColumn(DELTA_COL, F.lit(SEED_TAG))
        if mode == "latest":
            tagged = latest_per_key(tagged, self.keys, [DELTA_COL, *(order or [])])
        schema = T.StructType([*rows.drop(DELTA_COL).schema.fields, T.StructField(DELTA_COL, T.IntegerType())])
        directory = directory_of(self._buckets)
        return self.table.replace(tagged, bucket_in(F.xxhash64(*self.keys), directory), None,
                                  {"sessions": [], "epochs": {}, "reduced": mode == "latest"}, schema, directory)

    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.table.schema().fields if f.name != DELTA_COL])

    def read(self) -> DataFrame:
        return self.table.read().drop(DELTA_COL)

    def apply(self, rows: DataFrame, schema: T.StructType, mode: str = "faithful", order: list[str] | None = None,
              notes: dict | None = None) -> Merged:
        """Apply delta rows (with the tag column); ``schema`` is the mirror's, with the columns the deltas add."""
        tagged = T.StructType([*schema.fields, T.StructField(DELTA_COL, T.IntegerType())])
        reduced = bool(self.table.notes().get("reduced"))
        with staged(rows, "deltas") as batch:
            return self.table.merge(batch, self.keys, lambda old, new: apply_deltas(old, new, self.keys, mode, order, keep_tag=True, reduced=reduced),
                                    notes=notes, schema=tagged, buckets=self._buckets)


@dataclass
class LoadResult:
    mirror: DataFrame
    applied: list[int]
    pending_without_file: list[int]
    version: int | None


def pending_ids(log: DataFrame, sessions: DataFrame, table: str) -> DataFrame:
    """Sessions not yet logged for ``table`` -- an anti-join, not a driver-side set."""
    loaded = log.filter(F.col("table_name") == F.lit(table)).select("delta_id").distinct()
    return sessions.join(loaded, "delta_id", "left_anti")


def delta_loading(spark: SparkSession, table: str, keys: list[str], deltas_base: str, log_path: str,
                  mirror_path: str, seed: DataFrame | None = None, layout: str = "numbered",
                  mode: str = "faithful", order: list[str] | None = None, read_options: dict | None = None,
                  clock=dt.datetime.now, log_view: str | None = "delta_logs", keep_versions: int | None = None,
                  positional: bool = False, export_to: str | None = None, buckets: int = BUCKETS) -> LoadResult:
    """The once-only load job (see module doc).

    ``keep_versions`` prunes older mirror versions after it; ``export_to`` also writes the mirror
    as the CSV ``<export_to>/mirr_<table>`` (a fresh folder).
    """
    store = MirrorStore(spark, mirror_path, keys, buckets)
    if not store.exists():
        if seed is None:
            raise FileNotFoundError(f"mirror {mirror_path} has no version and no seed was given")
        store.seed(seed, mode, order)                       # one-time seed (S10 or any DataFrame)
    log = AppendLog(spark, log_path, DELTA_LOG)

    def show_log() -> None:                                 # W14: the log as a session view
        if log_view:
            log.read().createOrReplaceTempView(log_view)

    show_log()
    sessions = D.discover(spark, deltas_base, table, layout)
    todo = pending_ids(log.read(), D.sessions_frame(spark, sessions), table).collect() if sessions else []  # one row per folder
    todo = sorted((r.delta_id, r.file) for r in todo)
    with_file = [(i, f) for i, f in todo if f is not None]
    missing = [i for i, f in todo if f is None]
    if with_file:
        started = clock()
        inside = set(store.table.notes().get("sessions", []))           # switched in already, a crash kept them from the log
        files = [f for i, folder in with_file if i not in inside for f in D.data_files(spark, folder)]
        if files:
            rows, schema = read_deltas(spark, files, store.schema(), keys, positional, **(read_options or {}))
            rows = rows.withColumn(DELTA_COL, D.delta_id_of_path(F.col("_file"), layout)).drop("_file")
            store.apply(rows, schema, mode, order, {"sessions": sorted(inside | {i for i, _ in with_file})})
        log.append(rows_frame(spark, [(started, clock(), i, table) for i, _ in with_file], DELTA_LOG))
        show_log()
        if keep_versions:
            store.table.prune(keep_versions)
    if export_to:
        export_csv(store.read(), f"{export_to.rstrip('/')}/mirr_{table}")
    return LoadResult(store.read(), [i for i, _ in with_file], missing, store.table.current())
